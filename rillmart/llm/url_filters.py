"""URL rules by host and path, matched by equal hash prefixes.

A URL is expanded into expressions: each suffix of its host at a label boundary, with each directory prefix of its path.
A rule has one expression, of its host and the directory part of its path. Expressions meet on the first hex digits of
their SHA-256; the full digest and the rest of the rule's path are compared after that, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import ascii_lower, written

SHORT = 8  # hex digits of the digest to join on


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for other urls."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def _digest(host: Column, directory: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), directory), 256)


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id", default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules`` has host, path, verdict (allow or block). A rule fits its host and all subdomains where the url's path
    starts with the rule's. Of the rules that fit, the longest (host and path together) wins; of equally long ones that
    with the longer host, then a block. No rule: null and ``default``. A null url, or one without ``://``, has an empty
    host and path. Rules with a null part are ignored, repeated rules count once, repeated pages all come out. No other
    column is read. Rules are broadcast only where Spark knows them to be small.
    """
    rules = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), "verdict").dropna().distinct()
    directory = F.regexp_extract("r_path", r"^(?s:.*/)?", 0)
    rules = rules.select(
        "r_host", "r_path", "verdict", _digest(F.col("r_host"), directory).alias("r_digest"),
        F.size(F.split("r_host", r"\.", -1)).alias("labels"), F.size(F.split(directory, "/", -1)).alias("depth"),
    )
    most = rules.agg(F.max("labels"), F.max("depth")).first()  # longer expressions can fit no rule
    labels, depth = most[0] or 0, most[1] or 0

    seen = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    addresses = seen.select("host", "path").distinct()
    parts, steps = F.split("host", r"\.", -1), F.split("path", "/", -1)
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."),
    )
    directories = F.transform(
        F.sequence(F.lit(1), F.least(F.size(steps), F.lit(max(depth, 1)))),
        lambda k: F.array_join(F.concat(F.slice(steps, F.lit(1), k - 1), F.array(F.lit(""))), "/"),
    )
    expanded = (
        addresses.select("host", "path", F.explode(hosts).alias("suffix"))
        .select("host", "path", "suffix", F.explode(directories).alias("directory"))
        .select("host", "path", _digest(F.col("suffix"), F.col("directory")).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    found = expanded.join(rules.withColumn("short", F.substring("r_digest", 1, SHORT)), "short").where(
        (F.col("digest") == F.col("r_digest")) & F.startswith("path", "r_path")
    )
    rule = F.concat("r_host", "r_path")
    best = F.max(
        F.struct(
            F.char_length(rule).alias("size"), F.char_length("r_host").alias("host_size"),
            (F.col("verdict") == "block").alias("blocks"), rule.alias("rule"), "verdict",
        )
    )
    # written first, so that the join shuffles pages plainly, and those of a hot address, or of none, can be split
    judged = written(found.groupBy("host", "path").agg(best.alias("best")), "judged_urls")
    return seen.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
