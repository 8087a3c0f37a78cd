"""One query for each operator of this subpackage, over its whole table, with the contract's digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm import byte_bpe, conversation_repair, cover_tree, exact_dedup, language_id, line_dedup, minhash_forest, multi_index, packing, token_files, toxicity, url_filters, vector_codes
from rillmart.llm.common import UPPER, table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_LOWER = f"'{UPPER}', '{UPPER.lower()}'"


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


SQL["op1_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS norm FROM documents),
g AS (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


@query
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    return url_filters.judge_urls(table(spark, folder, "pages"), rules)


SQL["op7_url_filters"] = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, start, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)})
SELECT page_id, host, path,
  (SELECT h || start FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)
   ORDER BY length(h || start) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start)
   ORDER BY length(h || start) DESC LIMIT 1), 'allow') AS verdict
FROM p
"""


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = line_dedup.repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


SQL["op9_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key FROM l),
r AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, r.key IS NOT NULL AND doc_id <> top AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def _fold(parts: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    # a null id has no remainder and is not learned from
    model = language_id.learn(docs.where(_fold(3) != 1), public_tokenizers.path("piece_bpe_32k.model"))
    judged = docs.select("doc_id", language_id.language(model, F.col("text")).alias("is"))
    return judged.select(
        "doc_id",
        F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        F.col("is.lang").alias("lang_pred"),
        F.col("is.score").alias("score"),
    )


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn(docs.where(_fold(5) != 0), table(spark, folder, "labels").where(_fold(5) != 0))
    scored = docs.select("doc_id", toxicity.toxicity(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    size = packing.token_count(public_tokenizers.path("word_bpe_49k.json"), F.col("text"))
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", size.alias("n_tokens")))


@query
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    to = token_files.token_files_folder(spark)
    docs = table(spark, folder, "documents")
    manifest = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), 2, to)
    return token_files.read_token_files(spark, to, manifest)


@query
def op10_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    found = multi_index.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query
def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, folder, "documents"))


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    file, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs, pairs = byte_bpe.encoded(docs, file, pattern)
    spaces = F.char_length("token_ids") - F.char_length(F.replace("token_ids", F.lit(" "), F.lit("")))
    return docs.select(
        "doc_id",
        F.when(F.col("token_ids") == "", 0).otherwise(spaces + 1).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(pairs.decode(F.col("token_ids")), 256).alias("decoded_sha256"),
    )


@query
def op11_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, folder, "embeddings"))


SQL["op11_near_vectors"] = """
WITH RECURSIVE u AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS least FROM r GROUP BY x),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least AS component_id, vec_id = least AS kept
FROM embeddings LEFT JOIN c ON vec_id = x LEFT JOIN n ON vec_id = a
"""


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"))[0]


_SQUARES = "list_sum(list_transform(range(1, 9), lambda i: (p.part[i] - c.part[i]) * (p.part[i] - c.part[i])))"


def _lloyd_sql(rounds: int) -> str:
    """Each round as two tables: every part's nearest entry (distance * 256 + entry), and the codebooks after it."""
    assigned = "SELECT vec_id, label, p.pos, p.part, min({d} * 256 + c.e) AS f FROM p JOIN c{n} c ON p.pos = c.pos GROUP BY ALL"
    sums = "SELECT pos, f % 256 AS e, i, sum(part[i]) AS s, count(*) AS n FROM a{n}, range(1, 9) t(i) GROUP BY ALL"
    means = "SELECT pos, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS part FROM ({sums}) GROUP BY ALL"
    steps = []
    for n in range(rounds):
        steps.append(f"a{n} AS MATERIALIZED ({assigned.format(d=_SQUARES, n=n)})")
        new = means.format(sums=sums.format(n=n))
        steps.append(
            f"c{n + 1} AS MATERIALIZED (SELECT c.pos, c.e, coalesce(m.part, c.part) AS part"
            f" FROM c{n} c LEFT JOIN ({new}) m ON c.pos = m.pos AND c.e = m.e)"
        )
    return ",\n".join([*steps, f"a{rounds} AS MATERIALIZED ({assigned.format(d=_SQUARES, n=rounds)})"])


SQL["op12_vector_codes"] = f"""
WITH base AS (SELECT vec_id, label, embedding FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, pos,
  list_transform(embedding[pos * 8 + 1:pos * 8 + 8], lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS part FROM base, range(8) t(pos)),
c0 AS MATERIALIZED (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, part FROM p
  WHERE vec_id IN (SELECT vec_id FROM base ORDER BY vec_id LIMIT 16)),
{_lloyd_sql(6)},
r AS (SELECT vec_id, label, string_agg(printf('%02x', f % 256), '' ORDER BY pos) AS code, CAST(sum(f // 256) AS BIGINT) AS error
  FROM a6 GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(part[i] AS VARCHAR), ',' ORDER BY pos, e, i)) FROM c6, range(1, 9) t(i)) AS codebooks_sha256
FROM r
"""


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    hurt = conversation_repair.damage(table(spark, folder, "conversations"))
    return conversation_repair.repair_reports(hurt, present=F.col("present"))
