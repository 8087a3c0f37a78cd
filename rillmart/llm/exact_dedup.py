"""Exact duplicates by deterministic block naming.

Each text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered, which gives every
block an integer name; adjacent pairs of names are numbered in the same way, level by level, until a text is one name.
Equal names at the same level mean equal texts, by induction, without trust in a hash.

Blocks are shuffled once, to be told apart. A row finds the name of its block by a 128-bit fingerprint, and the
fingerprints are checked to separate all distinct blocks; if two blocks shared one, the naming would start again
with another seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import ascii_lower, fingerprint, written

BLOCK_BYTES = 4096


def _numbered(distinct: DataFrame, order: list[str], keep: list[str], name: str) -> DataFrame:
    """Sort each partition and number its rows; written once, as numbers depend on the partitioning of that run."""
    numbers = distinct.sortWithinPartitions(*order).select(*keep, F.monotonically_increasing_id().alias("name"))
    return written(numbers, name)


def _block_names(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(h1, h2, name) of every distinct block, and the seed under which h1, h2 tell all of them apart."""
    seed = 0
    while True:
        h1, h2 = fingerprint(F.col("block"), seed)
        distinct = blocks.select("block").distinct().select("block", h1.alias("h1"), h2.alias("h2"))
        names = _numbered(distinct, ["block"], ["h1", "h2"], "block_names")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            return names, seed
        seed += 1


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``; texts are compared with A-Z lower-cased.

    Of equal texts the row with the largest id stays. A null text counts as empty. Null ids are smaller than any other;
    rows that repeat both id and text all come out, one of them kept. No other column of ``docs`` is read. An empty
    table gives no rows.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    body = docs.select(F.col(id_col).alias("doc_id"), text.cast("binary").alias("body"))
    count = F.greatest(F.lit(1), F.ceil(F.length("body") / block_bytes)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("body", i * block_bytes + 1, F.lit(block_bytes))
    )
    rows = body.select("doc_id", F.unhex(F.sha2("body", 256)).alias("sha"), count.alias("n"), "body")
    blocks = rows.select("doc_id", "sha", "n", F.posexplode(cut).alias("pos", "block"))

    names, seed = _block_names(blocks)
    h1, h2 = fingerprint(F.col("block"), seed)
    named = blocks.select("doc_id", "sha", "n", "pos", h1.alias("h1"), h2.alias("h2")).join(names, ["h1", "h2"])
    named = written(named.select("doc_id", "sha", "n", "pos", "name", F.lit(1).cast("long").alias("copies")), "named")

    level, most = 0, named.agg(F.max("n")).first()[0] or 1
    whole = [named.where("n = 1").withColumn("level", F.lit(0))]
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        even = F.col("pos") % 2 == 0
        half = [((F.col("n") + 1) / 2).cast("int").alias("n"), F.floor(F.col("pos") / 2).cast("int").alias("pos")]
        pairs = (
            named.where("n > 1")
            .groupBy("doc_id", "sha", *half)
            .agg(
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("right"),
                F.sum(F.when(even, F.col("copies"))).alias("copies"),
            )
        )
        pair_names = _numbered(pairs.select("left", "right").distinct(), ["left", "right"], ["left", "right"], "pair_names")
        named = pairs.join(pair_names, ["left", "right"]).select("doc_id", "sha", "n", "pos", "name", "copies")
        named = written(named, "named")
        whole.append(named.where("n = 1").withColumn("level", F.lit(level)))

    texts = whole[0]
    for more in whole[1:]:
        texts = texts.union(more)
    texts = texts.groupBy("doc_id", "sha", "level", "name").agg(F.sum("copies").alias("copies"))
    groups = texts.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    # written first, so that the join shuffles rows by name plainly, and the rows of a hot text can be split
    judged = texts.join(written(groups, "text_groups"), ["level", "name"])
    return judged.select(
        "doc_id", "keep_id", "group_size", "sha", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
