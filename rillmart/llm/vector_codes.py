"""Vector codes by product quantisation, learned by Lloyd rounds over resident members.

A vector's components become integers and are cut into equal parts; each part position has a codebook. All parts live with
the owner of their entry: the state is a table bucketed by (position, entry, salt). In a round an owner sums its resident
members, which needs no shuffle; the sums of all salts of an entry, a few numbers each, make the new codebook. Every part then
looks for its nearest entry where it is: parts that keep their entry stay in their bucket, and only those that change it
are shuffled to their new owner.

All arithmetic is in integers, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

import uuid
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm.common import written
from rillmart.session import run_folder

SCALE = 4096
LIMIT = 1 << 22  # a scaled component beyond this counts as this, so that no sum of squares leaves 64 bits
OWNED = 1 << 18  # parts an owner's bucket should hold at most; a hot entry is split into salts of a quarter of that
OWNER = ["position", "entry", "salt"]

Codebooks = list[list[list[int]]]  # by position, entry, component


def finite(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))


def _scaled(vector: Column, length: int) -> Column:
    """Whole numbers, with zeros up to ``length``."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))
    return F.concat(F.transform(vector, whole), F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size(vector)))


def _nearest(books: Codebooks, parts: DataFrame, width: int) -> DataFrame:
    """``parts`` with ``near`` and ``distance`` of the nearest entry, the lower one of equals; the codebooks go along with the code."""
    tables = [np.array(book, dtype=np.int64).reshape(-1, width) for book in books]

    @F.pandas_udf("long")
    def found(position: pd.Series, *components: pd.Series) -> pd.Series:
        at, members = position.to_numpy(), np.stack([c.to_numpy() for c in components], axis=1)
        out = np.zeros(len(at), dtype=np.int64)
        for p in np.unique(at):
            here = np.nonzero(at == p)[0]
            squares = np.stack([((members[here] - entry) ** 2).sum(axis=1) for entry in tables[p]])
            near = squares.argmin(axis=0)
            out[here] = squares[near, np.arange(len(here))] * 256 + near
        return pd.Series(out)

    # Spark evaluates a call once a row only if it takes it for one that may give another result the next time
    both = parts.withColumn("found", found.asNondeterministic()("position", *[f"p{i}" for i in range(width)]))
    return both.withColumns({"near": F.pmod("found", F.lit(256)).cast("int"), "distance": F.shiftright("found", 8)}).drop("found")


class _State:
    """The parts in buckets by owner; every round writes a new table."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets

    def put(self, stays: DataFrame, moves: DataFrame | None = None) -> DataFrame:
        """``stays`` lie in their owner's bucket already; ``moves`` are shuffled to theirs."""
        rows = stays
        if moves is not None:
            rows = stays.unionByName(moves.repartition(self.buckets, *OWNER))
        name = f"vector_codes_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *OWNER).option("path", run_folder(self.spark, "vector_codes")).saveAsTable(name)
        self.name, old = name, getattr(self, "name", None)
        if old:
            self.forget(old)
        return self.spark.table(name)

    def forget(self, name: str) -> None:
        """Take a table out of the catalog; its files stay, as the folder is the cluster's to clear."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def resident_sums(state: DataFrame, width: int) -> DataFrame:
    """position, entry, n and the sums of the members, first by owner, where the members are."""
    sums = [F.sum(f"p{i}").alias(f"p{i}") for i in range(width)]
    owned = state.groupBy(*OWNER).agg(F.count("*").alias("n"), *sums)
    return owned.groupBy("position", "entry").agg(F.sum("n").alias("n"), *sums)


def stays_and_moves(state: DataFrame, books: Codebooks, width: int) -> tuple[DataFrame, DataFrame]:
    near = _nearest(books, state, width).drop("distance")
    stays = near.where(F.col("near") == F.col("entry")).drop("near")
    moves = near.where(F.col("near") != F.col("entry")).drop("entry").withColumnRenamed("near", "entry")
    return stays, moves.select(stays.columns)


def codebook_hash(books: Codebooks) -> str:
    return sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = 8, entries: int = 16, rounds: int = 6, owned: int = OWNED,
) -> tuple[DataFrame, Codebooks]:
    """(id_col, code, error, label_error, codebooks_sha256) of each row that is kept, and the codebooks.

    Dropped are rows whose vector is null, empty, or holds null or non-finite components, and rows whose vector has another
    length than most kept rows (the smaller of equally frequent lengths). A length that ``parts`` does not divide counts as
    filled up with zeros. Scaled components beyond 2^22 (components beyond 1024) count as 2^22. The codebooks start from the ``entries`` rows of the
    smallest ids, with fewer rows from all; nulls come last and rows that repeat an id are taken by vector. Rows that repeat
    are rows of their own, with the same code. ``label_error`` sums the errors of rows of the same label, nulls together; sums
    over 2^63 - 1 count as that. Other columns have no part. An empty table gives no rows and empty codebooks.
    """
    if not (0 < entries <= 256 and parts > 0 and rounds >= 0):
        raise ValueError("entries must be 1 to 256, parts positive and rounds not negative")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    rows = rows.where(finite(F.col("vector")))
    most = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    id_type, label_type = dict(rows.dtypes)["id"], dict(rows.dtypes)["label"]
    if most is None:
        nothing = f"{id_col} {id_type}, code STRING, error BIGINT, label_error BIGINT, codebooks_sha256 STRING"
        return spark.createDataFrame([], nothing), []
    count, width = most["count"], -(-most["n"] // parts)
    rows = rows.where(F.size("vector") == most["n"])
    rows = rows.select("id", "label", _scaled(F.col("vector"), width * parts).alias("vector"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "vector_rows")

    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()  # at most 256 rows
    books: Codebooks = [[list(r["vector"][p * width : (p + 1) * width]) for r in first] for p in range(parts)]

    cut = rows.select("row", F.posexplode(F.array(*[F.slice("vector", p * width + 1, width) for p in range(parts)])).alias("position", "part"))
    cut = cut.select("row", "position", *[F.get("part", F.lit(i)).alias(f"p{i}") for i in range(width)])
    salts = 1 + 4 * count // owned
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    cut = _nearest(books, cut, width).drop("distance").withColumnRenamed("near", "entry")
    buckets = min(50_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count * parts // owned)))
    state = _State(spark, buckets)
    here = state.put(cut.where("false"), cut)

    for _ in range(rounds):
        for r in resident_sums(here, width).collect():  # at most parts x entries rows
            books[r["position"]][r["entry"]] = [r[f"p{i}"] // r["n"] for i in range(width)]
        here = state.put(*stays_and_moves(here, books, width))

    coded = _nearest(books, here, width).select("row", "position", "entry", "distance")
    two_digits = F.array_join(F.transform(F.array_sort("of"), lambda x: F.lower(F.lpad(F.hex(x["entry"]), 2, "0"))), "")
    by_row = coded.groupBy("row").agg(F.collect_list(F.struct("position", "entry")).alias("of"), F.sum("distance").alias("error"))
    by_row = by_row.select("row", two_digits.alias("code"), "error").join(rows.select("row", "id", "label"), "row")
    by_row = written(by_row.drop("row"), "vector_codes")
    state.forget(state.name)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    # written first, so that the join shuffles rows by label plainly and a hot label can be split
    by_label = written(by_row.groupBy(F.col("label").alias("its_label")).agg(total.alias("label_error")), "label_errors")
    out = by_row.join(by_label, F.col("label").eqNullSafe(F.col("its_label")), "left")
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebook_hash(books)).alias("codebooks_sha256")), books
