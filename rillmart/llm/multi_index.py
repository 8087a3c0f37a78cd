"""Nearest neighbours by largest inner product with an inverted multi-index.

Each half of the vectors has a codebook of its own; a vector's cell is the pair of its nearest centroids. A query visits
cells by rising summed distance of its halves to the two centroids, with a heap, until the cells hold a given share of
all vectors, and the vectors in them are scored exactly. The share is the least that finds ``target`` of the true
neighbours of some sample queries, which are compared with all rows.

Equal vectors are one entry. Entries meet queries by first centroid; the entries and the queries of one are dealt into
blocks of bounded size, so that no crowded cell lands in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmart.llm.common import fingerprint, written

FIT_ROWS = 20_000  # bound of the vectors the codebooks are fitted to
SAMPLE_QUERIES = 96  # bound of the queries the share is chosen by
TARGET = 0.97
BLOCK_ENTRIES, BLOCK_QUERIES = 4096, 1024
LOOPS = 12


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def products(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the order of the components."""
    out = np.zeros((len(queries), len(entries)))
    for q, e in zip(queries.T, entries.T, strict=True):
        out += np.multiply.outer(q, e)
    return out


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        halves = ((vectors[:, :cut], self.first), (vectors[:, cut:], self.second))
        a, b = ((v**2).sum(axis=1)[:, None] - 2 * v @ c.T + (c**2).sum(axis=1) for v, c in halves)
        return a, b

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(vectors)
        return a.argmin(axis=1), b.argmin(axis=1)


def _centroids(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centers = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(LOOPS):
        nearest = ((centers**2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centers))
        for j in np.nonzero(sizes)[0]:
            centers[j] = points[nearest == j].mean(axis=0)
    return centers


def traverse(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """All pairs (i, j) by rising first[i] + second[j], found with a heap."""
    a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
    heap, pushed = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in pushed:
                pushed.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _best(scores: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` largest of a row, and of all that tie with the last of them."""
    if len(scores) <= keep:
        return np.arange(len(scores))
    return np.nonzero(scores >= np.partition(scores, len(scores) - keep)[len(scores) - keep])[0]


def _best_ids(scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of the largest of a row that hold ``keep`` different ids, and of all that tie with the last of them."""
    many = keep
    while True:
        at = _best(scores, many)
        if len(at) == len(scores) or len(set().union(*ids[at])) >= keep:
            return at
        many *= 2


def _entries(vectors: DataFrame, keep: int) -> DataFrame:
    """h1, h2, vector, ids of each different vector; of its ids the ``keep`` smallest, which are all a result can need."""
    h1, h2 = fingerprint(F.col("vector"))
    turn = Window.partitionBy("h1", "h2").orderBy("id")
    ranked = vectors.select("id", "vector", h1.alias("h1"), h2.alias("h2")).distinct()  # a repeated row takes one place
    ranked = ranked.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= keep)
    return ranked.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_set("id")).alias("ids"))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    target: float = TARGET, codebook: int | None = None,
) -> DataFrame:
    """query_id, rank, id, score: the ``k`` nearest found of each row that ``is_query`` holds for, itself left out.

    Rows with a null id, an unusable vector, or another number of components than most rows have take no part. Ties go to
    the smaller id. Rows that repeat an id are all candidates, but for queries of that id. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    rows = rows.where(usable(F.col("vector")))
    # -0.0 and 0.0 are equal, and so are vectors that differ in that alone
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast(kind)))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id BIGINT, rank INT, id BIGINT, score DOUBLE"
    if sizes is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == sizes["n"])
    entries = written(_entries(rows, k + 1), "index_entries")
    total = entries.count()

    book = codebook or int(min(256, max(4, 4 * total**0.25)))
    share = F.pmod("h2", F.lit(1 << 30)) < int(min(1.0, FIT_ROWS / total) * (1 << 30))
    fit = _stack(entries.where(share).select("vector").toPandas()["vector"]) if total else None
    if fit is None or not len(fit):
        fit = _stack(entries.limit(1).toPandas()["vector"])
    rng, cut = np.random.default_rng(17), max(1, sizes["n"] // 2)
    books = Codebooks(_centroids(fit[:, :cut], book, rng), _centroids(fit[:, cut:], book, rng))

    def place(frames):
        for f in frames:
            i, j = books.cells(_stack(f["vector"]))
            yield f.assign(i=i, j=j)

    vector_type = dict(entries.dtypes)["vector"]
    indexed = entries.mapInPandas(place, f"h1 BIGINT, h2 BIGINT, vector {vector_type}, ids ARRAY<BIGINT>, i INT, j INT")
    indexed = written(indexed, "index")
    counts = np.zeros((len(books.first), len(books.second)), dtype=np.int64)
    for r in indexed.groupBy("i", "j").count().collect():  # at most 256 * 256
        counts[r["i"], r["j"]] = r["count"]

    asking = rows.where("asks")
    h1, h2 = fingerprint(F.col("vector"))
    askers = written(asking.select("id", h1.alias("h1"), h2.alias("h2")).distinct(), "queries")
    queries = indexed.join(askers.select("h1", "h2").distinct(), ["h1", "h2"]).select("h1", "h2", "vector")
    visits = _needed(indexed, queries, books, counts, k, target)

    def visit(frames):
        for f in frames:
            a, b = books.distances(_stack(f["vector"]))
            for n in range(len(f)):
                held, cells = 0, {}
                for i, j in traverse(a[n], b[n]):
                    if counts[i, j]:
                        cells.setdefault(i, []).append(j)
                        held += counts[i, j]
                    if held >= visits:
                        break
                row = f.iloc[n]
                yield pd.DataFrame(
                    {"h1": row["h1"], "h2": row["h2"], "vector": [row["vector"]] * len(cells), "i": list(cells), "js": list(cells.values())}
                )

    routed = queries.mapInPandas(visit, f"h1 BIGINT, h2 BIGINT, vector {vector_type}, i INT, js ARRAY<INT>")
    routed = written(routed, "routes")
    per_i = [int(x) for x in counts.sum(axis=1)]
    asks_i = {r["i"]: r["count"] for r in routed.groupBy("i").count().collect()}
    parts = F.array(*[F.lit(-(-x // BLOCK_ENTRIES) or 1) for x in per_i])
    turns = F.array(*[F.lit(-(-asks_i.get(i, 0) // BLOCK_QUERIES) or 1) for i in range(len(per_i))])
    n_parts, n_turns = F.get(parts, F.col("i")), F.get(turns, F.col("i"))
    own, every = lambda n, seed: F.array(F.pmod(F.xxhash64("h1", F.lit(seed)), n).cast("int")), lambda n: F.sequence(F.lit(0), n - 1)
    left = indexed.withColumn("part", F.explode(own(n_parts, 1))).withColumn("turn", F.explode(every(n_turns)))
    right = routed.withColumn("part", F.explode(every(n_parts))).withColumn("turn", F.explode(own(n_turns, 2)))

    def score(e: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(e) and len(q):
            e_vectors, q_vectors, e_cells = _stack(e["vector"]), _stack(q["vector"]), e["j"].to_numpy()
            scores = products(q_vectors, e_vectors)
            ids = e["ids"].to_numpy()
            for n, (a, b, js) in enumerate(zip(q["h1"], q["h2"], q["js"], strict=True)):
                at = np.nonzero(np.isin(e_cells, js))[0]
                at = at[_best_ids(scores[n, at], ids[at], k + 1)]
                found += [(a, b, ids[x], scores[n, x]) for x in at]
        return pd.DataFrame(found, columns=["h1", "h2", "ids", "score"])

    found = left.groupBy("i", "part", "turn").cogroup(right.groupBy("i", "part", "turn"))
    found = found.applyInPandas(score, "h1 BIGINT, h2 BIGINT, ids ARRAY<BIGINT>, score DOUBLE")
    order = [F.desc("score"), F.col("id")]
    best = found.select("h1", "h2", "score", F.explode("ids").alias("id")).groupBy("h1", "h2", "id").agg(F.max("score").alias("score"))
    best = best.withColumn("turn", F.row_number().over(Window.partitionBy("h1", "h2").orderBy(*order))).where(F.col("turn") <= k + 1)
    mine = best.drop("turn").join(askers.withColumnRenamed("id", "query_id"), ["h1", "h2"]).where("id <> query_id")
    mine = mine.groupBy("query_id", "id").agg(F.max("score").alias("score"))  # a query id may stand on several vectors
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _needed(indexed: DataFrame, queries: DataFrame, books: Codebooks, counts: np.ndarray, k: int, target: float) -> int:
    """How many entries queries must visit to find ``target`` of the true neighbours of the sample queries."""
    sample = queries.orderBy(F.xxhash64("h1", F.lit(3)), "h1", "h2").limit(SAMPLE_QUERIES).toPandas()
    if not len(sample):
        return 0
    asked = _stack(sample["vector"])

    def scan(frames):
        for f in frames:
            i, j, ids = f["i"].to_numpy(), f["j"].to_numpy(), f["ids"].to_numpy()
            for start in range(0, len(f), BLOCK_ENTRIES):
                scores = products(asked, _stack(f["vector"].iloc[start : start + BLOCK_ENTRIES]))
                for n in range(len(asked)):
                    at, held, some = _best_ids(scores[n], ids[start : start + BLOCK_ENTRIES], k + 1), set(), []
                    for x in at[(-scores[n, at]).argsort(kind="stable")]:
                        if len(held) > k:
                            break
                        if not held.issuperset(ids[start + x]):
                            held.update(ids[start + x])
                            some.append(x)
                    at = np.array(some, dtype=int)
                    yield pd.DataFrame({"n": n, "i": i[start + at], "j": j[start + at], "ids": ids[start + at], "score": scores[n, at]})

    found = indexed.select("vector", "ids", "i", "j").mapInPandas(scan, "n INT, i INT, j INT, ids ARRAY<BIGINT>, score DOUBLE")
    found = found.select("n", F.explode("ids").alias("id"), F.struct("score", "i", "j").alias("best")).groupBy("n", "id").agg(F.max("best").alias("best"))
    turn = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("best.score"), "id"))
    true = found.withColumn("turn", turn).where(F.col("turn") <= k + 1).select("n", "best.i", "best.j").toPandas()
    a, b = books.distances(asked)
    need = []
    for n, part in true.groupby("n"):
        wanted = list(zip(part["i"], part["j"], strict=True))
        held, after = 0, {}
        for cell in traverse(a[n], b[n]):
            held += int(counts[cell])
            after[cell] = held
        need += [after[c] for c in wanted]
    need.sort()
    return need[min(len(need) - 1, int(np.ceil(target * len(need))))]
