"""Near duplicates by an LSH forest of MinHash signatures, confirmed on whole shingle sets.

Each distinct shingle set has a label of ``DEPTH`` MinHash values in each of ``TREES`` trees. In a tree, sets are sorted by
label, and neighbours share the longest prefixes. Candidates are found and confirmed in three passes:

1. Neighbours in the sorted order of the first trees, which joins most groups of near copies with a few comparisons a
   set.
2. Neighbours in all trees, where they are in different groups: for each set the most similar ones of other groups.
3. All pairs that share a region, that is a prefix of ``REGION`` values, but are still in different groups. Those of a
   region with few such pairs are listed; then the sets of crowded regions are compared in blocks, as products of
   matrices of sets and shingles.

Listed pairs whose whole signatures differ too much are left out of the confirmation.

No set of a region's main group is compared with all others of it, and equal sets are one from the start.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmart.llm.common import fingerprint, held, written
from rillmart.llm.components import components

TREES, DEPTH = 16, 8
REGION = 4  # leading values the sets of a region share
VALUE = 2  # bytes of a value in a label
FIRST = 2  # trees of the first pass
REGION_PAIRS = 200  # of different groups that are listed for a region; one with more is compared in blocks
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 20  # about what a block of a crowded region holds at most
COLUMNS = 4096  # shingles in a matrix at once
KEPT_WORDS = 100_000
MARKS = 200_000  # rows whose marks are broadcast, 16 bytes and a key each, to find their texts
MIX = np.uint64(0xFF51AFD7ED558CCD)
STEP = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(5)
FACTORS = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDED = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
# The share of equal values estimates the similarity with a deviation of at most 0.036 at 0.8; 4.5 of them are allowed.
SIGNATURE_SLACK = 0.16


class Shingles:
    """Sets of hashed word shingles; keeps at most about ``KEPT_WORDS`` words."""

    def __init__(self, words: int):
        self.width, self.known = words, {}

    def of(self, text: str | None) -> np.ndarray:
        """The sorted distinct hashes of the text's shingles: of all its words, if it has fewer than a shingle takes."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.width, len(hashes))
        mixed = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            mixed = (mixed ^ (mixed >> np.uint64(32))) * STEP + hashes[k : len(hashes) - width + 1 + k]
        mixed = (mixed ^ (mixed >> np.uint64(33))) * MIX
        return np.unique(mixed ^ (mixed >> np.uint64(33)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """For each hash function, 16 bits that tell which shingle has the least value."""
    least = np.full(len(FACTORS), (1 << 64) - 1, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        np.minimum(least, (part[None, :] * FACTORS[:, None] + ADDED[:, None]).min(axis=1), out=least)
    return ((least * MIX) >> np.uint64(48)).astype(np.uint16)


def _features(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, r1, r2, n, set_key, labels for each row (doc_id, r1, r2, text); no set_key where there are no words."""

    def make(frames):
        held("shingles")
        shingles = Shingles(words)
        for f in frames:
            n, keys, labels = [], [], []
            for text in f["text"]:
                s = shingles.of(text)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                labels.append(signature(s).astype(">u2").tobytes() if len(s) else None)
            yield f[["doc_id", "r1", "r2"]].assign(n=n, set_key=keys, labels=labels)

    rows = docs.select(F.col("doc_id").cast("string"), "r1", "r2", "text")
    schema = "doc_id STRING, r1 BIGINT, r2 BIGINT, n BIGINT, set_key BINARY, labels BINARY"
    out = rows.mapInPandas(make, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _common(a: bytes, b: bytes) -> int:
    """Number of leading values two labels share."""
    if a == b:
        return len(a) // VALUE
    return next(i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y) // VALUE


def _sorted_trees(sets: DataFrame, trees: int) -> DataFrame:
    """tree, label, node, n, group, before, n_before: each tree's sets in sorted order, with the neighbour before.

    Only neighbours in other groups that share two values or more are given, and rows that share so many with a neighbour
    on either side. The first and the last row of a task come out in any case: their neighbours are in other tasks, and
    their regions will tell.
    """
    size = DEPTH * VALUE
    label = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring("labels", t * size + 1, F.lit(size)))
    rows = sets.select("node", "n", "group", F.posexplode(label).alias("tree", "label"))

    def scan(frames):
        last, link, shared, waiting = None, (None, None), 0, []

        def out():
            frame = pd.DataFrame(waiting, columns=["tree", "label", "node", "n", "group", "before", "n_before"])
            waiting.clear()
            return frame.astype({"n_before": "Int64"})

        for f in frames:
            for row in zip(f["tree"], f["label"], f["node"], f["n"], f["group"], strict=True):
                now = DEPTH if last is None else _common(last[1], row[1]) if last[0] == row[0] else 0
                if last is not None and max(shared, now) >= 2:
                    waiting.append((*last, *link))
                other = last is not None and now >= 2 and last[4] != row[4]
                link = (last[2], last[3]) if other else (None, None)
                last, shared = row, now
            yield out()
        if last is not None:
            waiting.append((*last, *link))
        yield out()

    ordered = rows.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    return ordered.select("tree", "label", "node", "n", "group").mapInPandas(
        scan, "tree INT, label BINARY, node BINARY, n BIGINT, group BINARY, before BINARY, n_before BIGINT"
    )


def _neighbours(trees: DataFrame, percent: int) -> DataFrame:
    near = trees.where(F.col("before").isNotNull() & _could_link("n", "n_before", percent))
    return near.select(F.least("node", "before").alias("a"), F.greatest("node", "before").alias("b")).distinct()


def _could_link(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs whose signatures do not rule a link out."""
    least = percent / 100 - SIGNATURE_SLACK

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="float64")
        x, y = (np.frombuffer(b"".join(s), dtype=">u2").reshape(len(s), -1) for s in (a, b))
        return pd.Series((x == y).mean(axis=1))

    labels = sets.select("node", "labels")
    both = pairs.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
    return both.select("a", "b", alike("la", "lb").alias("alike")).where(F.col("alike") >= least).select("a", "b")


def _whole_sets(nodes: DataFrame, rows: DataFrame, features: DataFrame, words: int) -> DataFrame:
    """node, shingles: the sets of ``nodes``, made again from the text of one of the rows that have them.

    A bounded number of rows is found in a scan of the texts; for more of them the texts are shuffled.
    """
    one = features.join(nodes, features["set_key"] == nodes["node"]).groupBy("node").agg(F.min(F.struct("r1", "r2")).alias("r"))
    one = written(one.select("node", "r.r1", "r.r2"), "marks")
    texts = rows.join(F.broadcast(one) if one.count() <= MARKS else one, ["r1", "r2"]).dropDuplicates(["r1", "r2", "node"])

    def make(frames):
        held("shingles")
        shingles = Shingles(words)
        for f in frames:
            yield pd.DataFrame({"node": f["node"], "shingles": [shingles.of(t).tobytes() for t in f["text"]]})

    return texts.select("node", "text").mapInPandas(make, "node BINARY, shingles BINARY")


def _with_more(whole: DataFrame, nodes: DataFrame, rows: DataFrame, features: DataFrame, words: int) -> DataFrame:
    """``whole`` with the sets of those of ``nodes`` that it lacks."""
    more = written(nodes.join(whole, "node", "left_anti"), "nodes")
    return whole if more.isEmpty() else whole.union(written(_whole_sets(more, rows, features, words), "whole_sets"))


def _confirmed(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def check(frames):
        for f in frames:
            ok = []
            for a, b in zip(f["sa"], f["sb"], strict=True):
                x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield f.loc[ok, ["a", "b"]]

    both = pairs.select("a", "b").join(whole.toDF("a", "sa"), "a").join(whole.toDF("b", "sb"), "b")
    return both.select("a", "b", "sa", "sb").mapInPandas(check, "a BINARY, b BINARY")


def _members(trees: DataFrame, groups: DataFrame) -> DataFrame:
    """tree, prefix, node, n, group: the sets of each tree, their regions and their present groups."""
    prefix = F.substring("label", 1, REGION * VALUE).alias("prefix")
    now = trees.select("tree", prefix, "node", "n").join(groups, "node", "left")
    return now.select("tree", "prefix", "node", "n", F.coalesce("component", "node").alias("group"))


def _regions(members: DataFrame) -> DataFrame:
    """tree, prefix, main, all, others, n_all, n_others of each region with several groups.

    ``main`` is its largest group and others are the sets outside; n_all and n_others are the shingles of the sets.
    """
    shares = members.groupBy("tree", "prefix", "group").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    main = F.max(F.struct("size", "n", "group")).alias("main")
    regions = shares.groupBy("tree", "prefix").agg(F.sum("size").alias("all"), F.sum("n").alias("n_all"), main)
    others = {"others": F.col("all") - F.col("main.size"), "n_others": F.col("n_all") - F.col("main.n"), "main": F.col("main.group")}
    return regions.withColumns(others).where("others > 0")


def _is_crowded():
    return F.col("all") * F.col("others") > REGION_PAIRS


def _region_pairs(members: DataFrame, regions: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of one of ``regions`` but of different groups."""
    # every such pair has a member outside the region's main group
    here = members.join(regions.select("tree", "prefix", "main"), ["tree", "prefix"])
    left = here.where(F.col("group") != F.col("main")).select(
        "tree", "prefix", F.col("node").alias("x"), F.col("group").alias("gx"), F.col("n").alias("nx")
    )
    once = (F.col("group") == F.col("main")) | (F.col("x") < F.col("node"))
    pairs = left.join(here, ["tree", "prefix"]).where(once & (F.col("gx") != F.col("group")) & _could_link("nx", "n", percent))
    return pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def common_shingles(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many shingles each of the sets at places ``x`` has in common with each other one at places ``y``."""
    which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = many > 1
    which, column = which[shared[column]], (np.cumsum(shared) - 1)[column[shared[column]]]
    order = column.argsort(kind="stable")
    which, column = which[order], column[order]
    out = np.zeros((len(x), len(y)))
    for start in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[which[a:b], column[a:b] - start] = 1
        out += held[x] @ held[y].T
    return out


def _block_links(percent: int):
    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        """Of the links between different groups of two blocks, enough to join the same groups as all."""
        found = []
        if len(x) and len(y):
            both = pd.concat([x, y], ignore_index=True)
            code = pd.factorize(both["group"])[0]
            place, first = pd.factorize(both["node"])
            whole = dict(zip(both["node"], both["shingles"], strict=True))
            sets = [np.frombuffer(whole[node], dtype=np.uint64) for node in first]
            sizes = np.array([len(s) for s in sets])
            px, py = place[: len(x)], place[len(x) :]
            common = common_shingles(sets, px, py)
            linked = 100 * common >= percent * (sizes[px][:, None] + sizes[py] - common)
            linked &= code[: len(x)][:, None] != code[len(x) :]
            joined = list(range(code.max() + 1))

            def top(g):
                while joined[g] != g:
                    joined[g] = g = joined[joined[g]]
                return g

            for i, j in zip(*np.nonzero(linked), strict=True):
                gx, gy = top(code[i]), top(code[len(x) + j])
                if gx != gy:
                    joined[gx] = gy
                    found.append((first[px[i]], first[py[j]]))
        return pd.DataFrame(found, columns=["a", "b"])

    return compare


def _crowd_links(members: DataFrame, regions: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """a, b: links that join the different groups of each of ``regions`` as all links between its sets do.

    The sets outside a region's main group are dealt into blocks, and so are all its sets; each block of the one kind
    meets each of the other.
    """
    parts = lambda sets, n: F.greatest(F.ceil(F.col(sets) / BLOCK_SETS), F.ceil(F.col(n) / BLOCK_SHINGLES)).cast("int")
    dealt = regions.select("tree", "prefix", "main", parts("others", "n_others").alias("ways"), parts("all", "n_all").alias("parts"))
    here = members.drop("n").join(dealt, ["tree", "prefix"]).join(whole, "node")
    own = lambda n, seed: F.array(F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    left = here.where(F.col("group") != F.col("main")).withColumn("way", F.explode(own("ways", 1))).withColumn("part", F.explode(every("parts")))
    right = here.withColumn("way", F.explode(every("ways"))).withColumn("part", F.explode(own("parts", 2)))
    keys, columns = ["tree", "prefix", "way", "part"], ["node", "group", "shingles"]
    right = right.select(*keys, *columns).toDF(*keys, *columns)  # columns other than those of left
    found = left.select(*keys, *columns).groupBy(keys).cogroup(right.groupBy(keys))
    return found.applyInPandas(_block_links(percent), "a BINARY, b BINARY").distinct()


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs with ends in different groups, ga and gb; a node that is in none is a group by itself."""
    both = pairs.join(groups.toDF("a", "ga"), "a", "left").join(groups.toDF("b", "gb"), "b", "left")
    both = both.withColumns({"ga": F.coalesce("ga", "a"), "gb": F.coalesce("gb", "b")})
    return both.where(F.col("ga") != F.col("gb"))


def _grown(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, component with the links added: components of groups rather than of nodes, so that few links are left."""
    if groups is None:
        return written(components(links), "groups")
    if links.isEmpty():
        return groups
    joined = written(components(_apart(links, groups).select(F.col("ga").alias("a"), F.col("gb").alias("b"))), "joined_groups")
    moved = groups.join(joined.toDF("component", "to"), "component", "left")
    moved = moved.select("node", F.coalesce("to", "component").alias("component"))
    return written(moved.union(joined.join(groups, "node", "left_anti")), "groups")


def _judged(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, r1, r2, n_shingles, component_id for each row; r1 and r2 stand for the row's id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *_row_mark(id_col, text), text.alias("text"))
    features = written(_features(rows, words), "features")
    sets = features.where("set_key IS NOT NULL").groupBy(F.col("set_key").alias("node"))
    sets = written(sets.agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("labels").alias("labels")), "sets")

    first = _sorted_trees(sets.withColumn("group", F.col("node")), FIRST)
    pairs = written(_plausible(_neighbours(first, percent), sets, percent), "pairs")
    whole = written(_whole_sets(_nodes(pairs), rows, features, words), "whole_sets")
    groups = _grown(None, written(_confirmed(pairs, whole, percent), "links"))

    grouped = sets.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    trees = written(_sorted_trees(grouped, TREES), "trees")
    for region in (False, True):
        if region:
            members = written(_members(trees, groups), "members")
            regions = written(_regions(members), "regions")
            pairs = _region_pairs(members, regions.where(~_is_crowded()), percent)
        else:
            pairs = _neighbours(trees, percent)
        pairs = written(_plausible(pairs, sets, percent), "pairs")
        whole = _with_more(whole, _nodes(pairs), rows, features, words)
        groups = _grown(groups, written(_confirmed(pairs, whole, percent), "links"))

    crowds = regions.where(_is_crowded()).select("tree", "prefix")
    members = written(_members(trees, groups).join(crowds, ["tree", "prefix"], "left_semi"), "members")
    regions = written(_regions(members), "regions")
    if not regions.isEmpty():
        members = members.join(regions.select("tree", "prefix"), ["tree", "prefix"], "left_semi")
        whole = _with_more(whole, members.select("node").distinct(), rows, features, words)
        groups = _grown(groups, written(_crowd_links(members, regions, whole, percent), "links"))

    named = sets.select("node", "least").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select(F.col("node").alias("set_key"), "component_id")
    out = features.select("doc_id", "r1", "r2", "n", "set_key").join(named, "set_key", "left")
    lone = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "r1", "r2", F.col("n").alias("n_shingles"), lone.alias("component_id"))


def _row_mark(id_col: str, text) -> list:
    h1, h2 = fingerprint(text)
    return [F.xxhash64(h1, F.col(id_col)).alias("r1"), F.xxhash64(h2, F.col(id_col)).alias("r2")]


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Words are what ASCII white space separates, with A-Z lower-cased. A row's set holds its distinct shingles of ``words``
    words, or all its words if there are fewer; two rows are linked where their sets have ``percent`` of their union in
    common. component_id is the least id of all rows reachable by links, kept says whether it is the row's own. Rows
    without words are linked with nothing. Null ids are larger than any other; a component of rows with null ids only has a
    null component_id and keeps them. Rows that repeat an id share its fate only where their texts do. An empty table
    gives no rows; no other column is read.
    """
    out = _judged(docs, words, percent, id_col, text_col)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns; one of those that repeat id and text."""
    judged = _judged(docs, words, percent, id_col, text_col)
    keep = judged.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = keep.select(F.col("r1").alias("__r1"), F.col("r2").alias("__r2")).distinct()
    r1, r2 = _row_mark(id_col, F.coalesce(F.col(text_col), F.lit("")))
    turn = F.row_number().over(Window.partitionBy("__r1", "__r2").orderBy(id_col))
    rows = docs.withColumns({"__r1": r1, "__r2": r2}).withColumn("__turn", turn).where("__turn = 1")
    return rows.join(keep, ["__r1", "__r2"], "left_semi").drop("__r1", "__r2", "__turn")
