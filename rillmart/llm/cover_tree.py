"""Pairs of vectors within a cosine threshold, by dual traversal of cover trees.

Vectors of one label and length are points of the unit sphere, where a cosine is a distance. Each group has a tree of nested
levels with halving radii: a node's children are balls of half its level's radius around points of a bounded sample, picked
so that they cover the most; what no ball covers stays beside them. A node holds the greatest distance of any of its
points from its centre, so of two nodes

- all pairs are out of reach if their centres are further apart than the threshold and both radii: they are pruned;
- all pairs are links if centres and radii together stay below the threshold: they are counted, not listed;
- and otherwise their children meet.

Leaves are cut into blocks. Two blocks that meet first drop the points that the other's ball is out of reach of; what
remains is compared exactly, in double precision. Links of a pair of blocks leave the task as counts by vector and as links
that join the same vectors (no more than there are vectors), so that a crowd is never listed pair by pair.

Equal vectors of a group are one entry. The tree is built level by level and the traversal goes level by level, both as Spark
jobs over tables of nodes; a node that holds many rows is dealt to several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmart.llm.common import fingerprint, written
from rillmart.llm.components import components
from rillmart.llm.multi_index import usable

BLOCK = 1024  # entries a leaf may hold before it is split or cut
SAMPLE = 512  # entries of a node from which centres are picked
LEAST = 64  # a ball counts if it covers one in this many of the sample
DEALT = 8192  # entries a task looks at when a node is split
LEVELS = 8  # radii 1, 1/2, ... on a sphere of radius 1
SLACK = 1e-6  # bounds this close to the threshold decide nothing; far above any rounding of a distance
NEAR = 1e-9  # cosines this close to the threshold are worked out anew, in the order of the components


def _stack(blobs, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.float64).reshape(-1, width)


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; first scaled by a power of two, which changes no digit, so that no square is too large or small."""
    _, powers = np.frexp(np.abs(vectors).max(axis=1))
    near_one = np.ldexp(vectors, -powers[:, None])
    return near_one / np.sqrt((near_one**2).sum(axis=1))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """In double precision, each sum in the order of the components."""
    ab = aa = bb = 0.0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        ab, aa, bb = ab + x * y, aa + x * x, bb + y * y
    return ab / (aa**0.5 * bb**0.5)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of unit vectors; good to 1e-7."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (points @ centres.T), 0.0))


# ---- the tree ----------------------------------------------------------------------------------

ENTRY = "entry BIGINT, grp STRING, vector BINARY, copies BIGINT"
NODE = "node STRING, parent STRING, centre BINARY, radius DOUBLE, n BIGINT, copies BIGINT, first BIGINT, block BOOLEAN"


def _pick(radius: float):
    def pick(sample: pd.DataFrame) -> pd.DataFrame:
        """The centres of one node's balls: each covers the most of what is not covered yet, down to a share of the sample."""
        node = sample["node"].iloc[0]
        sample = sample.sort_values("entry")
        points = _stack(sample["vector"], len(sample["vector"].iloc[0]) // 8)
        near = _distances(points, points) <= radius
        left, chosen = np.ones(len(points), dtype=bool), []
        least = max(2, len(points) // LEAST)
        while True:
            covers = near[:, left].sum(axis=1)
            best = int(covers.argmax())
            if covers[best] < least:
                break
            chosen.append(best)
            left &= ~near[best]
        return pd.DataFrame({"node": node, "k": range(len(chosen)), "centre": [points[c].tobytes() for c in chosen]})

    return pick


def _deal(radius: float, level: int):
    def deal(members: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        """Each entry with the node it goes on to: the ball of its nearest centre, or what is left beside the balls."""
        if not len(members):
            return pd.DataFrame({"entry": [], "child": [], "centre": [], "distance": []})
        node = members["node"].iloc[0]
        if not len(centres):
            return pd.DataFrame({"entry": members["entry"], "child": f"{node}/rest", "centre": None, "distance": None})
        centres = centres.sort_values("k")
        width = len(members["vector"].iloc[0]) // 8
        found = _distances(_stack(members["vector"], width), _stack(centres["centre"], width))
        near = found.argmin(axis=1)
        far = found[np.arange(len(near)), near]
        inside = far <= radius
        blobs = centres["centre"].tolist()
        return pd.DataFrame(
            {
                "entry": members["entry"],
                "child": [f"{node}/{level}.{k}" if y else f"{node}/rest" for k, y in zip(near, inside, strict=True)],
                "centre": [blobs[k] if y else None for k, y in zip(near, inside, strict=True)],
                "distance": np.where(inside, far, np.nan),
            }
        )

    return deal


def _split(open_rows: DataFrame, sizes: DataFrame, level: int) -> DataFrame:
    """entry, child, centre, distance of the entries of nodes to split at a level."""
    radius = 2.0**-level
    turn = Window.partitionBy("node").orderBy(F.xxhash64("entry"), "entry")
    sample = open_rows.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= SAMPLE)
    picked = sample.select("node", "entry", "vector").groupBy("node").applyInPandas(_pick(radius), "node STRING, k INT, centre BINARY")
    picked = written(picked, "tree_centres")
    shares = sizes.select(F.col("node"), F.ceil(F.col("n") / DEALT).cast("int").alias("shares"))
    left = open_rows.join(shares, "node").withColumn("share", F.pmod(F.xxhash64("entry"), F.col("shares")).cast("int"))
    right = picked.join(shares, "node").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    both = left.select("node", "share", "entry", "vector").groupBy("node", "share").cogroup(right.select("node", "share", "k", "centre").groupBy("node", "share"))
    return both.applyInPandas(_deal(radius, level), "entry BIGINT, child STRING, centre BINARY, distance DOUBLE")


def build(entries: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """The nodes (``NODE``), and each entry with its path from the root to its leaf and its block.

    A node is split while it has more entries than a block, as long as balls of the next radius are found in it.
    """
    # of a root only what holds for the whole sphere is known
    rows = entries.select("entry", "vector", "copies", F.col("grp").alias("node"), F.array("grp").alias("path"))
    root = F.max(F.col("vector"))
    nodes = [
        written(
            rows.groupBy("node").agg(
                F.lit(None).cast("string").alias("parent"), root.alias("centre"), F.lit(2.0).alias("radius"),
                F.count("*").alias("n"), F.sum("copies").alias("copies"), F.min("entry").alias("first"),
            ),
            "tree_nodes",
        )
    ]
    done = []
    for level in range(LEVELS):
        large = nodes[-1].where((F.col("n") > BLOCK) & ~F.col("node").endswith("/rest")).select("node", "n")
        if large.isEmpty():
            break
        here = rows.join(large.select("node"), "node", "left_semi")
        done.append(rows.join(large.select("node"), "node", "left_anti"))
        children = written(_split(here, large, level), "tree_level")
        # a node in which nothing was found is a leaf as it is; else its balls and what is left are its children
        found = children.where("centre IS NOT NULL").select(F.element_at(F.split("child", "/[^/]*$"), 1).alias("node")).distinct()
        found = written(found, "tree_split")
        done.append(here.join(found, "node", "left_anti"))
        here = here.join(found, "node", "left_semi")
        rows = here.join(children, "entry").select(
            "entry", "vector", "copies", F.col("child").alias("node"), F.array_append("path", F.col("child")).alias("path"),
            F.col("node").alias("parent"), "centre", "distance",
        )
        rows = written(rows, "tree_rows")
        made = rows.groupBy("node", "parent").agg(
            F.first("centre").alias("centre"), F.max("distance").alias("radius"), F.count("*").alias("n"),
            F.sum("copies").alias("copies"), F.min("entry").alias("first"),
        )
        # what is left of a node lies in its parent's ball
        above = nodes[-1].select(F.col("node").alias("parent"), F.col("centre").alias("its_centre"), F.col("radius").alias("its_radius"))
        made = made.join(above, "parent").select(
            "node", "parent", F.coalesce("centre", "its_centre").alias("centre"), F.coalesce("radius", "its_radius").alias("radius"),
            "n", "copies", "first",
        )
        nodes.append(written(made, "tree_nodes"))
        rows = rows.drop("parent", "centre", "distance")
    done.append(rows)
    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.unionByName(more)
    inner = nodes[0]
    for more in nodes[1:]:
        inner = inner.unionByName(more)
    sizes = leaves.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    leaves = leaves.join(sizes, "node").withColumn("share", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))
    leaves = leaves.withColumn("block", F.concat("node", F.lit("#"), F.col("share")))
    leaves = written(leaves.select("entry", "vector", "copies", "node", "path", "block"), "tree_leaves")
    return inner.withColumn("block", F.lit(False)), leaves


BLOCK_ROW = "node STRING, parent STRING, centre BINARY, radius DOUBLE, n BIGINT, copies BIGINT, first BIGINT, entries ARRAY<BIGINT>, weights ARRAY<BIGINT>, vectors BINARY"


def _pack(members: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: its ball around the mean, and all its vectors."""
    members = members.sort_values("entry")
    points = _stack(members["vector"], len(members["vector"].iloc[0]) // 8)
    middle = points.mean(axis=0)
    size = np.sqrt((middle**2).sum())
    middle = middle / size if size > 1e-3 else points[0]  # a centre must be on the sphere
    return pd.DataFrame(
        {
            "node": [members["block"].iloc[0]], "parent": [members["node"].iloc[0]], "centre": [middle.tobytes()],
            "radius": [float(_distances(points, middle[None]).max())], "n": [len(points)], "copies": [int(members["copies"].sum())],
            "first": [int(members["entry"].min())], "entries": [members["entry"].tolist()], "weights": [members["copies"].tolist()],
            "vectors": [points.tobytes()],
        }
    )


# ---- the traversal -------------------------------------------------------------------------------


def _bounds(reach: float):
    def bounds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs of nodes, each with what their balls say: none of their pairs are links, all are, or it is not known."""
        for f in frames:
            a_centres, b_centres = f["a_centre"].tolist(), f["b_centre"].tolist()
            apart = np.array([np.sqrt(((np.frombuffer(a) - np.frombuffer(b)) ** 2).sum()) for a, b in zip(a_centres, b_centres, strict=True)])
            spread = f["a_radius"].to_numpy() + f["b_radius"].to_numpy()
            f = f.drop(columns=["a_centre", "b_centre", "a_radius", "b_radius"])
            f["all"] = apart + spread < reach - SLACK
            yield f[apart - spread <= reach + SLACK]

    return bounds


PAIR = "a STRING, b STRING, a_block BOOLEAN, b_block BOOLEAN"


def traverse(nodes: DataFrame, reach: float) -> tuple[list[DataFrame], list[DataFrame]]:
    """Pairs of nodes (a, b) of which all pairs are links, and pairs of blocks (a, b) to be compared, each in one order only.

    Each round puts the children in the place of the nodes of all undecided pairs; there are as many as levels.
    """
    described = ["node", "centre", "radius", "block"]
    # a block stands for itself in every later round
    steps = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("above"), *described)
    steps = written(steps.union(nodes.where("block").select(F.col("node").alias("above"), *described)), "tree_steps")
    side = lambda s: steps.select(F.col("above").alias(f"{s}_above"), *[F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in described])
    root = nodes.where("parent IS NULL")
    pairs = root.select(F.col("node").alias("a"), F.col("node").alias("b"))
    alike, meet = [], []
    while True:
        above = pairs.select(F.col("a").alias("a_above"), F.col("b").alias("b_above"))
        below = above.join(side("a"), "a_above").join(side("b"), "b_above").where("a_above <> b_above OR a <= b")
        below = below.select("a", "b", "a_block", "b_block", "a_centre", "b_centre", "a_radius", "b_radius")
        decided = written(below.mapInPandas(_bounds(reach), f"{PAIR}, all BOOLEAN"), "tree_pairs")
        alike.append(decided.where("all").select("a", "b"))
        meet.append(decided.where("NOT all AND a_block AND b_block").select("a", "b"))
        pairs = decided.where("NOT all AND NOT (a_block AND b_block)")
        if pairs.isEmpty():
            return alike, meet


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all places that the symmetric table ``linked`` joins; fewer than places."""
    out, seen = [], np.zeros(len(linked), dtype=bool)
    for start in range(len(linked)):
        if seen[start]:
            continue
        seen[start], edge = True, [start]
        while edge:
            at = edge.pop()
            new = np.nonzero(linked[at] & ~seen)[0]
            seen[new] = True
            out += [(at, int(x)) for x in new]
            edge += new.tolist()
    return out


def _links(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the unit vectors a and b link; those near the threshold are worked out in the order of the components."""
    found = a @ b.T
    linked = found >= threshold
    for i, j in np.argwhere(np.abs(found - threshold) < NEAR):
        linked[i, j] = cosine(a[i], b[j]) >= threshold
    return linked


def _compare(threshold: float, listed: bool):
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs of blocks to rows (entry, other, n): n linked rows of an entry, or a link with another entry."""
        for f in frames:
            for r in f.itertuples(index=False):
                width = len(r.a_centre) // 8
                a, b = _stack([r.a_vectors], width), _stack([r.b_vectors], width)
                a_ids, b_ids = np.asarray(r.a_entries), np.asarray(r.b_entries)
                if r.a == r.b:
                    linked = _links(a, a, threshold) | np.eye(len(a), dtype=bool)
                    linked |= linked.T
                    if listed:
                        i, j = np.nonzero(np.triu(linked, 1))
                        yield pd.DataFrame({"entry": a_ids[i], "other": a_ids[j], "n": 1})
                        continue
                    counts, edges = linked @ np.asarray(r.a_weights), _forest(linked)
                    yield pd.DataFrame({"entry": a_ids, "other": pd.array([None] * len(a), dtype="Int64"), "n": counts})
                    yield pd.DataFrame({"entry": a_ids[[x for x, _ in edges]], "other": a_ids[[y for _, y in edges]], "n": 0})
                    continue
                near_a = np.nonzero(_distances(a, _stack([r.b_centre], width))[:, 0] <= reach + r.b_radius + SLACK)[0]
                near_b = np.nonzero(_distances(b, _stack([r.a_centre], width))[:, 0] <= reach + r.a_radius + SLACK)[0]
                if not len(near_a) or not len(near_b):
                    continue
                linked = _links(a[near_a], b[near_b], threshold)
                if listed:
                    i, j = np.nonzero(linked)
                    yield pd.DataFrame({"entry": a_ids[near_a[i]], "other": b_ids[near_b[j]], "n": 1})
                    continue
                for ids, at, weights, found in ((a_ids, near_a, np.asarray(r.b_weights)[near_b], linked), (b_ids, near_b, np.asarray(r.a_weights)[near_a], linked.T)):
                    hit = np.nonzero(found.any(axis=1))[0]
                    yield pd.DataFrame({"entry": ids[at[hit]], "other": pd.array([None] * len(hit), dtype="Int64"), "n": found[hit] @ weights})
                some_a, some_b = np.nonzero(linked.any(axis=1))[0], np.nonzero(linked.any(axis=0))[0]
                every = np.zeros((len(some_a) + len(some_b),) * 2, dtype=bool)
                every[: len(some_a), len(some_a) :] = linked[np.ix_(some_a, some_b)]
                every |= every.T
                ids = np.concatenate([a_ids[near_a[some_a]], b_ids[near_b[some_b]]])
                edges = _forest(every)
                yield pd.DataFrame({"entry": ids[[x for x, _ in edges]], "other": ids[[y for _, y in edges]], "n": 0})

    return compare


class Joined:
    """The tree of a table's entries and what its traversal found."""

    def __init__(self, entries: DataFrame, threshold: float):
        self.threshold, self.reach = threshold, float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
        inner, self.leaves = build(entries, self.reach)
        packed = self.leaves.select("entry", "vector", "copies", "node", "block").groupBy("block").applyInPandas(_pack, BLOCK_ROW)
        self.blocks = written(packed, "tree_blocks")
        described = ["node", "parent", "centre", "radius", "n", "copies", "first", "block"]
        outer = self.blocks.withColumn("block", F.lit(True)).select(described)
        self.nodes = written(inner.select(described).unionByName(outer), "tree_nodes")
        alike, meet = traverse(self.nodes, self.reach)
        self.alike = self._all(alike)
        self.meet = self._all(meet)
        self.met = self.meet.count()

    @staticmethod
    def _all(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for more in tables[1:]:
            out = out.union(more)
        return out

    def _met(self, listed: bool) -> DataFrame:
        columns = ["entries", "weights", "vectors", "centre", "radius"]
        side = lambda s: self.blocks.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in columns])
        # where Spark broadcasts the blocks, their pairs still go to many tasks
        pairs = self.meet.repartition(max(int(self.meet.sparkSession.conf.get("spark.sql.shuffle.partitions")), self.met // 64), "a", "b")
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        return both.mapInPandas(_compare(self.threshold, listed), "entry BIGINT, other BIGINT, n BIGINT")

    def _paths(self) -> DataFrame:
        """Each entry with every node it is in."""
        return self.leaves.select("entry", "copies", F.explode(F.array_append("path", F.col("block"))).alias("node"))

    def counts_and_links(self) -> tuple[DataFrame, DataFrame]:
        """(entry, n): how many rows each entry links with, its own included; and (a, b): links that join what links join."""
        compared = written(self._met(listed=False), "tree_links")
        # of a pair of nodes that link whole, each side counts the other's rows
        nodes = self.nodes.select("node", "copies", "first")
        other = nodes.select(F.col("node").alias("b"), F.col("copies").alias("n"), F.col("first").alias("joins"))
        ways = self.alike.union(self.alike.where("a <> b").select("b", "a"))
        whole = ways.join(other, "b").groupBy("a").agg(F.sum("n").alias("n"), F.min("joins").alias("joins"))
        whole = written(whole.select(F.col("a").alias("node"), "n", "joins"), "tree_whole")
        under = written(self._paths().join(whole, "node").select("entry", "n", "node"), "tree_under")
        counts = compared.where("other IS NULL").select("entry", "n").union(under.select("entry", "n"))
        counts = counts.groupBy("entry").agg(F.sum("n").alias("n"))
        links = compared.where("other IS NOT NULL").select(F.col("entry").alias("a"), F.col("other").alias("b"))
        # entries of such a node link with the same entries, and so with one of its own in the same component
        stars = under.join(nodes, "node").select(F.col("entry").alias("a"), F.col("first").alias("b"))
        across = ways.join(nodes.select(F.col("node").alias("a"), F.col("first").alias("x")), "a").join(
            nodes.select(F.col("node").alias("b"), F.col("first").alias("y")), "b"
        )
        return counts, links.union(stars).union(across.select(F.col("x").alias("a"), F.col("y").alias("b")))

    def pairs(self) -> DataFrame:
        """(a, b) of all pairs of different entries that link, a < b."""
        met = self._met(listed=True).select("entry", "other")
        under = self._paths().select("entry", "node")
        whole = self.alike.join(under.select(F.col("node").alias("a"), "entry"), "a").join(under.select(F.col("node").alias("b"), F.col("entry").alias("other")), "b")
        whole = whole.where("entry <> other").select("entry", "other")
        return met.union(whole).select(F.least("entry", "other").alias("a"), F.greatest("entry", "other").alias("b")).distinct()


# ---- the operator ---------------------------------------------------------------------------------


def _unit_blobs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = np.empty(len(f), dtype=object)
        sizes = f["vector"].map(len).to_numpy()
        for size in np.unique(sizes):
            at = np.nonzero(sizes == size)[0]
            out[at] = [u.tobytes() for u in units(np.stack(f["vector"].to_numpy()[at]).astype(np.float64))]
        yield f.assign(vector=out)


def _rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, grp (null if the row takes no part), h1, h2, vector."""
    label, vector = F.col(label_col), F.col(vector_col)
    group = F.when(usable(vector) & label.isNotNull(), F.concat(F.size(vector).cast("string"), F.lit(":"), F.regexp_replace(label.cast("string"), "([%/#])", "%$1")))
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    whole = F.transform(vector, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast(kind))  # -0.0 and 0.0 are equal
    h1, h2 = fingerprint(whole)
    return vectors.select(F.col(id_col).alias("id"), group.alias("grp"), h1.alias("h1"), h2.alias("h2"), whole.alias("vector"))


def entries_of(rows: DataFrame) -> DataFrame:
    """One entry for all rows of a group that have the same vector; copies are counted before they are shuffled."""
    part = rows.where("grp IS NOT NULL").groupBy("grp", "h1", "h2", "vector").agg(F.count("*").alias("copies"), F.min("id").alias("id"))
    part = part.select(F.monotonically_increasing_id().alias("entry"), "grp", "h1", "h2", "vector", "copies", "id")
    types = dict(part.dtypes)
    schema = f"entry BIGINT, grp STRING, h1 BIGINT, h2 BIGINT, vector BINARY, copies BIGINT, id {types['id']}"
    return written(written(part, "tree_vectors").mapInPandas(_unit_blobs, schema), "tree_entries")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row.

    Rows link if their labels are equal and not null, their vectors equally long, and the cosine is at least ``threshold``.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Links are between rows: rows
    that repeat, with the same id or another, are each other's links. ``component_id`` is the least id that links lead to; a
    row with a null id is one of its component, and has a null ``component_id`` only if no row of it has an id. ``kept`` is
    whether it is the row's own id, and false for null. Equal ids on different vectors are different rows. Other columns
    have no part; an empty table gives no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0, and 1 at most")
    rows = _rows(vectors, id_col, vector_col, label_col)
    entries = entries_of(rows)
    counts, links = Joined(entries.select("entry", "grp", "vector", "copies"), threshold).counts_and_links()
    joined = components(written(links, "tree_all_links"))
    about = entries.drop("vector").join(written(counts, "tree_counts"), "entry", "left")
    about = about.join(joined.withColumnRenamed("node", "entry"), "entry", "left")
    about = written(about.withColumn("component", F.coalesce("component", "entry")), "tree_about")
    least = about.groupBy("component").agg(F.min("id").alias("component_id"))
    about = about.join(least, "component").select(
        F.col("grp").alias("its_grp"), F.col("h1").alias("its_h1"), F.col("h2").alias("its_h2"),
        (F.coalesce("n", F.lit(1)) - 1).alias("n_links"), "component_id",
    )
    about = written(about, "tree_about")
    same = (F.col("grp") == F.col("its_grp")) & (F.col("h1") == F.col("its_h1")) & (F.col("h2") == F.col("its_h2"))
    out = rows.drop("vector").join(about, same, "left")
    component = F.when(F.col("its_grp").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def near_pairs(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """(a, b) of all links between different vectors, and the membership (id_col, entry) of rows in these vectors.

    Rows of one entry have equal vectors, and so link with each other. Odd rows are as ``near_vectors`` says.
    """
    rows = _rows(vectors, id_col, vector_col, label_col)
    entries = entries_of(rows)
    pairs = Joined(entries.select("entry", "grp", "vector", "copies"), threshold).pairs()
    keys = ["grp", "h1", "h2"]
    members = rows.drop("vector").join(entries.select("entry", *keys), keys, "left").select(F.col("id").alias(id_col), "entry")
    return pairs, members
