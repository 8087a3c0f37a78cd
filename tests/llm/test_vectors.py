"""Near vectors and vector codes against plain versions."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import cover_tree, vector_codes
from rillmart.llm.queries import REGISTRY

ODD = [
    (1000, None, "a"), (1001, [], "a"), (1002, [0.0] * 4, "a"), (1003, [1.0, None, 0.0, 0.0], "a"), (1004, [math.nan, 1.0, 0.0, 0.0], "a"),
    (1005, [math.inf, 0.0, 0.0, 0.0], "a"), (1006, [1.0, 2.0], "a"), (1007, [1.0, 2.0], "a"), (None, [1.0, 1.0, 1.0, 1.0], "a"),
    (1008, [1.0, 1.0, 1.0, 1.0], "a"), (1009, [1.0, 1.0, 1.0, 1.0], None), (1010, [1e-200, 1e-200, 1e-200, 1e-200], "a"),
    (1011, [1e300, 1e300, 1e300, 1.1e300], "a"), (1012, [-0.0, 1.0, 0.0, 0.0], "b/c#"), (1013, [0.0, 1.0, 0.0, 0.0], "b/c#"),
    (1013, [0.0, 1.0, 0.0, 0.0], "b/c#"), (1013, [0.0, -1.0, 0.0, 0.0], "b/c#"), (None, [0.0, 0.0, 1.0, 0.0], "b/c#"), (None, None, None),
]


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label STRING").repartition(3)
    return df.withColumns({"id": F.lit(1), "node": F.lit("n"), "entry": F.lit(2), "grp": F.lit("g"), "row": F.lit(4), "copies": F.lit(5)})


# ---- near vectors ------------------------------------------------------------------------------


def plain_near(rows, threshold):
    """(id, links, component, kept) of rows, by comparing all of them."""
    good = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    parts = [i for i, (_, v, label) in enumerate(rows) if good(v) and label is not None]
    unit = {}
    for i in parts:
        v = np.array(rows[i][1]) / np.abs(rows[i][1]).max()
        unit[i] = v / np.sqrt((v * v).sum())
    linked = {i: {j for j in parts if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold} for i in parts}
    out = []
    for i, (row_id, _, _) in enumerate(rows):
        if i not in linked:
            out.append((row_id, 0, row_id, row_id is not None))
            continue
        seen, edge = {i}, [i]
        while edge:
            new = linked[edge.pop()] - seen
            seen |= new
            edge += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((row_id, len(linked[i]), least, row_id is not None and row_id == least))
    return sorted(map(str, out))


def crowded(rng, n, size=4):
    """Crowds of several widths, strays, chains and copies."""
    def around(centre, width):
        return [x + rng.gauss(0, width) for x in centre]

    rows, centres = [], [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    for i in range(n):
        kind = i % 10
        v = [rng.gauss(0, 1) for _ in range(size)] if kind < 3 else around(centres[kind - 4], (0.02, 0.1, 0.2, 0.3, 0.5, 0.05)[kind - 4])
        rows.append((i, v, "a" if kind < 8 else "b/c#"))
    rows += [(n + i, [math.cos(i * 0.3), math.sin(i * 0.3), 0.0, 0.0][:size] + [0.0] * (size - 4), "a") for i in range(12)]
    return rows + [(2 * n + i, rows[5][1], rows[5][2]) for i in range(30)]


@pytest.mark.parametrize("block,threshold", [(8, 0.93), (64, 0.995)])
def test_near_vectors_of_odd_and_crowded_tables(spark, monkeypatch, block, threshold):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "SAMPLE", 2 * block)
    monkeypatch.setattr(cover_tree, "DEALT", 50)
    rows = crowded(random.Random(block), 260) + ODD
    got = [tuple(r) for r in cover_tree.near_vectors(table(spark, rows), threshold).collect()]
    assert sorted(map(str, got)) == plain_near(rows, threshold)


def test_pairs_are_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", 16)
    rows = crowded(random.Random(2), 200)
    pairs, members = cover_tree.near_pairs(table(spark, rows), 0.95)
    entry = {r.vec_id: r.entry for r in members.collect()}
    got = [(r.a, r.b) for r in pairs.collect()]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: x for i, _, x in rows}
    want = {(min(entry[i], entry[j]), max(entry[i], entry[j])) for i in unit for j in unit if label[i] == label[j] and unit[i] @ unit[j] >= 0.95}
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in want if a != b}


def test_a_tight_crowd_is_not_listed(spark):
    """All links of a crowd that one ball proves are counted by node; no block is compared."""
    rng = random.Random(1)
    rows = [(i, [1.0 + rng.gauss(0, 0.01) for _ in range(4)], "a") for i in range(1500)]
    entries = cover_tree.entries_of(cover_tree._rows(table(spark, rows), "vec_id", "embedding", "label"))
    joined = cover_tree.Joined(entries.select("entry", "grp", "vector", "copies"), 0.93)
    assert joined.met == 0 and joined.alike.count() >= 1
    counts, links = joined.counts_and_links()
    assert {r.n for r in counts.collect()} == {1500} and links.count() < 3 * 1500


def test_far_crowds_do_not_meet(spark):
    """Twelve crowds on the axes: blocks of different crowds are pruned by their balls."""
    rng = random.Random(6)
    axes = [[(1.0 if i == k else 0.0) + rng.gauss(0, 0.05) for i in range(12)] for k in range(12) for _ in range(200)]
    rows = [(n, v, "a") for n, v in enumerate(axes)]
    entries = cover_tree.entries_of(cover_tree._rows(table(spark, rows), "vec_id", "embedding", "label"))
    joined = cover_tree.Joined(entries.select("entry", "grp", "vector", "copies"), 0.93)
    balls = lambda c: c.split("#")[0]
    assert joined.blocks.count() >= 12
    assert all(balls(r.a) == balls(r.b) or "rest" in r.a + r.b for r in joined.meet.collect())
    assert sorted(str(tuple(r)) for r in cover_tree.near_vectors(table(spark, rows)).collect()) == plain_near(rows, 0.93)


def test_no_vectors(spark):
    assert cover_tree.near_vectors(table(spark, ODD).where("false")).count() == 0
    alone = [tuple(r) for r in cover_tree.near_vectors(table(spark, ODD[:6])).collect()]
    assert sorted(map(str, alone)) == plain_near(ODD[:6], 0.93)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/check_s"])
def test_query_11(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    got = REGISTRY["op11_near_vectors"](spark, folder).toPandas().set_index("vec_id")
    assert len(got) == len(df)
    for _, part in df.groupby("label"):
        x, ids = np.stack(part["embedding"]).astype(np.float64), part["vec_id"].to_numpy()
        x /= np.sqrt((x**2).sum(axis=1))[:, None]
        linked = x @ x.T >= 0.93
        np.fill_diagonal(linked, True)
        least = ids.copy()
        while True:
            new = np.where(linked, least[None], ids.max() + 1).min(axis=1)
            if (new == least).all():
                break
            least = new
        mine = got.loc[ids]
        assert (mine["n_links"].to_numpy() == linked.sum(axis=1) - 1).all()
        assert (mine["component_id"].to_numpy() == least).all()
        assert (mine["kept"].to_numpy() == (least == ids)).all()


# ---- vector codes --------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, size):
    good = [r for r in rows if r[1] and len(r[1]) == size and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-size // parts)
    whole = lambda v: [max(-(1 << 22), min(1 << 22, math.floor(max(-1e9, min(1e9, x)) * 4096))) for x in v] + [0] * (width * parts - size)
    cut = [[whole(r[1])[p * width : (p + 1) * width] for p in range(parts)] for r in good]
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, whole(good[i][1])))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    off = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min((off(x[p], e), n) for n, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for n in range(len(books[p])):
                mine = [x[p] for x, a in zip(cut, near, strict=True) if a[p][1] == n]
                if mine:
                    books[p][n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    near = assign()
    errors = [sum(d for d, _ in a) for a in near]
    total = {}
    for r, e in zip(good, errors, strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(str((r[0], "".join(f"{n:02x}" for _, n in a), e, total[r[2]], digest)) for r, a, e in zip(good, near, errors, strict=True))


@pytest.mark.parametrize("parts,entries,size", [(2, 16, 4), (3, 5, 4), (4, 1, 4)])
def test_codes_of_odd_tables(spark, parts, entries, size):
    rows = [(r[0] and r[0] + 2000, *r[1:]) for r in crowded(random.Random(9), 150)] + ODD + [(3, [1.0, -2.0, 0.5, 0.25], None)] * 40
    rows += [(5, [0.5, 0.25, 1.0, 1.0], "a"), (5, [0.5, 0.2, 1.0, 1.0], "a"), (None, [-0.3, -0.00001, 0.0, 0.3], "a")]
    got, books = vector_codes.vector_codes(table(spark, rows), parts=parts, entries=entries, rounds=4, owned=64)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_codes(rows, parts, entries, 4, size)
    assert len(books) == parts and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_of_few_rows_and_none(spark):
    rows = [(7, [0.5, 1.0], "a"), (8, [0.5, 1.0], "a"), (9, [], None)]
    got, _ = vector_codes.vector_codes(table(spark, rows))
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_codes(rows, 8, 16, 6, 2)
    none, books = vector_codes.vector_codes(table(spark, ODD[:2] + ODD[3:6]))
    assert none.count() == 0 and books == [] and none.columns == got.columns


def test_only_movers_are_shuffled(spark):
    state = vector_codes._State(spark, 8)
    part = [(F.col("id") * (i + 3) % 17 * 10).alias(f"p{i}") for i in range(2)]
    rows = spark.range(1000).select(F.col("id").alias("row"), (F.col("id") % 2).cast("int").alias("position"), *part, F.lit(0).alias("salt"), F.lit(0).alias("entry"))
    here = state.put(rows.where("false"), rows)
    summed = vector_codes.resident_sums(here, 2)._jdf.queryExecution().executedPlan().toString()
    # owners sum without a shuffle; the one there is carries a row for each owner
    assert summed.count("Exchange") == 1 and "Bucketed: true" in summed and "salt" not in summed.split("Exchange")[1].split("]")[0]
    books = [[[0, 0], [100, 100]], [[0, 0], [50, 150]]]
    stays, moves = vector_codes.stays_and_moves(here, books, 2)
    assert "Exchange" not in stays._jdf.queryExecution().executedPlan().toString()
    left, gone = stays.count(), moves.count()
    assert left and gone and left + gone == 1000
    new = state.put(stays, moves)
    assert new.count() == 1000 and new.where("entry = 1").count() == gone
    state.forget(state.name)


def test_query_12(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    sample = sorted(rows)[:400]
    df = spark.createDataFrame(sample, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    got, _ = vector_codes.vector_codes(df)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_codes(sample, 8, 16, 6, 64)
    assert REGISTRY["op12_vector_codes"](spark, folder).count() == len(rows)
