"""Exact dedup, line dedup and near duplicates against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import ascii_lower, documents, nothing, texts
from oracle import compare, connect

from rillmart.llm import exact_dedup, line_dedup, minhash_forest
from rillmart.llm.components import components
from rillmart.llm.queries import REGISTRY, SQL

FOLDER = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(REGISTRY[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def largest(ids):
    return max((i for i in ids if i is not None), default=None)


@pytest.mark.parametrize("block_bytes", [3, 4096])
def test_exact_duplicates_of_odd_documents(spark, block_bytes):
    docs = [r for r in texts() if block_bytes > 100 or len(r[1] or "") < 1000]
    groups = defaultdict(list)
    for i, t, _ in docs:
        groups[ascii_lower(t or "")].append(i)
    want = Counter()
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = [largest(ids)]
        for i in ids:
            mine = i in kept
            kept = [] if mine else kept
            want[i, largest(ids), len(ids), mine, digest] += 1
    df = documents(spark) if block_bytes > 100 else documents(spark).where("text IS NULL OR length(text) < 1000")
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(df, block_bytes=block_bytes).collect())
    assert got == want
    assert sum(n for r, n in got.items() if r[3]) == len(groups)
    assert exact_dedup.exact_duplicates(nothing(spark)).count() == 0


def test_names_follow_no_hash(spark, monkeypatch):
    """Fingerprints that do not separate blocks are noticed, and another seed is taken."""
    real = exact_dedup.fingerprint
    monkeypatch.setattr(exact_dedup, "fingerprint", lambda c, seed=0: [f * 0 for f in real(c)] if seed == 0 else real(c, seed))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_duplicates(rows).collect()}
    assert got == {1: 3, 2: 2, 3: 3}


def test_lines_of_odd_documents(spark):
    docs, holders = texts(), defaultdict(list)
    key = lambda line: ascii_lower(line.strip(SPACES))
    for n, (i, t, _) in enumerate(docs):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                holders[k].append((n, i))
    repeated = {k: largest([i for _, i in h]) for k, h in holders.items() if len(h) >= 5}
    assert len(repeated) == 1
    want = Counter()
    for i, t, _ in docs:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in repeated or repeated[key(x)] == i]
        want[i, "\n".join(left), len(lines), len(lines) - len(left)] += 1
    left = line_dedup.repeated_lines(documents(spark), batches=3, fanout=2)
    got = Counter((r.doc_id, r.text, r["__n_lines"], r["__n_dropped"]) for r in left.collect())
    assert got == want
    assert left.columns[: len(documents(spark).columns)] == documents(spark).columns
    assert line_dedup.repeated_lines(nothing(spark)).count() == 0


def test_runs_are_compacted_by_level(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    line = "x" * 50
    for n in range(7):
        runs.add(spark.createDataFrame([(n, line)], "doc_id BIGINT, text STRING"))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert [r.top for r in runs.repeated(7).collect()] == [6] and runs.repeated(8).count() == 0
    late = runs.strip(spark.createDataFrame([(3, f"{line}\nb"), (6, line)], "doc_id BIGINT, text STRING"))
    assert {r.doc_id: r.text for r in late.collect()} == {3: "b", 6: line}
    with pytest.raises(ValueError):
        line_dedup.LineRuns(spark, fanout=1)


def plain_components(rows, words, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets.append((i, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()))
    group = list(range(len(sets)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[top(x)] = top(y)
    members = defaultdict(list)
    for x in range(len(sets)):
        members[top(x)].append(sets[x][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in members.items()}
    return Counter((i, len(s), least[top(x)]) for x, (i, s) in enumerate(sets))


def near_copies(seed):
    """Chains and crowds of variants around the threshold, which share passages with others."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage, rows = [word() for _ in range(60)], []
    for size in (2, 3, 5, 60):
        base = [word() for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(copy)
    rows += [passage + [word() for _ in range(rng.randrange(5, 80))] for _ in range(60)]
    rng.shuffle(rows)
    return [(n * 3, " ".join(r)) for n, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_around_the_threshold(spark, seed):
    rows = near_copies(seed)
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain_components(rows, 4, 80)


def crowded(seed):
    """One crowd of texts that are no links, in which some have a partner just over the threshold."""
    rng, rows = random.Random(seed), []
    word = lambda: f"w{rng.randrange(10**6)}"

    def changed(words, n):
        copy = list(words)
        for k in rng.sample(range(len(words) // 4), n):
            copy[4 * k] = word()
        return copy

    base = [word() for _ in range(280)]
    for _ in range(250):
        one = changed(base, 5)
        rows += [one, changed(one, 7)]
    rng.shuffle(rows)
    return [(n, " ".join(r)) for n, r in enumerate(rows)]


def test_links_in_a_crowd_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(minhash_forest, "BLOCK_SETS", 40)
    rows = crowded(1)
    want = plain_components(rows, 4, 80)
    assert len({c for _, _, c in want}) == 111
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want


def test_common_shingles_by_columns(monkeypatch):
    monkeypatch.setattr(minhash_forest, "COLUMNS", 3)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in (5, 30, 1, 12)]
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in (0, 2)] for i in (3, 1)]
    assert minhash_forest.common_shingles(sets, np.array([3, 1]), np.array([0, 2])).tolist() == want


def test_near_duplicates_of_odd_documents(spark):
    rows = [(i, t) for i, t, _ in texts()]
    got = minhash_forest.near_duplicates(documents(spark), words=5).collect()
    # without words a row is its own component, whatever its id
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 5, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = minhash_forest.without_near_duplicates(documents(spark), words=5)
    assert left.columns == documents(spark).columns
    kept = Counter((r.doc_id, r.text) for r in left.collect())
    assert max(kept.values()) == 1
    assert {i for i, _ in kept} == {r.doc_id for r in got if r.kept}
    assert minhash_forest.near_duplicates(nothing(spark)).count() == 0
    assert minhash_forest.without_near_duplicates(nothing(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 140)] + [(7, 7), (3, 2)]
    got = components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    want = {n: 0 for n in range(41)} | {n: 100 for n in range(100, 140)}
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_links_that_are_stars_take_no_rounds(spark, monkeypatch):
    from rillmart.llm import components as module

    kept, found = module.written, []
    monkeypatch.setattr(module, "written", lambda df, name: found.append(name) or kept(df, name))
    of = lambda links: {(r.node, r.component) for r in components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert of([]) == set() and of([(2, 1), (1, 2), (4, 3), (5, 3), (None, 7), (8, 8)]) == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)}
    assert len(found) == 2
    assert of([(2, 1), (3, 2), (9, 7), (9, 8), (4, 3)]) == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7)}


def test_no_new_links_leave_the_groups_as_they_are(spark, monkeypatch):
    groups = spark.createDataFrame([(b"a", b"a"), (b"b", b"a")], "node BINARY, component BINARY")
    monkeypatch.setattr(minhash_forest, "written", None)  # nothing is to be written
    assert minhash_forest._grown(groups, spark.createDataFrame([], "a BINARY, b BINARY")) is groups
