"""URL rules and nearest neighbours against plain versions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import multi_index, url_filters
from rillmart.llm.queries import REGISTRY

RULES = [
    ("net", "/", "block"), ("Example.net", "/en/", "allow"), ("example.net", "/en/deep/x", "block"), ("a.b.example.org", "", "block"),
    ("org", "/fr", "allow"), ("example.org", "/fr", "block"), ("x.org", "/a/b/c/d/e", "block"), ("dup.com", "/", "block"),
    ("dup.com", "/", "allow"), ("", "/local", "block"), (None, "/", "block"), ("y.com", None, "block"),
]
URLS = [
    "http://example.net", "http://example.net/", "HTTP://www.EXAMPLE.net/en/1?x=/en/", "https://example.net/en/deep/xyz#a", "http://notexample.net/en/",
    "http://a.b.example.org", "http://z.a.b.example.org?q", "http://b.example.org/fr", "http://q.org/french/", "http://x.org/a/b/c/d/e/f",
    "http://dup.com/", "ftp:///local/x", "no scheme", "", None, "http://h.net:80/en/", "http://h.net/a://b/", "a://b.net//", "http://é.NET/Ä?\n#",
    "http://" + ".".join("abc"[i % 3] for i in range(300)) + ".net/" + "d/" * 300,
]


def plain_judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(h.lower(), p, v) for h, p, v in RULES if h is not None and p is not None]
    fit = [(h, p, v) for h, p, v in fit if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else "allow")


def test_urls_against_a_plain_judge(spark):
    pages = spark.createDataFrame([(n % 7 or None, u, "b", "h") for n, u in enumerate(URLS + URLS[:3])], "page_id BIGINT, url STRING, best STRING, host STRING")
    rules = spark.createDataFrame(RULES + RULES[:2], "host STRING, path STRING, verdict STRING")
    got = sorted(map(str, (tuple(r) for r in url_filters.judge_urls(pages, rules).collect())))
    assert got == sorted(str((n % 7 or None, *plain_judge(u))) for n, u in enumerate(URLS + URLS[:3]))
    assert url_filters.judge_urls(pages.where("false"), rules).count() == 0
    none = url_filters.judge_urls(pages, rules.where("false"), default="block").collect()
    assert len(none) == pages.count() and {(r.rule, r.verdict) for r in none} == {(None, "block")}


def plain_nearest(rows, k, every):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 4]
    out = {}
    for i, v in good:
        if i % every == 0:
            scored = sorted({(-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i})
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def test_odd_vectors_ties_and_copies(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(-3, 4)) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 0.0, -1.0]) for i in range(40)]  # copies: ties
    rows += [(1000, None), (1001, []), (1002, [0.0] * 4), (1003, [1.0, None, 0.0, 0.0]), (1004, [math.nan, 1.0, 0.0, 0.0])]
    rows += [(1005, [math.inf, 0.0, 0.0, 0.0]), (1006, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (140, [-0.0, 0.0, 1.0, 0.0]), (140, [0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumns({"i": F.lit(1), "rank": F.lit("r"), "score": F.lit(2)})
    got = {}
    found = multi_index.nearest(df, F.col("vec_id") % 5 == 0, k=6, target=1.0).orderBy("query_id", "rank").collect()
    for r in found:
        got.setdefault(r.query_id, []).append((r.id, r.score))
    want = plain_nearest(rows, 6, 5)
    assert got.keys() == want.keys()
    right = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert right >= 0.9 * sum(map(len, want.values()))
    vectors = dict(rows)
    for q, hits in got.items():
        assert len(hits) == 6 and hits == sorted(hits, key=lambda h: (-h[1], h[0])) and q not in {j for j, _ in hits}
        assert all(s == sum(a * b for a, b in zip(vectors[q], vectors[j])) for j, s in hits)
    few = multi_index.nearest(df.where("vec_id < 5"), F.col("vec_id") == 0, k=20).collect()
    assert len(few) == len(plain_nearest(rows[:5], 20, 5)[0])
    assert multi_index.nearest(df.where("false"), F.lit(True)).count() == 0
    assert multi_index.nearest(df.where("vec_id >= 1000 AND vec_id < 1003"), F.lit(True)).count() == 0
    assert multi_index.nearest(df, F.lit(False)).count() == 0


def test_a_repeated_row_hides_no_other_id(spark):
    rows = [(1, [1.0, 2.0])] * 25 + [(i, [1.0, 2.0]) for i in (2, 3, 4, 4, 4)] + [(9, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = multi_index.nearest(df, F.col("vec_id").isin(1, 9), target=1.0).collect()
    got = {q: [r.id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (1, 9)}
    assert got == {1: [2, 3, 4, 9], 9: [1, 2, 3, 4]}


def test_ids_on_many_vectors_leave_room_for_others(spark):
    rows = [(1, [10.0 + n, 1.0]) for n in range(12)] + [(2, [9.0, 1.0 + n]) for n in range(12)]
    rows += [(i, [1.0 + i / 10, 0.5]) for i in range(3, 9)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = multi_index.nearest(df, F.col("vec_id") == 1, k=4, target=1.0).orderBy("rank").collect()
    assert [(r["rank"], r.id) for r in found] == [(1, 2), (2, 8), (3, 7), (4, 6)]
    assert found[0].score == 21.0 * 9 + 12 and found[1].score == 21 * 1.8 + 0.5


def test_heap_visits_pairs_by_rising_distance():
    rng = np.random.default_rng(3)
    a, b = rng.random(7), rng.random(5)
    pairs = list(multi_index.traverse(a, b))
    assert len(set(pairs)) == 35
    sums = [a[i] + b[j] for i, j in pairs]
    assert sums == sorted(sums)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x, ids = np.stack(table["embedding"]).astype(np.float64), table["vec_id"].to_numpy()
    rows = REGISTRY["op10_multi_index"](spark, folder).toPandas()
    assert (rows.groupby("query_id")["rank"].apply(lambda r: sorted(r) == list(range(1, 21)))).all()
    hit, queries = 0, np.nonzero(ids % 20 == 0)[0]
    for q in queries:
        scores = x @ x[q]
        scores[q] = -np.inf
        best = set(ids[np.argsort(-scores, kind="stable")[:20]])
        hit += len(best & set(rows.loc[rows["query_id"] == ids[q], "vec_id"]))
    assert rows["query_id"].nunique() == len(queries) and hit >= 0.9 * 20 * len(queries)
