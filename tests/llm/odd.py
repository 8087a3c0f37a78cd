"""Documents with everything that may go wrong, and small helpers."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, kept BOOLEAN, score DOUBLE, n INT,"
    " node STRING, name STRING, label STRING, id BIGINT, at BIGINT"
)
LINE = "this line is long enough to count as one that repeats over documents"


def ascii_lower(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def texts() -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "délta", "ÉPSILON", "zeta", "eta", "theta"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base = prose(60)
    rows = [(1, None, None), (2, "", "en"), (3, "  \n\t ", "fr"), (None, "a text without an id", "en"), (None, None, None)]
    rows += [(10, base, "en"), (11, base.upper().replace("É", "é"), "en"), (12, base, None), (13, base + " end", "en")]
    rows += [(20, "x", "de"), (20, "x", "de"), (20, "y", "de"), (None, "x", "de")]  # repeated rows and ids
    rows += [(30 + i, f"{prose(5)}\n  {LINE if i % 2 else LINE.upper()}\t\nlast {i}", "en") for i in range(6)]
    long = " ".join(prose(40) for _ in range(800))
    rows += [(50, long, "en"), (51, long + " and more", "en"), (52, "z" * 50_000, None), (53, "\n" * 5000, "en")]
    return rows


def documents(spark):
    rows = [(i, t, lang, "s", 7, True, 0.5, 3, "n", "m", "l", 9, 8) for i, t, lang in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
