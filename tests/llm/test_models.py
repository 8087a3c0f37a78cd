"""Language identification and toxicity: the algorithms against plain versions, held-out accuracy, odd documents."""

import math

import numpy as np
import public_tokenizers
from odd import documents, nothing
from pyspark.sql import functions as F

from rillmart.llm import language_id, toxicity
from rillmart.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in all_segmentations(word[k:]):
            yield [word[:k], *rest]


def test_forward_sums_all_segmentations_and_learning_counts_them():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba"]
    lattice = language_id.Lattice(pieces)
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces) + 2, 2)) / 5
    p[lattice.none], p[lattice.letter] = 0, language_id.FLOOR
    for word in ("▁aba", "▁abc", "▁cab", "▁bbb"):
        row = lambda piece: pieces.index(piece) if piece in pieces else lattice.letter if len(piece) == 1 else lattice.none
        ways = [[row(x) for x in s] for s in all_segmentations(word)]
        want = [math.log(sum(math.prod(p[r, lang] for r in way) for way in ways)) for lang in range(2)]
        assert np.allclose(language_id.word_scores(lattice, p, [word, word]), [want, want])
        weights = np.array([math.prod(p[r, 0] for r in way) for way in ways])
        counts = np.zeros(len(p))
        for way, w in zip(ways, weights / weights.sum()):
            for r in way:
                counts[r] += 2 * w
        assert np.allclose(language_id._expected(lattice, p[:, 0], [word], np.array([2.0])), counts)


def test_long_runs_sum_all_segmentations():
    """Runs of 60 letters and more, against exact sums over all their segmentations."""
    from fractions import Fraction

    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "bbab"]
    lattice = language_id.Lattice(pieces)
    p = np.random.default_rng(4).random((len(pieces) + 2, 2)) / 5
    p[lattice.none], p[lattice.letter] = 0, language_id.FLOOR
    exact = [[Fraction(x) for x in column] for column in p.T]
    for letters in ("ab" * 30, "abbabbcb" * 10, "q" * 70, "a" * 17, "ba" * 8):
        word = language_id.START + letters
        want = []
        for column in exact:
            sums = [Fraction(1)]
            for end in range(1, len(word) + 1):
                cut = [(word[start:end], sums[start]) for start in range(max(0, end - 4), end)]
                rows = [(pieces.index(c) if c in pieces else lattice.letter if len(c) == 1 else lattice.none, s) for c, s in cut]
                sums.append(sum(column[r] * s for r, s in rows))
            want.append(math.log(sums[-1].numerator) - math.log(sums[-1].denominator))
        assert np.allclose(language_id.word_scores(lattice, p, [word]), [want], rtol=1e-12)
    assert list(language_id.marked_words("x" * 60 + " a½b ² Ⅷ ١ é")) == [START + "x" * 60, START + "a", START + "b", START + "é"]


START = language_id.START


def test_long_words_are_learned_from_like_short_ones(monkeypatch):
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba"]
    lattice = language_id.Lattice(pieces)
    p = np.random.default_rng(2).random(len(pieces) + 2) / 5
    p[lattice.none], p[lattice.letter] = 0, language_id.FLOOR
    words, counts = ["▁abcabab", "▁bbbbbab"], np.array([2.0, 3.0])
    plain = language_id._expected(lattice, p, words, counts)
    monkeypatch.setattr(language_id, "SHORT", 3)
    long = language_id._expected(lattice, p, words, counts)
    assert np.allclose(plain[: len(pieces)], long[: len(pieces)]) and np.isclose(plain[lattice.letter], long[lattice.letter])


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "½ ²"), (2, "Ⅷ"), (3, "word"), (4, "z" * 50_000), (5, "一" * 300)], "doc_id BIGINT, text STRING")
    labelled = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("some word", "en"), ("ein wort", "de")] * 3)], "doc_id BIGINT, text STRING, lang STRING")
    model = language_id.learn(labelled, PIECES)
    got = {r.doc_id: r["is"] for r in docs.select("doc_id", language_id.language(model, F.col("text")).alias("is")).collect()}
    assert [(got[i].lang, got[i].score) for i in (1, 2)] == [("und", 0.0)] * 2
    assert got[3].lang == "en" and all(got[i].lang in ("en", "de") and 0 <= got[i].score <= 1 for i in (4, 5))


def test_texts_sum_their_words_however_they_are_cut(monkeypatch):
    model = language_id.Model(["x"], language_id.letter_pieces(PIECES), None)
    model.probabilities = np.full((len(model.pieces) + 2, 1), 1e-5)
    text = "The quick brown fox, " * 5 + "q" * 60 + " 12 fox"
    whole, n = language_id.Scorer(model).totals([text, None, "", "7 !"])
    assert n.tolist() == [22, 0, 0, 0]  # a run of 60 letters is one word and whole[1:].sum() == 0
    monkeypatch.setattr(language_id, "FLUSH_WORDS", 3)
    monkeypatch.setattr(language_id, "KEPT_WORDS", 4)
    again, _ = language_id.Scorer(model).totals([text, None, "", "7 !"])
    assert np.allclose(whole, again)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = REGISTRY["op2_language_id"](spark, FOLDER).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and 0.2 < len(held) / len(rows) < 0.5
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_documents(spark):
    model = language_id.learn(documents(spark), PIECES)
    assert model.langs == ["de", "en", "fr"]
    rows = documents(spark).select("text", language_id.language(model, F.col("text")).alias("r")).collect()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.r.lang == "und") == (not letters) and (r.r.score > 0) == letters
    none = language_id.learn(nothing(spark), PIECES)
    got = documents(spark).select(language_id.language(none, F.col("text")).alias("r")).collect()
    assert {(r.r.lang, r.r.score) for r in got} == {("und", 0.0)}
    assert nothing(spark).select(language_id.language(model, F.col("text"))).count() == 0


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = "one two three two one two three four five " * 3
    whole = toxicity.Features().distinct(text)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 2)
    assert (toxicity.Features().distinct(text) == whole).all()
    assert not len(toxicity.Features().distinct(None)) and not len(toxicity.Features().distinct("12 !"))


def test_ftrl_follows_its_formula():
    """One coordinate and the bias, against the update written out."""
    rates = toxicity.Rates(alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    state = toxicity.Ftrl(rates, np.zeros(3), np.zeros(3))
    z = n = 0.0
    weight = lambda: 0.0 if abs(z) <= 0.1 else -(z - math.copysign(0.1, z)) / ((1 + math.sqrt(n)) / 0.5 + 0.2)
    for label in (1, 1, 0, 1):
        state.update(np.array([1]), label)
        w = weight()
        g = 1 / (1 + math.exp(-2 * w)) - label
        z, n = z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * w, n + g * g
    assert np.allclose(state.z, [0, z, z]) and np.allclose(state.n, [0, n, n])


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").dropna()
    rows = REGISTRY["op4_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    bad, good = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert sum(r.predicted for r in bad) / len(bad) > 0.6 and sum(r.predicted for r in good) / len(good) < 0.02


def test_toxicity_of_odd_documents(spark):
    marks = [(10, 1), (10, 0), (11, None), (None, 1), (20, 0), (2, 0), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id BIGINT, toxic INT").withColumn("text", F.lit("a clash"))
    model = toxicity.learn(documents(spark), labels)
    rows = documents(spark).select(toxicity.toxicity(model, F.col("text")).alias("p")).collect()
    assert len(rows) == documents(spark).count() and all(0 <= r.p <= 1 for r in rows)
    blank = toxicity.learn(documents(spark), labels.where("false"))
    assert not len(blank.at)
    assert {r.p for r in documents(spark).select(toxicity.toxicity(blank, F.col("text")).alias("p")).collect()} == {0.5}
    assert nothing(spark).select(toxicity.toxicity(model, F.col("text"))).count() == 0
