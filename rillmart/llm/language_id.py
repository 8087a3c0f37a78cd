"""Language identification by unigram pieces, summed over all segmentations.

Pieces are those of a fixed public vocabulary that consist of letters. Each language has a probability for each piece,
learned by expectation maximisation; a word's probability is the sum over all its segmentations into pieces, which the
forward algorithm adds up, and a text's is the product over its words. A word is a run of letters of any length, lower-cased and
marked at its start as the vocabulary does; digits, numerals and marks are no letters. The sums of long words are scaled on
the way, as they would leave the range of numbers.

Words are scored once per task and kept in a bounded table, many words of equal length at a time.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import held, written

WORD = re.compile(r"[^\W\d_]+")
START = "▁"  # how the vocabulary marks the start of a word
RESCALE = 16  # places after which sums are scaled; a place makes them at most 1e9 times smaller
SHORT = 24  # longer words are learned from by logarithms
FLOOR = 1e-9  # probability of a letter that is no piece, and of a piece not seen in a language
BASE = np.uint64(0x9E3779B97F4A7C15)
KEPT_WORDS = 200_000  # of a task's table of scored words
KEPT_LETTERS = 4_000_000  # of these words
GROUP_LETTERS = 1_500_000  # of words scored at once
FLUSH_WORDS = 100_000  # words of texts at once
ROWS_PER_LANG = 4_000  # bound of the rows learned from, by language
ROUNDS = 3


def letter_pieces(model_file: str) -> list[str]:
    """The pieces of lower-case letters of a sentencepiece vocabulary, in its order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return [p for p in pieces if (b := p.removeprefix(START)).isalpha() and b == b.lower() or p == START]


class Lattice:
    """Finds the pieces that end at each place of many words of one length."""

    def __init__(self, pieces: list[str]):
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.longest = max(map(len, pieces), default=1)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.none, self.letter = len(pieces), len(pieces) + 1  # rows after the pieces: no arc, a letter that is no piece
        self.powers = np.array([pow(int(BASE), k, 1 << 64) for k in range(self.longest + 1)], dtype=np.uint64)

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for c in piece:
            value = (value * int(BASE) + ord(c)) & ((1 << 64) - 1)
        return value

    def arcs(self, words: list[str], back: bool = False) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, row of each word's piece) by rising end, or ``back`` by falling start."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), n)
        sums = [np.zeros(len(words), dtype=np.uint64)]
        for j in range(n):
            sums.append(sums[-1] * BASE + codes[:, j])
        forth = ((start, end) for end in range(1, n + 1) for start in range(max(0, end - self.longest), end))
        back_again = ((start, end) for start in range(n - 1, -1, -1) for end in range(start + 1, min(n, start + self.longest) + 1))
        for start, end in back_again if back else forth:
            at = sums[end] - sums[start] * self.powers[end - start]
            place = np.minimum(np.searchsorted(self.hashes, at), len(self.hashes) - 1)
            other = self.letter if end - start == 1 else self.none
            yield start, end, np.where(self.hashes[place] == at, self.order[place], other)


@dataclass
class Model:
    langs: list[str]
    pieces: list[str]
    probabilities: np.ndarray  # a row for each piece, then the two rows of Lattice; a column for each language


def _by_length(words) -> Iterator[list[str]]:
    for _, group in itertools.groupby(sorted(words, key=len), key=len):
        group = list(group)
        many = max(1, min(50_000, GROUP_LETTERS // len(group[0])))
        for i in range(0, len(group), many):
            yield group[i : i + many]


def word_scores(lattice: Lattice, probabilities: np.ndarray, words: list[str]) -> np.ndarray:
    """Log-probability of each of the equally long words in each language: the forward algorithm.

    Of the sums only those are kept that a piece can still start from.
    """
    shape = (len(words), probabilities.shape[1])
    sums, scale, now, last = {0: np.ones(shape)}, np.zeros(shape), np.zeros(shape), 0
    for start, end, row in lattice.arcs(words):
        if end != last:
            if last and last % RESCALE == 0:
                scale += np.log(sums[last])
                sums = {at: x / sums[last] for at, x in sums.items()}
            sums.pop(end - lattice.longest - 1, None)
            sums[end], last = np.zeros(shape), end
        sums[end] += sums[start] * probabilities[row]
    return scale + np.log(sums[len(words[0])])


def _expected(lattice: Lattice, p: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected count of each row of ``p`` in one language: forward-backward over equally long words."""
    if len(words[0]) > SHORT:
        return _expected_long(lattice, np.log(np.maximum(p, 1e-300)), words, counts)
    arcs = list(lattice.arcs(words))
    forward = np.zeros((len(words[0]) + 1, len(words)))
    backward = np.zeros_like(forward)
    forward[0], backward[-1] = 1, 1
    for start, end, row in arcs:
        forward[end] += forward[start] * p[row]
    total = np.zeros(len(p))
    for start, end, row in sorted(arcs, key=lambda a: -a[0]):
        arc = p[row] * backward[end]
        backward[start] += arc
    for start, end, row in arcs:
        total += np.bincount(row, weights=forward[start] * p[row] * backward[end] / forward[-1] * counts, minlength=len(p))
    return total


def _expected_long(lattice: Lattice, logs: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """``_expected`` by logarithms, in which long words have probabilities, and without a list of all arcs."""
    forward, backward = np.full((len(words[0]) + 1, len(words)), -np.inf), np.full((len(words[0]) + 1, len(words)), -np.inf)
    forward[0], backward[-1] = 0, 0
    for start, end, row in lattice.arcs(words):
        forward[end] = np.logaddexp(forward[end], forward[start] + logs[row])
    for start, end, row in lattice.arcs(words, back=True):
        backward[start] = np.logaddexp(backward[start], backward[end] + logs[row])
    total = np.zeros(len(logs))
    for start, end, row in lattice.arcs(words):
        share = np.exp(forward[start] + logs[row] + backward[end] - forward[-1])
        total += np.bincount(row, weights=share * counts, minlength=len(logs))
    return total


def marked_words(text: str) -> Iterator[str]:
    for m in WORD.finditer(text.lower()):
        run = m.group()
        if run.isalpha():
            yield START + run
        else:  # numerals such as ½ or Ⅷ are of words but are no letters
            yield from (START + letters for letters in "".join(c if c.isalpha() else " " for c in run).split())


def _count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held("words of languages")
    seen: Counter = Counter()

    def flush():
        out = pd.DataFrame([(lang, word, n) for (lang, word), n in seen.items()], columns=["lang", "word", "n"])
        seen.clear()
        return out

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            words = marked_words(text)
            while block := list(itertools.islice(words, FLUSH_WORDS)):
                for word, n in Counter(block).items():
                    seen[lang, word] += n
                if len(seen) > KEPT_WORDS:
                    yield flush()
    yield flush()


def learn(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    rows_per_lang: int = ROWS_PER_LANG, rounds: int = ROUNDS,
) -> Model:
    """Learn piece probabilities from the rows with a text and a language.

    Of a language with more than ``rows_per_lang`` rows, a share chosen by a hash of id and text is used, of about that
    many rows. Languages with no letters in any of their rows are learned too, and lose to all others. The driver gets
    a number for each language and piece; all else stays in tasks.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    rows = rows.dropna(subset=["lang", "text"])
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs, pieces = sorted(sizes), letter_pieces(model_file)
    lattice = Lattice(pieces)
    table = np.full((len(pieces) + 2, len(langs)), 1.0 / max(len(pieces), 1))
    table[lattice.none], table[lattice.letter] = 0, FLOOR
    if not langs:
        return Model(langs, pieces, table)

    shares = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, rows_per_lang / sizes[lang]))])
    chosen = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30)
    counts = rows.where(chosen).select("lang", "text").mapInPandas(_count_words, "lang STRING, word STRING, n BIGINT")
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang_words")
    for _ in range(rounds):

        def expect(frames, table=table):
            total = np.zeros_like(table)
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    column, n = langs.index(lang), dict(zip(part["word"], part["n"], strict=True))
                    for words in _by_length(n):
                        total[:, column] += _expected(lattice, table[:, column], words, np.array([n[w] for w in words], dtype=float))
            piece, column = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": column, "n": total[piece, column]})

        sums = counts.mapInPandas(expect, "piece INT, lang INT, n DOUBLE").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        new = np.zeros_like(table)
        for r in sums.collect():
            new[r["piece"], r["lang"]] = r["n"]
        new[len(pieces) :] = 0
        table = np.maximum(new / np.maximum(new.sum(axis=0), 1), FLOOR)
        table[lattice.none], table[lattice.letter] = 0, FLOOR
    return Model(langs, pieces, table)


class Scorer:
    """Sums word scores of texts; keeps at most about ``KEPT_WORDS`` words."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self._forget()

    def _forget(self):
        self.place: dict[str, int] = {}
        self.letters = 0
        self.scores = np.zeros((0, len(self.model.langs)))

    def _learn(self, words: set[str]):
        fresh = words.difference(self.place)
        letters = sum(map(len, fresh))
        if len(self.place) + len(fresh) > KEPT_WORDS or self.letters + letters > KEPT_LETTERS:
            self._forget()
            fresh, letters = words, sum(map(len, words))
        self.letters += letters
        parts = [self.scores]
        for group in _by_length(fresh):
            self.place.update(zip(group, range(len(self.place), len(self.place) + len(group)), strict=True))
            parts.append(word_scores(self.lattice, self.model.probabilities, group))
        self.scores = np.concatenate(parts)

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each text in each language, and its number of words."""
        sums, counts = np.zeros((len(texts), len(self.model.langs))), np.zeros(len(texts), dtype=np.int64)
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def flush():
            self._learn(set().union(*(words for _, words in waiting)))
            for i, words in waiting:
                at = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
                sums[i] += self.scores[at].sum(axis=0)
                counts[i] += len(words)
            waiting.clear()

        for i, text in enumerate(texts):
            words = marked_words(text or "")
            while block := list(itertools.islice(words, FLUSH_WORDS)):
                waiting.append((i, block))
                size += len(block)
                if size >= FLUSH_WORDS:
                    flush()
                    size = 0
        flush()
        return sums, counts


def language(model: Model, text: Column) -> Column:
    """struct(lang, score): the likeliest language and its share of the probability of all learned ones.

    A null text, or one without letters, has ``und`` and 0, as has any text if no language was learned. Ties go to the
    language first in alphabetical order.
    """

    @F.pandas_udf("lang STRING, score DOUBLE")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held("words of languages")
        scorer = Scorer(model)
        names = np.array([*model.langs, "und"], dtype=object)
        for texts in batches:
            sums, counts = scorer.totals(texts.tolist())
            none = (counts == 0) | (len(model.langs) == 0)
            if len(model.langs):
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, share = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
            yield pd.DataFrame({"lang": names[np.where(none, len(names) - 1, best)], "score": np.where(none, 0.0, share)})

    return judge(text)
