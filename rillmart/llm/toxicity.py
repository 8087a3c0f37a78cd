"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, pairs of neighbours, and pairs with one word between. Each
coordinate has its own learning rate, and the L1 term leaves few weights other than zero, which are what scoring needs.
Labelled rows are dealt over shards; each shard goes through its rows in order, and after each round every coordinate's
state becomes the mean over the shards that touched it.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import held, written

WORD = re.compile(r"[^\W\d_]+")
BITS = 20
TRAIN_ROWS = 24_000  # bound of the labelled rows learned from
SHARDS, ROUNDS = 4, 3
KEPT_WORDS, BLOCK_WORDS = 200_000, 100_000
BLOCK = 1 << 14  # coordinates of a state that travel together
PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Rates:
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.1


class Features:
    """Hashes texts into feature numbers; keeps at most about ``KEPT_WORDS`` words."""

    def __init__(self, bits: int = BITS):
        self.shift, self.known = np.uint64(64 - bits), {}

    def _words(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = (zlib.crc32(b := w.encode("utf-8", "surrogatepass")) << 32) | zlib.crc32(b, 1)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def blocks(self, text: str | None) -> Iterator[np.ndarray]:
        """Feature numbers of the text, a bounded number of words at a time; numbers may repeat."""
        found = (m.group() for m in WORD.finditer((text or "").lower()))
        last = np.zeros(0, dtype=np.uint64)
        while block := list(itertools.islice(found, BLOCK_WORDS)):
            new = self._words(block)
            both = np.concatenate([last, new])
            fresh = len(last)  # pairs that end in a new word
            pairs = both[:-1] * PAIR + both[1:]
            skips = both[:-2] * SKIP + both[2:]
            numbers = np.concatenate([new, pairs[max(0, fresh - 1) :], skips[max(0, fresh - 2) :]])
            yield ((numbers * PAIR) >> self.shift).astype(np.int64)
            last = both[-2:]

    def distinct(self, text: str | None) -> np.ndarray:
        parts = [np.unique(b) for b in self.blocks(text)]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int64)


def _margin_to_probability(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


class Ftrl:
    """The state of one shard: z and n of each coordinate, and of a bias at the end."""

    def __init__(self, rates: Rates, z: np.ndarray, n: np.ndarray):
        self.rates, self.z, self.n = rates, z, n

    def weights(self, at) -> np.ndarray:
        r, z = self.rates, self.z[at]
        w = -(z - np.sign(z) * r.l1) / ((r.beta + np.sqrt(self.n[at])) / r.alpha + r.l2)
        return np.where(np.abs(z) <= r.l1, 0.0, w)

    def update(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = _margin_to_probability(w.sum()) - label  # every feature has the value 1
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.rates.alpha * w


@dataclass
class Model:
    bits: int
    at: np.ndarray  # coordinates with a weight
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.at] = self.weights
        return out


def _mean_of(before: np.ndarray):
    """Merges the shards' states of one block; coordinates count where a shard changed them."""

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["at"].iloc[0])
        zs, ns = (np.stack([np.frombuffer(x, dtype=np.float32) for x in frame[c]]) for c in ("z", "n"))
        touched = ns != before[block : block + BLOCK]
        many = np.maximum(1, touched.sum(axis=0))
        z, n = ((np.where(touched, x, 0).sum(axis=0) / many).astype(np.float32) for x in (zs, ns))
        return pd.DataFrame({"at": [block], "any": [touched.any(axis=0).tobytes()], "z": [z.tobytes()], "n": [n.tobytes()]})

    return mean


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS, shards: int = SHARDS, rounds: int = ROUNDS, bits: int = BITS, rates: Rates | None = None,
) -> Model:
    """Fit to the texts that have a label.

    Null ids and null labels are left out; the label of an id with several is the largest. Of more than ``train_rows``
    labelled ids, a share chosen by a hash of the id is used, of about that many. With no labelled row all weights are 0.
    The driver gets the mean state, of 2^bits coordinates, after each round.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    marks = marks.groupBy("id").agg(F.max("label").alias("label"))
    share = min(1.0, train_rows / max(1, marks.count()))
    chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(chosen)
    rows = texts.join(marks.where(chosen), "id").select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), F.xxhash64("id", "text").alias("turn"), "text", "label"
    )
    rates = rates or Rates()
    size = (1 << bits) + 1

    rows = written(rows, "toxicity_rows")
    z, n = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
    for _ in range(rounds):

        def go(frames, z=z, n=n):
            held("words of toxicity")
            features, states = Features(bits), {}
            for frame in frames:
                for shard, label, text in zip(frame["shard"], frame["label"], frame["text"], strict=True):
                    if shard not in states:
                        states[shard] = Ftrl(rates, z.astype(np.float64), n.astype(np.float64))
                    states[shard].update(features.distinct(text), label)
            for state in states.values():
                new_z, new_n = state.z.astype(np.float32), state.n.astype(np.float32)
                for block in range(0, size, BLOCK):
                    cut = slice(block, block + BLOCK)
                    if (new_n[cut] != n[cut]).any():
                        yield pd.DataFrame({"at": [block], "z": [new_z[cut].tobytes()], "n": [new_n[cut].tobytes()]})

        ordered = rows.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "turn")
        states = ordered.mapInPandas(go, "at INT, z BINARY, n BINARY").groupBy("at")
        states = states.applyInPandas(_mean_of(n), "at INT, any BINARY, z BINARY, n BINARY")
        z, n = z.copy(), n.copy()
        for r in states.collect():
            touched = np.frombuffer(r["any"], dtype=bool)
            for state, new in ((z, r["z"]), (n, r["n"])):
                state[r["at"] : r["at"] + BLOCK][touched] = np.frombuffer(new, dtype=np.float32)[touched]
    w = Ftrl(rates, z.astype(np.float64), n.astype(np.float64)).weights(slice(None))
    at = np.nonzero(w[:-1])[0]
    return Model(bits, at, w[at], float(w[-1]))


def toxicity(model: Model, text: Column) -> Column:
    """Probability that a text is toxic. Null and empty texts get that of a text without features."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held("words of toxicity")
        features, weights = Features(model.bits), model.dense()
        for texts in batches:
            out = []
            for text in texts:
                some = [np.unique(b[weights[b] != 0]) for b in features.blocks(text)]
                at = np.unique(np.concatenate(some)) if some else np.zeros(0, dtype=np.int64)
                out.append(_margin_to_probability(weights[at].sum() + model.bias))
            yield pd.Series(out, dtype="float64")

    return score(text)
