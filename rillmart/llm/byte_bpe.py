"""Byte-level BPE with Spark's higher-order functions, and decoding.

A word is a string with one character for each of its bytes, its parts are ranks. A fold merges adjacent parts, least rank
first, until no pair has a rank. What pairs join to is a literal map: as Spark searches a map from its start, it is an array
of short lists by the key's remainder, bound once to a lambda variable. The distinct words that are most frequent in a
bounded sample of texts are folded once and become a second literal of bounded size; other words are folded where
they occur, so no result depends on the sample.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NONE = 2**31 - 1  # rank of a pair that does not join
SAMPLE_ROWS = 20_000  # bound of the texts that frequent words are taken from
FREQUENT = 1 << 16  # bound of the words that are folded once
TABLES = "struct<joins:array<array<bigint>>,bytes:array<bigint>,words:array<map<string,string>>,pieces:array<string>>"


def ranks_of(tiktoken_file: str) -> dict[bytes, int]:
    with open(tiktoken_file, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bytes_as_text(text: Column) -> Column:
    """One character for each byte."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


class BytePairs:
    """Encoder and decoder for a rank file and a pattern of Java's dialect that cuts texts into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # Java's \\s is ASCII only
        self.pattern = pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")
        self.base = max(ranks.values(), default=0) + 1
        joins = {
            ranks[piece[:i]] * self.base + ranks[piece[i:]]: rank
            for piece, rank in ranks.items()
            for i in range(1, len(piece))
            if piece[:i] in ranks and piece[i:] in ranks
        }
        self.n_joins = 2 * len(joins) + 1
        lists: list[list[int]] = [[] for _ in range(self.n_joins)]
        for key, rank in joins.items():
            lists[key % self.n_joins] += [key + NONE, rank]  # a key so large is never taken for a rank
        pieces = [""] * self.base
        for piece, rank in ranks.items():
            pieces[rank] = piece.decode("latin-1")
        self.tables = {"joins": lists, "bytes": [ranks[bytes([i])] for i in range(256)], "pieces": pieces}
        self.words = {piece.decode("latin-1"): str(rank) for piece, rank in ranks.items()}  # a whole word with a rank is one part

    def _literal(self) -> Column:
        """All tables as one value; the JSON is parsed when the plan is made."""
        self.n_words = 2 * len(self.words) + 1
        parts: list[dict] = [{} for _ in range(self.n_words)]
        for word, ids in self.words.items():
            parts[zlib.crc32(word.encode()) % self.n_words][word] = ids
        return F.from_json(F.lit(json.dumps({**self.tables, "words": parts})), TABLES)

    def _word(self, tables: Column, word: Column) -> Column:
        part = F.get(tables["words"], (F.crc32(word.cast("binary")) % self.n_words).cast("int"))
        return F.coalesce(F.element_at(part, word), self._fold(tables, word))

    def _rank(self, tables: Column, left: Column, right: Column) -> Column:
        def find(key: Column) -> Column:
            entries = F.get(tables["joins"], (key % self.n_joins).cast("int"))
            return F.coalesce(_let(entries, lambda e: F.get(e, F.array_position(e, key + NONE).cast("int"))), F.lit(NONE))

        # array_position is 1-based, so it is the place of the value; a key that is not there gives another key
        return _let(left * self.base + right, lambda key: _let(find(key), lambda r: F.when(r < NONE, r).otherwise(NONE)))

    def _fold(self, tables: Column, word: Column) -> Column:
        """The ids of a word, joined by spaces."""
        places = F.sequence(F.lit(1), F.char_length(word))
        parts = F.transform(places, lambda i: F.get(tables["bytes"], F.ascii(F.substring(word, i, F.lit(1)))))

        def start(parts: Column) -> Column:
            ranks = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p, i: self._rank(tables, F.get(parts, i), p))
            return F.struct(parts.alias("parts"), ranks.alias("ranks"))

        def merge(state: Column, _: Column) -> Column:
            def step(least: Column) -> Column:
                return F.when(F.coalesce(least, F.lit(NONE)) >= NONE, state).otherwise(self._merge(tables, state, least))

            return _let(F.array_min(state["ranks"]), step)

        folded = _let(parts, lambda p: F.aggregate(places, start(p), merge, lambda state: state["parts"]))
        return F.array_join(folded.cast("array<string>"), " ")

    def _merge(self, tables: Column, state: Column, least: Column) -> Column:
        """Merge the first pair of the least rank, and look up the two pairs that are new."""
        parts, ranks = state["parts"], state["ranks"]

        def at(i: Column) -> Column:
            merged = F.filter(F.transform(parts, lambda p, j: F.when(j == i, least).otherwise(p)), lambda p, j: j != i + 1)
            left, right = self._rank(tables, F.get(parts, i - 1), least), self._rank(tables, least, F.get(parts, i + 2))
            changed = F.transform(ranks, lambda r, j: F.when(j == i - 1, left).when(j == i + 1, right).otherwise(r))
            return F.struct(merged.alias("parts"), F.filter(changed, lambda r, j: j != i).alias("ranks"))

        return _let((F.array_position(ranks, least) - 1).cast("int"), at)

    def words_of(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def learn_frequent(self, docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, frequent: int = FREQUENT) -> None:
        """Fold the ``frequent`` most frequent words of a hash sample of about ``sample_rows`` texts, and keep them as a literal."""
        share = min(1.0, sample_rows / max(1, docs.count()))
        chosen = docs.where(F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) < int(share * (1 << 30)))
        counts = chosen.select(F.explode(self.words_of(F.col(text_col))).alias("word")).groupBy("word").count()
        top = counts.orderBy(F.desc("count"), "word").limit(frequent).select(bytes_as_text(F.col("word")).alias("word"))
        top = top.repartition(docs.sparkSession.sparkContext.defaultParallelism)
        folded = top.select("word", _let(self._literal(), lambda t: self._word(t, F.col("word"))).alias("ids"))
        self.words |= {r["word"]: r["ids"] for r in folded.toLocalIterator()}

    def encode(self, text: Column) -> Column:
        """The text's ids, joined by spaces; null is empty."""
        words = F.transform(self.words_of(text), bytes_as_text)
        return _let(self._literal(), lambda t: F.array_join(F.transform(words, lambda w: self._word(t, w)), " "))

    def decode(self, ids: Column) -> Column:
        """The bytes that ids, joined by spaces, stand for."""
        pieces = F.from_json(F.lit(json.dumps(self.tables["pieces"])), "array<string>")
        parts = _let(pieces, lambda p: F.transform(F.split(ids, " ", -1), lambda i: F.get(p, i.cast("int"))))
        return F.when(ids == "", F.lit(b"")).otherwise(F.encode(F.array_join(parts, ""), "ISO-8859-1"))


def encoded(docs: DataFrame, tiktoken_file: str, pattern: str, text_col: str = "text", frequent: int = FREQUENT) -> tuple[DataFrame, BytePairs]:
    """``docs`` with the column ``token_ids``, decimal ids joined by one space, and the encoder, which decodes them.

    Null and empty texts have no ids. Rows are encoded each by itself, so nulls and repeated rows in other columns do not
    matter. A word of n bytes takes n steps over at most n parts; very long words are slow, but right.
    """
    pairs = BytePairs(ranks_of(tiktoken_file), pattern)
    pairs.learn_frequent(docs.select(text_col), text_col, frequent=frequent)
    return docs.withColumn("token_ids", pairs.encode(F.col(text_col))), pairs
