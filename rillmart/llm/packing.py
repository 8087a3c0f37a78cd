"""Variable-capacity best-fit packing of documents into sequences of a few permitted lengths.

Documents longer than the longest sequence are cut into pieces of that length and a rest. Pieces are dealt at random over
shards of bounded size, and each shard is packed by itself: pieces by falling size go to the open bin with the least room
that holds them. Where none does, a bin opens with the permitted length of least cost a token it can be expected to hold,
and in the end each bin shrinks to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import written

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_PIECES = 40_000  # of a shard, about


@dataclass(frozen=True)
class Cost:
    """Of a sequence of ``length`` tokens: a fixed part, one for each token, and attention's square."""

    fixed: float = 128.0
    square: float = 1 / 8192

    def of(self, length: int) -> float:
        return self.fixed + length + self.square * length * length


def pack(sizes: np.ndarray, capacities: tuple[int, ...], cost: Cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the final capacity of each bin."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    room: list[int] = []  # the different rooms of open bins, sorted
    by_room: dict[int, list[int]] = {}
    filled, opened = [], []
    left = int(sizes.sum())

    def put(b: int, space: int) -> None:
        if space not in by_room:
            by_room[space] = []
            insort(room, space)
        by_room[space].append(b)

    for at in order.tolist():
        size = int(sizes[at])
        k = bisect_left(room, size)
        if k < len(room):
            space = room[k]
            b = by_room[space].pop()
            if not by_room[space]:
                del by_room[space], room[k]
        else:
            fit = [c for c in capacities if c >= size]
            space = min(fit, key=lambda c: (cost.of(c) / max(1, min(c, left)), c))
            b = len(filled)
            filled.append(0)
            opened.append(space)
        bins[at], offsets[at] = b, filled[b]
        filled[b] += size
        left -= size
        put(b, space - size)
    steps = np.array(capacities)
    return bins, offsets, steps[np.searchsorted(steps, np.array(filled, dtype=np.int64))] if filled else np.zeros(0, dtype=np.int64)


def pack_documents(
    lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, id_col: str = "doc_id", size_col: str = "n_tokens",
    cost: Cost | None = None, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """doc_id, piece, piece_start, piece_tokens, bin_id, bin_capacity, bin_offset: where every token of every row goes.

    A null or negative length counts as 0; such rows get one piece of no tokens in some bin, so each row comes out at
    least once. Rows that repeat an id are packed each. An empty table gives no rows. No other column is read.
    """
    capacities = tuple(sorted(set(capacities)))
    if not capacities or capacities[0] < 1:
        raise ValueError("capacities must be positive")
    cost, longest = cost or Cost(), capacities[-1]
    size = F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0))
    rows = lengths.select(F.col(id_col).alias("doc_id"), size.alias("size"))
    pieces = rows.select(
        "doc_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("size") / longest) - 1, F.lit(0)))).alias("piece")
    ).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("piece_start"),
        F.least(F.lit(longest), F.col("size") - F.col("piece") * longest).cast("long").alias("piece_tokens"),
    )
    # numbers tell rows apart that repeat an id, so that many of them do not meet in one shard
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))

    def pack_shard(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["piece_tokens", "row"], ascending=[False, True], ignore_index=True)
        bins, offsets, final = pack(frame["piece_tokens"].to_numpy(), capacities, cost)
        return frame[["doc_id", "piece", "piece_start", "piece_tokens"]].assign(
            bin_id=(int(frame["shard"].iloc[0]) << 32) + bins, bin_capacity=final[bins], bin_offset=offsets
        )

    schema = "doc_id STRING, piece BIGINT, piece_start BIGINT, piece_tokens BIGINT, bin_id BIGINT, bin_capacity BIGINT, bin_offset BIGINT"
    shard = F.pmod(F.xxhash64("row"), F.lit(shards))
    # as text, since pandas has no integer column with nulls
    dealt = pieces.withColumns({"shard": shard, "doc_id": F.col("doc_id").cast("string")})
    packed = dealt.groupBy("shard").applyInPandas(pack_shard, schema)
    return packed.withColumn("doc_id", F.col("doc_id").cast(pieces.schema["doc_id"].dataType))


def token_count(tokenizer_file: str, text: Column) -> Column:
    """Number of ids of a text, and one more for its end; null is empty."""
    from rillmart.llm.token_files import PieceCounter

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(tokenizer_file)
        for texts in batches:
            yield pd.Series([n + 1 for n in counter.encode_all(texts.tolist())], dtype="int64")

    return count(text)
