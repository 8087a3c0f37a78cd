"""Headers and lines of an order that wait for each other, where each new line restarts the wait of the lines before it.

A plain stream-stream join bounds the time between a header and each line. Here, as long as lines keep coming, those that
wait go on waiting: they are given up when no line has come for 24 hours. That needs state of one's own with timeouts. Rows pass
through it as JSON text, which holds every number exactly. A key of the state is a bucket of orders, not an order: each call of
the function costs a millisecond or two, whatever rows it has, so a call had better have the rows of many orders.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WAIT_MS = 24 * 3600 * 1000  # fixed value: how long a header or the lines of an order wait
BUCKETS = 4096  # keys of the state; each holds the orders of its share of the hashes
OUT = "line STRING, line_at BIGINT, header STRING, header_at BIGINT"
STATE = "size BIGINT, orders BINARY"
NOTHING = (None, None, None, None, [])

# what waits of an order: its header, when that came and until when it waits; until when its lines wait, and the lines with their times
Waiting = tuple[str | None, int | None, int | None, int | None, list[tuple[str, int]]]
Found = tuple[str, int, str | None, int | None]


def _of_order(waiting: Waiting, came: Iterable[tuple[int, int, str]], out: list[Found]) -> Waiting:
    """One order after rows have come, as ``(at, kind, row)`` in the order of arrival; what comes at the same time finds its header."""
    header, header_at, until, lines_until, lines = waiting
    lines = list(lines)
    for at, kind, row in came:
        if kind == 1 and header is not None and until >= at:
            out.append((row, at, header, header_at))
            continue
        late = lines_until is not None and lines_until < at  # the wait of the lines ended before
        if kind == 0 or late:
            out += [(line, line_at, None, None) if late else (line, line_at, row, at) for line, line_at in lines]
            lines_until, lines = None, []
        if kind == 0:
            header, header_at, until = row, at, at + WAIT_MS
        else:
            lines.append((row, at))
            lines_until = at + WAIT_MS
    return header, header_at, until, lines_until, lines


def _given_up(waiting: Waiting, now: int, out: list[Found]) -> Waiting:
    """One order without what has waited long enough as of the watermark."""
    header, header_at, until, lines_until, lines = waiting
    if lines_until is not None and lines_until < now:
        out += [(line, line_at, None, None) for line, line_at in lines]
        lines_until, lines = None, []
    if until is not None and until < now:
        header = header_at = until = None
    return header, header_at, until, lines_until, lines


def order_wait(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The orders of one bucket: rows that came first, then what the watermark has passed. The state is read and written once."""
    orders: dict[object, Waiting] = {}
    if state.exists:
        size, packed = state.get
        orders = pickle.loads(pa.decompress(packed, size, codec="zstd"))
    out: list[Found] = []
    if not state.hasTimedOut:
        rows = [r for f in frames for r in zip(f["order_id"].tolist(), f["at"].tolist(), f["kind"].tolist(), f["row"].tolist())]
        rows.sort()
        for order, came in groupby(rows, key=lambda r: r[0]):
            orders[order] = _of_order(orders.get(order, NOTHING), (r[1:] for r in came), out)
    now = state.getCurrentWatermarkMs()
    orders = {order: _given_up(waiting, now, out) for order, waiting in orders.items()}
    orders = {order: waiting for order, waiting in orders.items() if waiting[2] is not None or waiting[3] is not None}
    if orders:
        whole = pickle.dumps(orders, pickle.HIGHEST_PROTOCOL)
        state.update((len(whole), pa.compress(whole, codec="zstd", asbytes=True)))
        state.setTimeoutTimestamp(max(now + 1, min(at for waiting in orders.values() for at in waiting[2:4] if at is not None)))
    elif state.exists:
        state.remove()
    if out:
        line, line_at, header, header_at = zip(*out)
        yield pd.DataFrame({"line": line, "line_at": line_at, "header": header, "header_at": pd.array(header_at, "Int64")})


def waiting_join(
    info: DataFrame, detail: DataFrame, how: str = "inner", arrival: str = "timestamp", delay: str = "24 hours", buckets: int = BUCKETS
) -> DataFrame:
    """Headers and lines as ``jobs.buffered_join`` gives them, but with waits that restart.

    A header waits 24 hours of arrival time for lines; one that comes again replaces it and waits anew. Lines without a header
    wait until 24 hours after the last of them. ``left_outer`` also gives the lines that were given up, once the watermark,
    ``delay`` behind the later arrivals of the slower topic, has passed their time. Needs ``run.state_settings``. A batch reads and
    writes all that waits in the buckets of its orders, so many small batches want more ``buckets``, whose number is fixed
    by the first start.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError("how must be inner or left_outer")

    def side(rows: DataFrame, order: str, kind: int) -> DataFrame:
        columns = [c for c in rows.columns if c != arrival]
        at = F.unix_millis(F.col(arrival))
        return rows.select(F.col(order).alias("order_id"), F.lit(kind).alias("kind"), at.alias("at"), F.to_json(F.struct(*columns)).alias("row"), F.col(arrival).alias("_arrival"))

    both = side(info, "id", 0).union(side(detail, "order_id", 1)).where("order_id IS NOT NULL").withWatermark("_arrival", delay)
    dealt = both.withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int"))
    found = dealt.groupBy("bucket").applyInPandasWithState(order_wait, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    if how == "inner":
        found = found.where("header IS NOT NULL")
    h_schema, d_schema = (type(x.schema)([f for f in x.schema.fields if f.name != arrival]) for x in (info, detail))
    found = found.select(F.from_json("line", d_schema).alias("d"), "line_at", F.from_json("header", h_schema).alias("h"), "header_at")
    lines = [F.col(f"d.{c}").alias("detail_id" if c == "id" else c) for c in d_schema.fieldNames()]
    headers = [F.col(f"h.{c}").alias("_header_id" if c == "id" else c) for c in h_schema.fieldNames() if c != "create_time"]
    return found.select(*lines, F.timestamp_millis("line_at").alias("_line_time"), *headers, F.timestamp_millis("header_at").alias("_header_time"))
