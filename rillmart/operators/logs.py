"""Behaviour logs: parse once, then split into page, display, action, start and error records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmart import schemas
from rillmart.functions.records import long_of, to_wire, with_parsed
from rillmart.sources import topics


def parse_logs(records: DataFrame) -> DataFrame:
    """Add ``log``, the parsed ``value``."""
    options = {"columnNameOfCorruptRecord": schemas.CORRUPT}
    return with_parsed(records, "log", F.from_json("value", schemas.LOG_RECORD, options))


def is_corrupt() -> Column:
    """The value is no JSON object: nothing of it can be read."""
    read = [F.col(f"log.{c}").isNull() for c in schemas.LOG_RECORD.fieldNames() if c != schemas.CORRUPT]
    unread = F.col(f"log.{schemas.CORRUPT}").isNotNull()
    for field in read:
        unread = unread & field
    return F.col("log").isNull() | unread


def is_error() -> Column:
    return F.col("log.err").isNotNull()


def has_page() -> Column:
    return F.col("log.page").isNotNull()


def has_start() -> Column:
    return F.col("log.start").isNotNull()


def error_records(parsed: DataFrame) -> DataFrame:
    """Records with ``err``: they go to the error topic whole and nowhere else."""
    return parsed.where(is_error())


def normal_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(~is_corrupt() & ~is_error())


def common_columns() -> dict[str, Column]:
    fields = {
        "mid": "mid",
        "user_id": "uid",
        "province_id": "ar",
        "channel": "ch",
        "is_new": "is_new",
        "model": "md",
        "operate_system": "os",
        "version_code": "vc",
        "brand": "ba",
    }
    return {name: F.col(f"log.common.{field}") for name, field in fields.items()}


def page_columns() -> dict[str, Column]:
    fields = {
        "page_id": "page_id",
        "last_page_id": "last_page_id",
        "page_item": "item",
        "page_item_type": "item_type",
        "during_time": "during_time",
        "source_type": "source_type",
    }
    source = {name: F.col(f"log.page.{field}") for name, field in fields.items()}
    return source | {"during_time": long_of(source["during_time"])}


def start_columns() -> dict[str, Column]:
    texts, numbers = ("entry", "open_ad_id"), ("loading_time_ms", "open_ad_ms", "open_ad_skip_ms")
    source = {name: F.col(f"log.start.{name}") for name in texts}
    return source | {name: long_of(F.col(f"log.start.{name}")) for name in numbers}


def display_columns(display: Column) -> dict[str, Column]:
    return {
        "display_type": display["display_type"],
        "display_item": display["item"],
        "display_item_type": display["item_type"],
        "display_order": display["order"],
        "display_pos_id": display["pos_id"],
    }


def action_columns(action: Column) -> dict[str, Column]:
    return {
        "action_id": action["action_id"],
        "action_item": action["item"],
        "action_item_type": action["item_type"],
    }


def _ts() -> dict[str, Column]:
    return {"ts": long_of(F.col("log.ts"))}


def _select(df: DataFrame, record: list[tuple[str, str, str]], source: dict[str, Column]) -> DataFrame:
    return df.select(*[source[name].alias(name) for name in schemas.columns(record)])


def flatten_common(parsed: DataFrame) -> DataFrame:
    source = common_columns() | _ts()
    return normal_records(parsed).select(*[column.alias(name) for name, column in source.items()])


def page_views(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per page view; columns in ``keep`` (such as ``offset``) stay beside it."""
    source = common_columns() | page_columns() | _ts()
    rows = normal_records(parsed).where(has_page())
    return rows.select(*[source[name].alias(name) for name in schemas.columns(schemas.PAGE_LOG)], *keep)


def page_displays(parsed: DataFrame) -> DataFrame:
    """One row per display; a missing or empty array gives none."""
    rows = normal_records(parsed).where(has_page()).select("log", F.explode("log.displays").alias("display"))
    source = common_columns() | page_columns() | display_columns(F.col("display")) | _ts()
    return _select(rows, schemas.DISPLAY_LOG, source)


def page_actions(parsed: DataFrame) -> DataFrame:
    """One row per action, at the log's time."""
    rows = normal_records(parsed).where(has_page()).select("log", F.explode("log.actions").alias("action"))
    source = common_columns() | page_columns() | action_columns(F.col("action")) | _ts()
    return _select(rows, schemas.ACTION_LOG, source)


def app_starts(parsed: DataFrame) -> DataFrame:
    source = common_columns() | start_columns() | _ts()
    return _select(normal_records(parsed).where(has_start()), schemas.START_LOG, source)


def route_logs(parsed: DataFrame) -> DataFrame:
    """Every output of every record, as ``(topic, key, value)``, from one scan.

    A record becomes the list of its outputs by kind, which is exploded; each
    row then writes its own JSON. The key is the device id; the plain topic
    sink does not use it.
    """
    page = F.when(has_page(), 1).otherwise(0)
    displays = F.when(has_page(), F.size("log.displays"))
    actions = F.when(has_page(), F.size("log.actions"))
    start = F.when(has_start(), 1).otherwise(0)

    def repeat(kind: str, times: Column) -> Column:
        return F.array_repeat(F.lit(kind), F.coalesce(times, F.lit(0)))

    kinds = (
        F.when(is_error(), F.array(F.lit("error")))
        .when(is_corrupt(), F.array(F.lit("corrupt")))
        .otherwise(
            F.concat(
                repeat("page", page), repeat("display", displays), repeat("action", actions), repeat("start", start)
            )
        )
    )
    rows = parsed.select("value", "log", F.posexplode(kinds).alias("pos", "kind"))

    # A record's page comes first, then its displays, then its actions.
    display = F.get("log.displays", F.col("pos") - 1)
    action = F.get("log.actions", F.col("pos") - 1 - F.coalesce(F.size("log.displays"), F.lit(0)))
    outer = common_columns() | page_columns() | start_columns() | _ts()
    kind = F.col("kind")
    topic = (
        F.when(kind == "page", topics.PAGE_LOG)
        .when(kind == "display", topics.PAGE_DISPLAY)
        .when(kind == "action", topics.PAGE_ACTION)
        .when(kind == "start", topics.START_LOG)
        .when(kind == "error", topics.ERROR_LOG)
        .otherwise(topics.CORRUPT)
    )
    value = (
        F.when(kind == "page", to_wire(schemas.PAGE_LOG, outer))
        .when(kind == "display", to_wire(schemas.DISPLAY_LOG, outer | display_columns(display)))
        .when(kind == "action", to_wire(schemas.ACTION_LOG, outer | action_columns(action)))
        .when(kind == "start", to_wire(schemas.START_LOG, outer))
        .otherwise(F.col("value"))
    )
    return rows.select(topic.alias("topic"), F.col("log.common.mid").alias("key"), value.alias("value"))
