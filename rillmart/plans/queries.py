"""The query registry: one entry per operator, each over the whole given tables."""

from __future__ import annotations

import time as time_module
from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmart import schemas
from rillmart.functions import labels, records, text, time
from rillmart.operators import changes, dau, dims, logs, orders, reports, serving
from rillmart.session import apply_settings, large_sorts, run_folder, settings
from rillmart.sources import shop_views as views
from rillmart.sources import topics
from rillmart.sources.segments import SegmentTopics
from rillmart.sources.shop_views import Shop
from rillmart.sources.tables import stream_table
from rillmart.streaming import jobs, rollups, run, sinks
from rillmart.streaming.waiting import waiting_join

AS_OF = "2024-06-30"  # ages are as of this day, so that runs repeat
DAY = "2024-01-15"  # day of the single-day queries
ITEM = "red widget"  # search text of the item queries
FACTS = ["order_info", "order_detail"]
DIMS = ["user_info", "base_province"]
ARRIVALS = 1706745600  # 2024-02-01, when the first file of a topic arrives
DEEP_PAGE = 200
STARTING_OFFSETS = {0: 25, 1: 100, 2: 60}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    def call(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Shop(apply_settings(spark), folder))

    REGISTRY[fn.__name__] = call
    return fn


# ---- inputs the queries share -----------------------------------------------------


def parsed_logs(shop: Shop) -> DataFrame:
    return logs.parse_logs(shop.log_topic())


def page_log_view(shop: Shop) -> DataFrame:
    return logs.page_views(parsed_logs(shop))


def dau_index(shop: Shop) -> DataFrame:
    return dau.dau_wide(page_log_view(shop), shop.user_info(), shop.base_province(), AS_OF)


def dau_times(shop: Shop) -> DataFrame:
    """The columns of the daily index that counting needs."""
    return dau.first_times(page_log_view(shop))


def order_index(shop: Shop, user: bool = False, province: bool = False, names: bool = True) -> DataFrame:
    """The order index made anew, one row a line however often it was sent. Only the dimensions a query uses are looked up."""
    return orders.order_wide(
        shop.order_info(),
        shop.order_detail() if names else shop.order_lines(),
        shop.user_info() if user else None,
        shop.base_province() if province else None,
        AS_OF,
    )


_ORDER_TABLES: dict[tuple[str, str], sinks.DailyTable] = {}  # by application and folder


def order_table(shop: Shop) -> sinks.DailyTable:
    """The stored order index that serving reads, written once in an application: all lines, then a fifth of them replayed."""
    key = (shop.spark.sparkContext.applicationId, shop.folder)
    if key not in _ORDER_TABLES:
        wide = orders.order_wide(shop.order_info(), shop.order_detail(), shop.user_info(), shop.base_province(), AS_OF)
        path = f"{run_folder(shop.spark, 'order_table')}/wide"
        table = sinks.DailyTable(shop.spark, path, schemas.like(wide, schemas.ORDER_WIDE), "detail_id", "create_date")
        # large writes, whose tasks hold enough rows of each day: another shuffle of all columns would only make fewer files
        with large_sorts(shop.spark):
            table.append(wide, version=1, rebalance=False)
            table.append(table.writes().where(F.col("detail_id") % 5 == 0), version=2, rebalance=False)
        _ORDER_TABLES[key] = table
    return _ORDER_TABLES[key]


def item_lines(shop: Shop, item: str, *fields: str, day: str | None = None) -> DataFrame:
    """Lines of the stored order index whose product name holds every term of ``item``, with the columns that a query uses."""
    columns = dict.fromkeys(["create_date", "sku_name", *fields])
    return order_table(shop).read_where(text.match_all_terms(F.col("sku_name"), item), columns, day)


def lists(shop: Shop) -> DataFrame:
    return changes.table_lists(shop.spark, FACTS, DIMS)


def parsed_changes(shop: Shop) -> DataFrame:
    return changes.parse_changes(shop.change_topic())


def money(column: str, digits: int = 4):
    """Round for comparison. Line amounts have four decimals, so at four no sum lies half way between two steps."""
    return F.round(column, digits).alias(column)


# ---- scans, sources, sinks ----------------------------------------------------------


def log_stream(shop: Shop) -> DataFrame:
    return views.log_topic(stream_table(shop.spark, shop.folder, "events"))


def _copied_topic(shop: Shop, name: str, stream: DataFrame) -> DataFrame:
    """Run a record stream into files and read them back."""
    folder = run_folder(shop.spark, name)
    columns = ["topic", "partition", "offset", "value"]
    writer = stream.select(*columns).writeStream.format("parquet").option("path", f"{folder}/out")
    run.run_to_end(shop.spark, writer, f"{folder}/checkpoint")
    schema = "topic STRING, `partition` INT, `offset` BIGINT, value STRING"
    return shop.spark.read.schema(schema).parquet(f"{folder}/out")


@query
def src_topic(shop: Shop) -> DataFrame:
    return _copied_topic(shop, "src_topic", log_stream(shop))


@query
def src_topic_from_offsets(shop: Shop) -> DataFrame:
    """The log topic as segments; the stream seeks the given offsets and opens no file before them."""
    store = SegmentTopics(shop.spark, f"{run_folder(shop.spark, 'src_topic_from_offsets')}/topics")
    store.append(shop.log_topic(), 0)
    return _copied_topic(shop, "src_topic_from_offsets", store.stream(topics.ODS_LOG, STARTING_OFFSETS))


def _stored(shop: Shop, name: str, rows: DataFrame) -> DataFrame:
    """The rows computed once, for queries that need them several times."""
    folder = run_folder(shop.spark, name)
    rows.write.option("compression", "zstd").parquet(folder)
    return shop.spark.read.schema(rows.schema).parquet(folder)


def _arriving(shop: Shop, name: str, rows: DataFrame, file: Column | None = None, hours: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """The rows as a topic that arrives in several hours, read one hour a batch, whatever the number of rows.

    ``file`` is each row's hour by number, by default dealt at random; ``hours`` says when each arrives, as ``timestamp``. The rows
    are written once, an hour in a folder. A stream takes files by their times, so those of an hour get the same one, and all hours
    have the same number of files, so that a batch of that many files is an hour; else two topics would drift apart.
    """
    spark, topic = shop.spark, f"{run_folder(shop.spark, name)}/topic"
    rows = rows.drop("timestamp")
    mark = F.pmod(F.xxhash64(*rows.columns), F.lit(len(hours))) if file is None else file
    dealt = rows.withColumn("_file", mark.cast("int"))
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(len(hours))}):  # tasks need not sort by hour
        dealt.write.option("compression", "zstd").partitionBy("_file").parquet(topic)
    top = spark._jvm.org.apache.hadoop.fs.Path(topic)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(top):  # rows of no hour; to filter them beforehand would compute each row's hour twice
        if folder.isDirectory() and folder.getPath().getName() not in [f"_file={n}" for n in range(len(hours))]:
            fs.delete(folder.getPath(), True)

    def files_of(number: int) -> list:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{topic}/_file={number}")
        found = fs.listStatus(path) if fs.exists(path) else []
        return [f.getPath() for f in found if f.getPath().getName().startswith("part-")]

    files = max(1, *[len(files_of(number)) for number in range(len(hours))])
    first = int(time_module.time()) * 1000
    for number in range(len(hours)):
        for _ in range(files - len(files_of(number))):
            spark.createDataFrame([], rows.schema).coalesce(1).write.mode("append").parquet(f"{topic}/_file={number}")
        for path in files_of(number):
            fs.setTimes(path, first + number * 1000, -1)
            if fs.getFileStatus(path).getModificationTime() != first + number * 1000:
                raise RuntimeError(f"{topic}: a topic that arrives needs a store that keeps the times given to files")
    schema = T.StructType([*rows.schema.fields, T.StructField("_file", T.IntegerType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(topic)
    hour = F.element_at(F.array(*[F.lit(h) for h in hours]), F.col("_file") + 1)
    return stream.withColumn("timestamp", F.timestamp_seconds(F.lit(ARRIVALS) + hour * 3600)).drop("_file")


def _increments(shop: Shop, name: str) -> Iterator[tuple[int, DataFrame]]:
    """The log topic in two parts, of which the second comes after the first was consumed: ``(number, stream)``."""
    folder, events = f"{run_folder(shop.spark, name)}/in", shop.table("events")
    for part in range(2):
        records = views.log_topic(events.where(F.col("event_id") % 2 == part))
        records.write.mode("append").parquet(folder)
        yield part, topics.file_topic(shop.spark, folder)


@query
def commit_after_write(shop: Shop) -> DataFrame:
    """The first try of each batch fails before its output; were the offsets committed before it, the retry had nothing to do."""
    folder, failed = run_folder(shop.spark, "commit_after_write"), set()

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("the sink is down")
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    for _, records in _increments(shop, "commit_after_write"):
        routed = jobs.routed_logs(records).select("topic", "value")
        for _ in range(2):
            try:
                run.run_to_end(shop.spark, routed.writeStream.foreachBatch(write), f"{folder}/checkpoint")
            except StreamingQueryException as error:
                if "the sink is down" not in str(error):
                    raise
    return _counts_by(shop, f"{folder}/out", "batch")


@query
def resume(shop: Shop) -> DataFrame:
    """Two runs over a topic that grew between them; the second goes on where the first ended."""
    folder = run_folder(shop.spark, "resume")
    for number, records in _increments(shop, "resume"):
        routed = jobs.routed_logs(records).select("topic", "value")
        write = lambda batch, n, run=number: batch.write.parquet(f"{folder}/out/run={run}/batch={n}")
        run.run_to_end(shop.spark, routed.writeStream.foreachBatch(write), f"{folder}/checkpoint")
    return _counts_by(shop, f"{folder}/out", "run", "batch")


def _counts_by(shop: Shop, path: str, *parts: str) -> DataFrame:
    schema = ", ".join(["topic STRING", "value STRING", *[f"{p} BIGINT" for p in parts]])
    return shop.spark.read.schema(schema).parquet(path).groupBy(*parts, "topic").agg(F.count("*").alias("n"))


@query
def sink_topics(shop: Shop) -> DataFrame:
    folder = run_folder(shop.spark, "sink_topics")
    writer = sinks.topic_files(jobs.routed_logs(log_stream(shop)), f"{folder}/topics")
    run.run_to_end(shop.spark, writer, f"{folder}/checkpoint")
    return sinks.read_topic_files(shop.spark, f"{folder}/topics")


@query
def sink_topics_keyed(shop: Shop) -> DataFrame:
    folder = run_folder(shop.spark, "sink_topics_keyed")
    writer = sinks.keyed_topic_files(jobs.routed_logs(log_stream(shop)), f"{folder}/topics")
    run.run_to_end(shop.spark, writer, f"{folder}/checkpoint")
    rows = sinks.read_topic_files(shop.spark, f"{folder}/topics", sinks.KEYED_VALUE)
    return rows.select("topic", "key", "value")


def _dau_table(shop: Shop, name: str, fold_every: int = 100) -> sinks.DailyTable:
    return sinks.DailyTable(shop.spark, f"{run_folder(shop.spark, name)}/dau", dau_index(shop).schema, "mid", fold_every=fold_every)


@query
def sink_upsert_daily(shop: Shop) -> DataFrame:
    """A stream writes rows with stale values and its days are compacted; a batch corrects them and is replayed: every id is there once."""
    table, folder = _dau_table(shop, "sink_upsert_daily", fold_every=3), run_folder(shop.spark, "sink_upsert_daily")
    index = _stored(shop, "sink_upsert_daily", dau_index(shop))
    stream = _arriving(shop, "sink_upsert_daily", index.withColumn("province_name", F.lit("stale")))
    run.run_to_end(shop.spark, table.stream(stream), f"{folder}/checkpoint")
    for _ in range(2):
        table.append(index, version=1000)
    return table.read()


@query
def scan_index_field(shop: Shop) -> DataFrame:
    """One field of one day; only that day's folders are listed."""
    table = _dau_table(shop, "scan_index_field")
    table.append(dau_index(shop), version=1)
    return serving.scan_field(table.read(DAY), "mid", DAY)


def dim_change_stream(shop: Shop) -> DataFrame:
    users = views.change_topic_of_users(stream_table(shop.spark, shop.folder, "customer"))
    provinces = views.change_topic_of_provinces(stream_table(shop.spark, shop.folder, "nation"))
    return users.union(provinces)


def all_change_stream(shop: Shop) -> DataFrame:
    stream = lambda name: stream_table(shop.spark, shop.folder, name)
    return (
        views.change_topic_of_orders(stream("orders"))
        .union(views.change_topic_of_lines(stream("lineitem"), shop.table("part")))
        .union(dim_change_stream(shop))
    )


def _route_change_stream(
    shop: Shop, name: str, records: DataFrame, compact_every: int = 100
) -> tuple[str, sinks.DimensionStore]:
    folder = run_folder(shop.spark, name)
    store = sinks.DimensionStore(shop.spark, f"{folder}/dims", compact_every)
    jobs.save_table_lists(lists(shop), f"{folder}/lists")
    writer = jobs.change_router(records, f"{folder}/lists", f"{folder}/facts", store)
    run.run_to_end(shop.spark, writer, f"{folder}/checkpoint")
    return f"{folder}/facts", store


@query
def sink_dim_upsert(shop: Shop) -> DataFrame:
    """Several batches with the changes in any order, and a snapshot between them."""
    records = _arriving(shop, "sink_dim_upsert", shop.dimension_changes())
    _, store = _route_change_stream(shop, "sink_dim_upsert", records, compact_every=2)
    return store.read().select("table_name", "id", "op", "version", "data")


@query
def src_table_lists(shop: Shop) -> DataFrame:
    """Lists saved to and read from a store, and the changes each of them lets through."""
    folder = run_folder(shop.spark, "src_table_lists")
    jobs.save_table_lists(lists(shop), folder)
    known = changes.known_changes(parsed_changes(shop))
    listed = changes.listed_changes(known, jobs.load_table_lists(shop.spark, folder))
    return listed.groupBy("kind", "table_name").agg(F.count("*").alias("n"))


# ---- projections and parsing ----------------------------------------------------------


@query
def parse_json(shop: Shop) -> DataFrame:
    return parsed_logs(shop).select(
        records.long_of(F.col("log.ts")).alias("ts"),
        F.col("log.common.mid").alias("mid"),
        F.col("log.page.page_id").alias("page_id"),
        F.col("log.err").alias("err"),
        F.size("log.displays").alias("n_displays"),
        F.size("log.actions").alias("n_actions"),
    )


@query
def json_get(shop: Shop) -> DataFrame:
    """The accessors by path; the text is parsed once and an absent path gives null."""
    return parsed_logs(shop).select(
        F.col("log.common.mid").alias("mid"),
        records.long_of(F.col("log.ts")).alias("ts"),
        F.col("log.page.last_page_id").alias("last_page_id"),
        F.col("log.start.entry").alias("entry"),
        F.get("log.actions", F.lit(0))["action_id"].alias("first_action"),
    )


@query
def to_json_row(shop: Shop) -> DataFrame:
    return page_log_view(shop).select(records.to_wire(schemas.PAGE_LOG).alias("value"))


@query
def flatten_common(shop: Shop) -> DataFrame:
    return logs.flatten_common(parsed_logs(shop))


@query
def page_log(shop: Shop) -> DataFrame:
    return logs.page_views(parsed_logs(shop))


@query
def explode_displays(shop: Shop) -> DataFrame:
    return logs.page_displays(parsed_logs(shop))


@query
def explode_actions(shop: Shop) -> DataFrame:
    return logs.page_actions(parsed_logs(shop))


@query
def start_log(shop: Shop) -> DataFrame:
    return logs.app_starts(parsed_logs(shop))


@query
def cdc_op(shop: Shop) -> DataFrame:
    return parsed_changes(shop).select("table_name", "version", "change_type", "op")


@query
def cdc_fact_topic(shop: Shop) -> DataFrame:
    return changes.fact_records(parsed_changes(shop), lists(shop))


@query
def copy_by_name(shop: Shop) -> DataFrame:
    """Page views shaped as rows of the daily index: shared fields copied, the others null."""
    return records.copy_by_name(page_log_view(shop), dau_index(shop).schema)


@query
def merge_order_wide(shop: Shop) -> DataFrame:
    """Header and line merged without any lookup; the line's time wins."""
    return orders.merge(orders.enrich_headers(shop.order_info(), None, None), shop.order_detail())


@query
def stat_fields(shop: Shop) -> DataFrame:
    return serving.detail_fields(order_index(shop, user=True, province=True))


# ---- filters ----------------------------------------------------------------------------


@query
def route_error(shop: Shop) -> DataFrame:
    return logs.error_records(parsed_logs(shop)).select("value")


@query
def has_page(shop: Shop) -> DataFrame:
    rows = logs.normal_records(parsed_logs(shop)).where(logs.has_page())
    return rows.select(records.long_of(F.col("log.ts")).alias("ts"), F.col("log.page.page_id").alias("page_id"))


@query
def has_start(shop: Shop) -> DataFrame:
    rows = logs.normal_records(parsed_logs(shop)).where(logs.has_start())
    return rows.select(records.long_of(F.col("log.ts")).alias("ts"), F.col("log.start.entry").alias("entry"))


@query
def drop_unknown_op(shop: Shop) -> DataFrame:
    return changes.known_changes(parsed_changes(shop)).select("table_name", "version", "op")


@query
def table_in_set(shop: Shop) -> DataFrame:
    return changes.listed_changes(parsed_changes(shop), lists(shop)).select("kind", "table_name", "version")


@query
def session_start(shop: Shop) -> DataFrame:
    return dau.session_starts(page_log_view(shop)).select("mid", "page_id", "ts")


@query
def match_all_terms(shop: Shop) -> DataFrame:
    rows = shop.order_detail()
    return rows.where(text.match_all_terms(F.col("sku_name"), ITEM)).select("id", "sku_name")


@query
def day_partition(shop: Shop) -> DataFrame:
    """One day of a table partitioned by day, and a day that is not there."""
    table = _dau_table(shop, "day_partition")
    table.append(dau_index(shop), version=1)
    there = serving.dau_total(table.read(DAY), DAY)
    missing = serving.dau_total(table.read("1999-01-01"), "1999-01-01")
    return there.union(missing)


# ---- joins ------------------------------------------------------------------------------


@query
def dim_join_user(shop: Shop) -> DataFrame:
    return dims.join_user(shop.order_info(), shop.user_info(), AS_OF).select(
        "id", "user_id", "user_gender", "user_age"
    )


def _dimension_store(shop: Shop, name: str, buckets: int = sinks.BUCKETS) -> sinks.DimensionStore:
    """Users and provinces in a keyed store."""
    store = sinks.DimensionStore(shop.spark, f"{run_folder(shop.spark, name)}/dims", buckets=buckets)
    rows = lambda table, df: df.select(
        F.lit(table).alias("table_name"), F.col("id").cast("string").alias("id"), labels.dim_key(F.lit(table), F.col("id").cast("string")).alias("key"),
        F.lit("I").alias("op"), F.lit(1).cast("bigint").alias("version"), F.to_json(F.struct("*")).alias("data"),
    )
    store.append(rows("user_info", shop.user_info()).union(rows("base_province", shop.base_province())), 0)
    return store


@query
def dim_lookup_user(shop: Shop) -> DataFrame:
    """The orders of one day look up their users in a keyed store, which reads and ranks these users only."""
    store = _dimension_store(shop, "dim_lookup_user")
    info = shop.order_info().where(time.create_date(F.col("create_time")) == DAY)
    users = store.table("user_info", schemas.USER_INFO).of(info.select("user_id"))
    return dims.join_user(info, users, AS_OF).select("id", "user_id", "user_gender", "user_age")


@query
def dim_join_province(shop: Shop) -> DataFrame:
    return dims.join_province(shop.order_info(), shop.base_province()).select(
        "id", "province_id", "province_name", "province_iso_code", "province_3166_2_code", "province_area_code"
    )


@query
def order_full_outer(shop: Shop) -> DataFrame:
    return orders.full_outer(shop.order_info(), shop.order_lines())


def order_streams(shop: Shop, name: str, line_file: Column | None = None, hours: tuple[int, ...] = (0, 1, 2)):
    """Headers and lines in several files each, dealt apart from each other."""
    info = _arriving(shop, f"{name}-info", shop.order_info())
    return info, _arriving(shop, f"{name}-detail", shop.order_detail(), line_file, hours)


def _run_to_files(shop: Shop, name: str, stream: DataFrame, by: str | None = None) -> DataFrame:
    folder = run_folder(shop.spark, name)
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("compression", "zstd")
    if by:
        writer = writer.partitionBy(by)
    run.run_to_end(shop.spark, writer, f"{folder}/checkpoint")
    return shop.spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query
def order_buffered_join(shop: Shop) -> DataFrame:
    joined = jobs.buffered_join(*order_streams(shop, "order_buffered_join"))
    joined = joined.select(*[c for c in schemas.ORDER_WIDE if c in joined.columns])
    return dims.keep_latest_of_few(_run_to_files(shop, "order_buffered_join", joined), ["detail_id"], ["create_time"])


@query
def state_ttl_24h(shop: Shop) -> DataFrame:
    """The same join over a detail stream of which every seventh line arrives more than 24 hours after its header."""
    late = F.when(F.col("id") % 7 == 0, 3).otherwise(F.pmod(F.xxhash64("id"), F.lit(3)))
    info, detail = order_streams(shop, "state_ttl_24h", late, (0, 1, 2, 30))
    joined = jobs.buffered_join(info, detail).select("detail_id", "order_id", "create_time")
    return dims.keep_latest_of_few(_run_to_files(shop, "state_ttl_24h", joined), ["detail_id"], ["create_time"])


@query
def order_waiting_join(shop: Shop) -> DataFrame:
    """Lines arrive 0 and 20 hours after the start, most headers after 30: the later lines of an order keep its first ones waiting."""
    headers = F.when(F.col("id") % 10 < 2, F.col("id") % 10).otherwise(2)
    info = _arriving(shop, "order_waiting_join-info", shop.order_info(), headers, (0, 20, 30))
    detail = _arriving(shop, "order_waiting_join-detail", shop.order_detail(), F.when(F.col("id") % 3 == 0, 0).otherwise(1), (0, 20))
    joined = waiting_join(info, detail).select("detail_id", "order_id", "create_time")
    return dims.keep_latest_of_few(_run_to_files(shop, "order_waiting_join", joined), ["detail_id"], ["create_time"])


@query
def order_wide(shop: Shop) -> DataFrame:
    return orders.order_wide(
        shop.order_info(), shop.order_detail(), shop.user_info(), shop.base_province(), AS_OF
    )


@query
def order_wide_stream(shop: Shop) -> DataFrame:
    info, detail = order_streams(shop, "order_wide_stream")
    folder = run_folder(shop.spark, "order_wide_stream")
    schema = schemas.like(order_index(shop, user=True, province=True), schemas.ORDER_WIDE)
    table = sinks.DailyTable(shop.spark, f"{folder}/wide", schema, "detail_id", "create_date")
    job = jobs.order_job(info, detail, shop.user_info, shop.base_province, table, f"{folder}/alone", AS_OF)
    run.run_to_end(shop.spark, job, f"{folder}/checkpoint")
    return table.read(few=True).select(*schemas.ORDER_WIDE)


@query
def orphan_orders(shop: Shop) -> DataFrame:
    return orders.orphans(shop.order_info(), shop.order_lines())


# ---- aggregations -------------------------------------------------------------------------


@query
def dau_total(shop: Shop) -> DataFrame:
    return serving.dau_total(dau_times(shop))


@query
def dau_by_hour(shop: Shop) -> DataFrame:
    return serving.dau_by_hour(dau_times(shop))


@query
def dau_by_hour_filled(shop: Shop) -> DataFrame:
    return serving.dau_by_hour_filled(dau_times(shop))


@query
def amount_by_field(shop: Shop) -> DataFrame:
    rows = serving.amount_by_field(item_lines(shop, ITEM, "user_age", "split_total_amount"), ITEM, "user_age")
    return rows.select("create_date", "key", "n", money("amount"))


@query
def top_terms(shop: Shop) -> DataFrame:
    return serving.top_terms(order_index(shop, names=False), "sku_id")


@query
def age_bucket_amount(shop: Shop) -> DataFrame:
    amounts = serving.amount_by_field(item_lines(shop, "widget", "user_age", "split_total_amount"), "widget", "user_age")
    return serving.age_buckets(amounts).select("create_date", "name", money("value"))


@query
def gender_label(shop: Shop) -> DataFrame:
    return shop.user_info().select("id", labels.gender_label(F.col("gender")).alias("gender"))


# ---- dedup and state ------------------------------------------------------------------------


@query
def dau_dedup(shop: Shop) -> DataFrame:
    starts = dau.with_day_hour(dau.session_starts(page_log_view(shop)))
    return dau.first_of_day(starts).select("dt", "hr", "mid", "page_id", "ts")


@query
def dau_dedup_stream(shop: Shop) -> DataFrame:
    """Which row of a device and day arrives first is up to the stream, so only the keys are returned."""
    page_views = logs.page_views(logs.parse_logs(_arriving(shop, "dau_dedup_stream", shop.log_topic())), "timestamp")
    first = jobs.first_of_day_stream(page_views).select("dt", "mid")
    return _run_to_files(shop, "dau_dedup_stream", first, by="dt").select("dt", "mid")


@query
def dau_state_rebuild(shop: Shop) -> DataFrame:
    """The index holds the days before DAY; a rerun over all days adds only the rest."""
    first = dau.first_of_day(dau.with_day_hour(dau.session_starts(page_log_view(shop))))
    first = _stored(shop, "dau_state_rebuild", first)
    table = sinks.DailyTable(
        shop.spark, f"{run_folder(shop.spark, 'dau_state_rebuild')}/dau", first.schema, "mid"
    )
    table.append(first.where(F.col("dt") < DAY), version=1)
    days = [r[0] for r in first.select("dt").distinct().collect()]  # the batch's own days; no other is read
    return dau.not_yet_stored(first, table.writes(days)).select("dt", "mid", "ts")


@query
def dim_latest(shop: Shop) -> DataFrame:
    rows = changes.dim_records(changes.parse_changes(shop.dimension_changes()), lists(shop))
    return dims.dim_latest(rows).select("table_name", "id", "op", "version", "data")


# ---- sorts, limits, paging ----------------------------------------------------------------------


@query
def paginate(shop: Shop) -> DataFrame:
    rows = order_index(shop, names=False).select("detail_id", "create_time", "order_id")
    return serving.paginate(rows, serving.newest_first(), page_no=3, page_size=serving.PAGE_SIZE)


def _pages(shop: Shop) -> DataFrame:
    return order_index(shop, names=False).select("detail_id", "create_time", "order_id")


@query
def paginate_after(shop: Shop) -> DataFrame:
    """The third page by the last row of the second."""
    rows = _pages(shop)
    last = serving.paginate(rows, serving.newest_first(), page_no=2).orderBy("create_time", F.desc("detail_id")).first()
    return serving.page_after(rows, last and (last["create_time"], last["detail_id"]))


@query
def paginate_deep(shop: Shop) -> DataFrame:
    """A page far back by its number, from rows stored in order: only the files that hold it are read."""
    pages = rollups.SortedPages(shop.spark, run_folder(shop.spark, "paginate_deep"))
    return pages.write(_pages(shop), serving.newest_first()).page(DEEP_PAGE, serving.PAGE_SIZE)


@query
def detail_total(shop: Shop) -> DataFrame:
    return serving.detail_total(item_lines(shop, ITEM), ITEM)


# ---- scalar functions ----------------------------------------------------------------------------


@query
def ts_to_dt_hr(shop: Shop) -> DataFrame:
    return dau.with_day_hour(page_log_view(shop).select("mid", "ts"))


@query
def split_create_time(shop: Shop) -> DataFrame:
    created = F.col("create_time")
    return shop.order_info().select(
        "id", time.create_date(created).alias("create_date"), time.create_hour(created).alias("create_hour")
    )


@query
def age_years(shop: Shop) -> DataFrame:
    return shop.user_info().select("id", "birthday", time.age_years(F.col("birthday"), AS_OF).alias("age"))


@query
def upper_concat(shop: Shop) -> DataFrame:
    rows = changes.known_changes(parsed_changes(shop))
    table = F.col("table_name")
    return rows.select(
        "version",
        labels.fact_topic(table, F.col("op")).alias("topic"),
        labels.dim_key(table, changes.row_id(F.col("data"))).alias("key"),
    )


@query
def highlight(shop: Shop) -> DataFrame:
    rows = shop.order_detail().where(text.match_all_terms(F.col("sku_name"), "Widget"))
    return rows.select("id", text.highlight(F.col("sku_name"), "Widget").alias("sku_name"))


@query
def prev_day(shop: Shop) -> DataFrame:
    day = time.create_date(F.col("create_time"))
    return shop.order_info().select("id", day.alias("day"), time.prev_day(day).alias("prev_day"))


@query
def code_label(shop: Shop) -> DataFrame:
    """Each user's value of the two statistics, and the column it comes from."""
    users = shop.user_info()
    kinds = F.explode(F.array(*[F.lit(k) for k in sorted(labels.STAT_FIELDS)]))
    rows = users.select("id", "gender", "birthday", kinds.alias("kind"))
    age = time.age_years(F.col("birthday"), AS_OF).cast("string")
    return rows.select(
        "id",
        "kind",
        labels.stat_field_label(F.col("kind")).alias("field"),
        F.when(F.col("kind") == "age", age).otherwise(F.col("gender")).alias("value"),
    )


# ---- streaming -------------------------------------------------------------------------------------


@query
def trigger_5s(shop: Shop) -> DataFrame:
    """A live stream on the 5 second trigger, stopped when it has taken all there is."""
    folder = run_folder(shop.spark, "trigger_5s")
    writer = sinks.topic_files(jobs.routed_logs(log_stream(shop)), f"{folder}/topics")
    live = run.start(shop.spark, writer, f"{folder}/checkpoint", live=True)
    try:
        live.processAllAvailable()
    finally:
        live.stop()
    return sinks.read_topic_files(shop.spark, f"{folder}/topics").groupBy("topic").agg(F.count("*").alias("n"))


# ---- composed queries ---------------------------------------------------------------------------------


@query
def dau_realtime(shop: Shop) -> DataFrame:
    return serving.dau_realtime(dau_times(shop))


@query
def dau_realtime_day(shop: Shop) -> DataFrame:
    return serving.dau_realtime(dau_times(shop), DAY)


@query
def stats_by_item(shop: Shop) -> DataFrame:
    rows = serving.stats_by_item(item_lines(shop, ITEM, "user_gender", "split_total_amount"), ITEM, "gender")
    return rows.select("create_date", "name", money("value"))


@query
def stats_by_item_age(shop: Shop) -> DataFrame:
    rows = serving.stats_by_item(item_lines(shop, ITEM, "user_age", "split_total_amount"), ITEM, "age")
    return rows.select("create_date", "name", money("value"))


@query
def detail_by_item(shop: Shop) -> DataFrame:
    """The first page of the hits of a stored day, of which only the folder is read."""
    return serving.detail_with_total(serving.detail_by_item(order_table(shop).read(DAY), DAY, ITEM))


@query
def detail_empty_page(shop: Shop) -> DataFrame:
    """A page beyond the last: no rows, but the total."""
    return serving.detail_with_total(serving.detail_by_item(order_table(shop).read(DAY), DAY, ITEM, page_no=100_000))


def _with_late_changes(table: rollups.RolledTable, rows: DataFrame, key: str, rebalance: bool = True, **stale: Column) -> rollups.RolledTable:
    """All rows, of which a fifth have stale values; these are corrected by a second write, which is then replayed."""
    late = F.pmod(F.xxhash64(key), F.lit(5)) == 0
    table.append(rows.withColumns({c: F.when(late, value).otherwise(F.col(c)) for c, value in stale.items()}), 0, "stream", rebalance)
    for _ in range(2):
        table.append(rows.where(late), 1, "stream", rebalance)
    return table


@query
def dau_realtime_rolled(shop: Shop) -> DataFrame:
    """The same from counts by hour that the writing job keeps, after rows have moved to another hour."""
    folder, index = run_folder(shop.spark, "dau_realtime_rolled"), _stored(shop, "dau_realtime_rolled", dau_index(shop))
    table = sinks.DailyTable(shop.spark, f"{folder}/dau", index.schema, "mid")
    sums = _with_late_changes(rollups.RolledTable(table, f"{folder}/sums", ["hr"]), index, "mid", hr=F.lit("00"))
    return serving.realtime_of_hours(sums.read().withColumnRenamed("n", "cnt"))


@query
def stats_by_item_rolled(shop: Shop) -> DataFrame:
    """The same from sums by name, gender and age that the writing job keeps, after rows have moved to another group."""
    folder, wide = run_folder(shop.spark, "stats_by_item_rolled"), order_index(shop, user=True, province=True)
    with large_sorts(shop.spark):
        wide = _stored(shop, "stats_by_item_rolled", wide.select(*schemas.ORDER_WIDE))
    table = sinks.DailyTable(shop.spark, f"{folder}/wide", wide.schema, "detail_id", "create_date")
    sums = rollups.RolledTable(table, f"{folder}/sums", serving.ITEM_GROUPS, "split_total_amount")
    other = F.when(F.col("user_gender") == "F", "M").otherwise("F")
    # as for the stored order index, tasks hold enough rows of each day
    _with_late_changes(sums, wide, "detail_id", False, user_gender=other, split_total_amount=F.lit(1.0))
    return serving.stats_of_rollup(sums.read(), ITEM, "gender").select("create_date", "name", money("value"))


@query
def dau_wide(shop: Shop) -> DataFrame:
    return dau_index(shop)


@query
def dau_wide_stream(shop: Shop) -> DataFrame:
    """The streaming job, log topic to daily index; only columns that every row of a device shares."""
    page_views = logs.page_views(logs.parse_logs(_arriving(shop, "dau_wide_stream", shop.log_topic())), "timestamp")
    table, folder = _dau_table(shop, "dau_wide_stream"), run_folder(shop.spark, "dau_wide_stream")
    job = jobs.dau_job(page_views, shop.user_info, shop.base_province, table, AS_OF)
    run.run_to_end(shop.spark, job, f"{folder}/checkpoint")
    return table.read().select("dt", "mid", "user_id", "user_gender", "user_age", "province_name", "province_3166_2")


@query
def route_log(shop: Shop) -> DataFrame:
    return logs.route_logs(parsed_logs(shop)).select("topic", "value")


@query
def route_cdc(shop: Shop) -> DataFrame:
    return changes.route_changes(parsed_changes(shop), lists(shop)).select(
        "target", "topic", "key", "version", "op", "value"
    )


@query
def route_cdc_stream(shop: Shop) -> DataFrame:
    """The streaming job over every change; rows per fact topic and per dimension."""
    facts, store = _route_change_stream(shop, "route_cdc_stream", all_change_stream(shop))
    topics_written = sinks.read_topic_files(shop.spark, facts).groupBy(F.col("topic").alias("name"))
    dims_written = store.read().groupBy(F.upper("table_name").alias("name"))
    return topics_written.agg(F.count("*").alias("n")).union(dims_written.agg(F.count("*").alias("n")))


# ---- dashboard reports -----------------------------------------------------------------------------------

# The dashboard's five steps: test pages stand for four of them, the cart is an action.
FUNNEL = {
    "home": ("page", "view"),
    "detail": ("page", "click"),
    "cart": ("action", "cart_add"),
    "order": ("page", "signup"),
    "pay": ("page", "purchase"),
}


def dated_views(shop: Shop) -> DataFrame:
    return reports.dated(page_log_view(shop))


def sold_lines(shop: Shop) -> DataFrame:
    """Order lines with the product's brand and category."""
    part = shop.table("part").select("p_partkey", "p_brand", "p_type")
    return shop.order_lines().join(part, F.col("sku_id") == F.col("p_partkey"), "left")


@query
def pv_by_day(shop: Shop) -> DataFrame:
    return reports.pv_by_day(dated_views(shop))


@query
def uv_by_day(shop: Shop) -> DataFrame:
    return reports.uv_by_day(dated_views(shop))


@query
def visit_total(shop: Shop) -> DataFrame:
    return reports.visit_total(dated_views(shop))


@query
def visit_total_week(shop: Shop) -> DataFrame:
    return reports.visit_total(reports.last_days(dated_views(shop), DAY))


@query
def new_vs_old(shop: Shop) -> DataFrame:
    return reports.new_vs_old(dated_views(shop)).select(
        "is_new", "pv", "uv", money("bounce_rate", 6), money("mean_seconds", 6), money("mean_pages", 6)
    )


@query
def channel_pv(shop: Shop) -> DataFrame:
    return reports.channel_pv(dated_views(shop))


@query
def channel_bounce(shop: Shop) -> DataFrame:
    return reports.channel_bounce(dated_views(shop)).select("channel", money("bounce_rate", 6))


@query
def page_path(shop: Shop) -> DataFrame:
    return reports.page_path(dated_views(shop))


@query
def page_path_nodes(shop: Shop) -> DataFrame:
    return reports.page_path_nodes(dated_views(shop))


@query
def action_funnel(shop: Shop) -> DataFrame:
    return reports.action_funnel(page_log_view(shop), logs.page_actions(parsed_logs(shop)), FUNNEL)


@query
def user_total(shop: Shop) -> DataFrame:
    return reports.user_total(shop.user_info(), dated_views(shop), shop.order_info())


@query
def paid_share(shop: Shop) -> DataFrame:
    return reports.paid_share(shop.user_info(), shop.order_info())


@query
def order_total(shop: Shop) -> DataFrame:
    return reports.order_total(shop.order_info()).select("order_count", money("order_amount", 2), "order_user")


@query
def spu_top(shop: Shop) -> DataFrame:
    return reports.top_by(shop.order_detail(), "sku_name").select("name", money("value"))


@query
def brand_top(shop: Shop) -> DataFrame:
    return reports.top_by(sold_lines(shop), "p_brand").select("name", money("value"))


@query
def category_share(shop: Shop) -> DataFrame:
    return reports.amount_by(sold_lines(shop), "p_type").select("name", money("value", 2))


@query
def area_orders(shop: Shop) -> DataFrame:
    return reports.area_orders(order_index(shop, province=True, names=False)).select("name", "orders", money("amount"))
