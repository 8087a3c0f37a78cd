"""Dashboard reports over page views and order lines.

The dashboard asks for these by name and number of days; what each measure
means is settled here. A visit starts with a page view that has no page before
it and lasts until the device's next such view; it bounces when it has a single
page view, and takes its attributes from its first. Views without a device or a user count as views, never as a device or a
user. Every other report first sums by its finest key, so a hot
device or order shrinks to one row per task before any shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmart.functions.time import ms_date

DAYS = 7  # fixed value: default number of days
TOP = 7  # fixed value: default length of a top list


def last_days(df: DataFrame, until: str, days: int = DAYS, column: str = "dt") -> DataFrame:
    """Rows of the ``days`` days that end with ``until``."""
    if days < 1:
        raise ValueError("days must be at least 1")
    first = dt.date.fromisoformat(until) - dt.timedelta(days=days - 1)
    return df.where(F.col(column).between(str(first), until))


def dated(page_log: DataFrame) -> DataFrame:
    return page_log.withColumn("dt", ms_date(F.col("ts")))


# ---- page views (rows with ``dt``) ------------------------------------------------


def pv_by_day(views: DataFrame) -> DataFrame:
    return views.groupBy("dt").agg(F.count("*").alias("pv"))


def uv_by_day(views: DataFrame) -> DataFrame:
    return views.groupBy("dt").agg(F.count_distinct("mid").alias("uv"))


def visit_total(views: DataFrame) -> DataFrame:
    """``(pv_count, uv_count, new_count)`` in one row; views that name no device are views, but no device."""
    devices = views.groupBy("mid").agg(F.count("*").alias("pv"), F.max((F.col("is_new") == "1").cast("int")).alias("new"))
    return devices.agg(
        F.coalesce(F.sum("pv"), F.lit(0)).alias("pv_count"),
        F.count("mid").alias("uv_count"),
        F.coalesce(F.sum(F.when(F.col("mid").isNotNull(), F.col("new"))), F.lit(0)).alias("new_count"),
    )


SLICE_MS = 60_000  # views of a device within one such slice of time are put in order by one task


def sessions(views: DataFrame) -> DataFrame:
    """Views with ``session``, the number of visits the device has started so far.

    A prefix sum in two levels: the running count is made within each slice of time of a device, and begins with the count of
    its earlier slices, of which there is one small row each. So no task puts a whole device in order, be it a hot one or the
    views that name none. These small rows go through the same shuffle as the views and stand first in their slice; a join
    would broadcast them, as Spark takes them for few. Views before a device's first start are session 0. Views of one
    millisecond are told apart by one hash of all that they hold.
    """
    slice_of = ["mid", "dt", "_slice"]
    cut = views.withColumns({"_slice": F.floor(F.col("ts") / SLICE_MS), "_starts": F.col("last_page_id").isNull().cast("bigint")})
    rest = [c for c in views.columns if c not in ("mid", "dt", "ts")]
    earlier = Window.partitionBy("mid").orderBy("dt", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy(*slice_of).agg(F.sum("_starts").alias("_starts")).select(
        *slice_of, F.coalesce(F.sum("_starts").over(earlier), F.lit(0)).alias("_starts"), F.lit(False).alias("_view")
    )
    marked = cut.withColumns({"_tie": F.xxhash64(*rest), "_view": F.lit(True)})
    here = Window.partitionBy(*slice_of).orderBy("_view", "ts", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    both = marked.unionByName(before, allowMissingColumns=True).withColumn("session", F.sum("_starts").over(here))
    return both.where("_view").select(*views.columns, "session")


def visits(views: DataFrame, *by: str) -> DataFrame:
    """One row per visit: page count, time spent, and the ``by`` columns of its first view."""
    return sessions(views).groupBy("mid", "session").agg(
        *[F.min_by(c, F.struct("ts", c)).alias(c) for c in by],
        F.count("*").alias("pages"),
        F.coalesce(F.sum("during_time"), F.lit(0)).alias("millis"),
    )


def _bounce() -> Column:
    return F.avg((F.col("pages") == 1).cast("double"))


def new_vs_old(views: DataFrame) -> DataFrame:
    """By ``is_new``: page views, devices, bounce rate, mean seconds and mean pages of a visit."""
    devices = visits(views, "is_new").groupBy("is_new", "mid").agg(
        F.count("*").alias("visits"),
        F.sum("pages").alias("pages"),
        F.sum("millis").alias("millis"),
        F.sum((F.col("pages") == 1).cast("int")).alias("bounced"),
    )
    total = F.sum("visits")
    return devices.groupBy("is_new").agg(
        F.sum("pages").alias("pv"),
        F.count("mid").alias("uv"),
        (F.sum("bounced") / total).alias("bounce_rate"),
        (F.sum("millis") / 1000 / total).alias("mean_seconds"),
        (F.sum("pages") / total).alias("mean_pages"),
    )


def channel_pv(views: DataFrame) -> DataFrame:
    return views.groupBy("channel").agg(F.count("*").alias("pv"))


def channel_bounce(views: DataFrame) -> DataFrame:
    return visits(views, "channel").groupBy("channel").agg(_bounce().alias("bounce_rate"))


def page_path(views: DataFrame) -> DataFrame:
    """Links ``(source, target, value)`` from each page to the next."""
    steps = views.where(F.col("last_page_id").isNotNull())
    return steps.groupBy(F.col("last_page_id").alias("source"), F.col("page_id").alias("target")).agg(
        F.count("*").alias("value")
    )


def page_path_nodes(views: DataFrame) -> DataFrame:
    """The pages of ``page_path``."""
    ends = page_path(views).select(F.explode(F.array("source", "target")).alias("name"))
    return ends.distinct()


def action_funnel(views: DataFrame, actions: DataFrame, steps: dict[str, tuple[str, str]]) -> DataFrame:
    """``(step, users)``: users who reached each step, a ``("page", id)`` seen or an ``("action", id)`` done. Null is no user."""
    seen = views.select("user_id", F.lit("page").alias("kind"), F.col("page_id").alias("id"))
    done = actions.select("user_id", F.lit("action").alias("kind"), F.col("action_id").alias("id"))
    tests = [(F.col("kind") == kind) & (F.col("id") == name) for kind, name in steps.values()]
    reached = seen.union(done).where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        *[F.max(F.coalesce(test, F.lit(False)).cast("int")).alias(f"_{i}") for i, test in enumerate(tests)]
    )
    counts = reached.agg(*[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(steps))])
    pairs = [F.struct(F.lit(step).alias("step"), F.col(f"_{i}").alias("users")) for i, step in enumerate(steps)]
    return counts.select(F.inline(F.array(*pairs)))


# ---- users and orders --------------------------------------------------------------------


def user_total(users: DataFrame, views: DataFrame, info: DataFrame) -> DataFrame:
    """One row: all users, users with orders, new users, and new users with orders.

    A user is new when the page log says so. Each source first shrinks to one
    row per user.
    """
    ordered = info.groupBy(F.col("user_id").alias("id")).agg(F.lit(1).alias("ordered"))
    fresh = (
        views.where(F.col("is_new") == "1")
        .groupBy(F.col("user_id").cast(users.schema["id"].dataType).alias("id"))
        .agg(F.lit(1).alias("new"))
    )
    flags = users.select("id").join(ordered, "id", "left").join(fresh, "id", "left")
    new, has_orders = F.col("new").isNotNull(), F.col("ordered").isNotNull()
    return flags.agg(
        F.count("*").alias("user_total"),
        F.count_if(has_orders).alias("order_user_total"),
        F.count_if(new).alias("new_user_count"),
        F.count_if(new & has_orders).alias("new_order_user_count"),
    )


def paid_share(users: DataFrame, info: DataFrame) -> DataFrame:
    """``(name, value)``: users with and without orders."""
    ordered = info.select(F.col("user_id").alias("id")).distinct().withColumn("ordered", F.lit(True))
    flags = users.select("id").join(ordered, "id", "left")
    name = F.when(F.col("ordered"), "paid").otherwise("unpaid")
    return flags.groupBy(name.alias("name")).agg(F.count("*").alias("value"))


def order_total(info: DataFrame) -> DataFrame:
    """``(order_count, order_amount, order_user)`` in one row."""
    by_user = info.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("total_amount").alias("amount"))
    return by_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("order_count"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("order_amount"),
        F.count("user_id").alias("order_user"),
    )


def amount_by(lines: DataFrame, field: str) -> DataFrame:
    """``(name, value)``: line amounts by any column: product, brand, category."""
    return lines.groupBy(F.col(field).alias("name")).agg(F.sum("split_total_amount").alias("value"))


def top_by(lines: DataFrame, field: str, num: int = TOP) -> DataFrame:
    """The ``num`` names with the highest amounts."""
    if num < 1:
        raise ValueError("num must be at least 1")
    return amount_by(lines, field).orderBy(F.desc("value"), "name").limit(num)


def area_orders(wide: DataFrame) -> DataFrame:
    """``(name, orders, amount)`` by province."""
    per_order = wide.groupBy("province_name", "order_id").agg(F.sum("split_total_amount").alias("amount"))
    return per_order.groupBy(F.col("province_name").alias("name")).agg(
        F.count("*").alias("orders"), F.sum("amount").alias("amount")
    )
