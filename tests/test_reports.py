import pytest

from rillmart.operators import reports


@pytest.fixture
def views(spark):
    rows = [
        # mid, user_id, dt, is_new, channel, page_id, last_page_id, during_time, ts
        ("a", "1", "2024-01-01", "1", "x", "home", None, 1000, 1),
        ("a", "1", "2024-01-01", "1", "x", "cart", "home", 3000, 2),
        ("a", "1", "2024-01-02", "0", "x", "home", None, None, 5),
        ("b", "2", "2024-01-02", "0", "y", "home", None, 2000, 4),
    ]
    return spark.createDataFrame(
        rows,
        "mid STRING, user_id STRING, dt STRING, is_new STRING, channel STRING, page_id STRING, last_page_id STRING,"
        " during_time BIGINT, ts BIGINT",
    )


def only(df):
    return df.collect()[0].asDict()


def test_visits(views):
    assert only(reports.visit_total(views)) == {"pv_count": 4, "uv_count": 2, "new_count": 1}
    assert only(reports.visit_total(views.where("false"))) == {"pv_count": 0, "uv_count": 0, "new_count": 0}
    assert {r.dt: r.uv for r in reports.uv_by_day(views).collect()} == {"2024-01-01": 1, "2024-01-02": 2}
    assert only(reports.visit_total(reports.last_days(views, "2024-01-02", 1)))["pv_count"] == 2
    with pytest.raises(ValueError):
        reports.last_days(views, "2024-01-08", 0)


def test_new_and_old(views):
    rows = {r.is_new: r for r in reports.new_vs_old(views).collect()}
    assert (rows["1"].pv, rows["1"].uv, rows["1"].bounce_rate, rows["1"].mean_seconds, rows["1"].mean_pages) == (
        2, 1, 0.0, 4.0, 2.0,
    )
    assert (rows["0"].pv, rows["0"].uv, rows["0"].bounce_rate, rows["0"].mean_seconds) == (2, 2, 1.0, 1.0)
    assert {r.channel: r.bounce_rate for r in reports.channel_bounce(views).collect()} == {"x": 0.5, "y": 1.0}


def test_two_visits_a_day_and_one_over_midnight(spark, views):
    rows = [
        ("c", "2024-01-01", "home", None, 1), ("c", "2024-01-01", "home", None, 2), ("c", "2024-01-01", "cart", "home", 3),
        ("c", "2024-01-02", "pay", "cart", 4), ("c", "2024-01-02", "home", None, 5),
    ]
    more = spark.createDataFrame(rows, "mid STRING, dt STRING, page_id STRING, last_page_id STRING, ts BIGINT")
    numbers = {r.ts: r.session for r in reports.sessions(more).collect()}
    assert numbers == {1: 1, 2: 2, 3: 2, 4: 2, 5: 3}


def test_paths_and_funnel(spark, views):
    assert [tuple(r) for r in reports.page_path(views).collect()] == [("home", "cart", 1)]
    assert {r.name for r in reports.page_path_nodes(views).collect()} == {"home", "cart"}
    steps = {"home": ("page", "home"), "cart": ("action", "cart_add"), "pay": ("page", "payment")}
    actions = spark.createDataFrame([("2", "cart_add"), ("2", "cart_add"), ("1", "home")], "user_id STRING, action_id STRING")
    assert {r.step: r.users for r in reports.action_funnel(views, actions, steps).collect()} == {"home": 2, "cart": 1, "pay": 0}


def test_users_and_orders(spark, views):
    users = spark.createDataFrame([(1,), (2,), (3,)], "id BIGINT")
    info = spark.createDataFrame([(1, 5.0), (1, 7.0), (3, 1.0)], "user_id BIGINT, total_amount DOUBLE")
    assert only(reports.user_total(users, views, info)) == {
        "user_total": 3, "order_user_total": 2, "new_user_count": 1, "new_order_user_count": 1,
    }
    assert {r.name: r.value for r in reports.paid_share(users, info).collect()} == {"paid": 2, "unpaid": 1}
    assert only(reports.order_total(info)) == {"order_count": 3, "order_amount": 13.0, "order_user": 2}


def test_top(spark):
    lines = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "n STRING, split_total_amount DOUBLE")
    assert [r.name for r in reports.top_by(lines, "n", 2).collect()] == ["b", "c"]
    with pytest.raises(ValueError):
        reports.top_by(lines, "n", 0)


def test_slices_are_counted_without_a_join(views):
    """A join of the slices with the views would be planned as a broadcast, however many slices there are."""
    for report in (reports.channel_bounce(views), reports.new_vs_old(views)):
        assert "Join" not in report._jdf.queryExecution().toString()


def test_views_without_device_or_time_are_counted_through_their_slices(spark):
    minute = reports.SLICE_MS
    rows = [
        (None, "d", None, 1), (None, "d", None, 3 * minute), (None, "d", "home", 3 * minute + 1),
        (None, None, None, None), ("a", "d", "home", 1), ("a", "d", None, 2 * minute), ("a", "d", "home", 5 * minute),
    ]
    views = spark.createDataFrame(rows, "mid STRING, dt STRING, last_page_id STRING, ts BIGINT")
    found = {(r.mid, r.ts): r.session for r in reports.sessions(views).collect()}
    assert found == {
        (None, None): 1, (None, 1): 2, (None, 3 * minute): 3, (None, 3 * minute + 1): 3,
        ("a", 1): 0, ("a", 2 * minute): 1, ("a", 5 * minute): 1,
    }
