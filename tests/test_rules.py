"""Row rules on cases the events table doesn't have."""

import math

import pytest
from pyspark.sql import functions as F

from lamina.functions import money_sum
from lamina.operators import column_profile, keep_latest, upsert_by_key
from lamina.plans import gold, quality, silver
from lamina.sources import event_feed
from tests.helpers import content, raw_rows


def test_missing_keys(spark):
    raw = raw_rows(
        spark,
        ("e1", "  ", "click", "web", 1.0, "2024-01-01 10:00", "b1"),
        (None, "ann", "click", "web", 1.0, "2024-01-01 10:00", "b1"),
        ("", None, "click", "web", 1.0, "2024-01-01 10:00", "b1"),
        (" ", "ann", "click", "web", 1.0, "2024-01-01 10:00", "b1"),
        ("e2", "ann", "click", "web", 1.0, "2024-01-01 10:00", "b1"),
    )
    reasons = sorted(r["rejection_reason"] for r in silver.rejected_rows(raw).collect())
    assert reasons == ["empty_event_id", "empty_event_id,empty_user_name", "empty_user_name"]
    assert sorted(r["event_id"] for r in silver.clean_events(raw).collect()) == [" ", "e2"]
    row = quality.row_accounting(raw).first()
    assert (row["bronze_rows"], row["valid_rows"], row["quarantined_rows"], row["is_balanced"]) == (5, 2, 3, 1)


def test_cleaning(spark):
    raw = raw_rows(
        spark,
        ("e1", " Ann ", "PURCHASE", " Web", 5.0, "2024-01-01 23:59", "b1"),
        ("e2", "ann", " purchase", "web", -5.0, "2024-01-01 00:00", "b1"),
        ("e3", "ann", "purchase", "web", float("nan"), "2024-01-01 00:00", "b1"),
        ("e4", "ann", "purchase", None, None, "2024-01-01 00:00", "b1"),
    )
    rows = {r["event_id"]: r for r in silver.clean_events(raw).collect()}
    assert (rows["e1"]["user_name"], rows["e1"]["source"], rows["e1"]["event_hour"]) == ("ann", "web", 23)
    assert [rows[e]["is_revenue_event"] for e in ("e1", "e2", "e3", "e4")] == [1, 0, 0, 0]
    assert rows["e2"]["value"] == 0.0 and math.isnan(rows["e3"]["value"])
    assert rows["e4"]["value"] == 0.0 and rows["e4"]["source"] == ""


def test_money(spark):
    def total(*values):
        df = spark.createDataFrame([(float(v),) for v in values], "value double")
        return df.agg(money_sum(F.col("value")).alias("t")).first()["t"]

    assert total(*[0.1] * 10) == 1.0
    assert total(0.001, 0.002) == 0.003
    assert total(1e17, 0.01, -1e17) == 0.01
    assert total(1e30, 1.0) == 1e30
    assert math.isnan(total(1.0, float("nan")))
    assert total(1.0, float("inf")) == float("inf")
    assert spark.range(0).select(F.lit(1.0).alias("v")).agg(money_sum(F.col("v")).alias("t")).first()["t"] == 0.0


def test_nan_shows_in_figures(spark):
    raw = raw_rows(
        spark,
        ("e1", "ann", "view", "web", float("nan"), "2024-01-01 10:00", "b1"),
        ("e2", "ann", "view", "web", 2.0, "2024-01-01 11:00", "b1"),
    )
    facts = silver.facts_from_raw(raw)
    by_hour = {r["event_hour"]: r["total_value"] for r in gold.hourly_kpis(facts).collect()}
    assert math.isnan(by_hour[10]) and by_hour[11] == 2.0
    assert math.isnan(gold.daily_kpis(facts).first()["avg_value"])


def test_newest_copy_wins(spark):
    raw = raw_rows(
        spark,
        ("e1", "ann", "view", "web", 1.0, "2024-01-01 10:00", "b1"),
        ("e1", "bob", "view", "web", 2.0, "2024-01-02 10:00", "b2"),
        ("e1", "ann", "view", "web", 9.0, "2024-01-01 10:00", "b1"),
        ("e2", "ann", "view", "web", 3.0, "2024-01-01 10:00", "b1"),
        ("e2", "ann", "view", "web", 4.0, "2024-01-01 10:00", "b1"),
    )
    rows = {r["event_id"]: r for r in silver.facts_from_raw(raw).collect()}
    assert rows["e1"]["user_name"] == "bob" and rows["e2"]["value"] == 4.0


def test_keep_latest_on_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    rows = keep_latest(df, ["k"], "v")
    assert rows.count() == 20_001
    assert rows.where("k = -1").first()["v"] == 29_997


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    rows = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    once = upsert_by_key(target, rows, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "x"), (3, "y")]
    assert content(upsert_by_key(once, rows, ["k"])) == content(once)
    with pytest.raises(Exception, match="upsert got a key twice: 3"):
        upsert_by_key(target, rows.union(rows.where("k = 3")), ["k"]).collect()
    nothing = spark.createDataFrame([(None, None)], "k int, v string")
    assert sorted(map(tuple, upsert_by_key(target, rows.limit(0), ["k"]).collect())) == [(1, "a"), (2, "b")]
    assert [tuple(r) for r in upsert_by_key(spark.createDataFrame([(None, "a")], "k int, v string"), nothing, ["k"]).collect()] == [(None, None)]


def test_time_of_a_delivery(spark):
    times = {
        "batch_2024-01-20": "2024-01-20 00:00:00", "batch_2024-01-20 11": "2024-01-20 11:00:00",
        "batch_2024-01-20 11:30": "2024-01-20 11:30:00", "scheduled__2024-01-01T00:00:00+00:00": "2024-01-01 00:00:00",
        "manual__2024-01-01T10:15:30.123456+02:00": "2024-01-01 08:15:30", "2024-02-03_09 again": "2024-02-03 09:00:00",
    }
    rows = spark.createDataFrame([(i,) for i in times], "id string").select("id", event_feed.delivery_time(F.col("id")).cast("string").alias("at"))
    assert {r["id"]: r["at"] for r in rows.collect()} == times
    with pytest.raises(Exception, match="no date in delivery id night run"):
        spark.createDataFrame([("night run",)], "id string").select(event_feed.delivery_time(F.col("id"))).collect()



def test_profile_with_sketch_agrees_on_the_exact_parts(spark):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 2)], "s string, n int")
    exact = {r["column_name"]: r for r in column_profile(df).collect()}
    assert (exact["s"]["missing_count"], exact["s"]["distinct_count"]) == (2, 2)
    assert (exact["n"]["distinct_count"], exact["n"]["min_value"], exact["n"]["max_value"]) == (2, "1", "2")
    assert content(column_profile(df, exact_distinct=False), "distinct_count") == content(
        column_profile(df), "distinct_count"
    )


def test_zero_is_one_value(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x double")
    assert column_profile(rows).first()["distinct_count"] == column_profile(rows, exact_distinct=False).first()["distinct_count"] == 2
