"""Publishing partitions."""

from datetime import date, datetime

import pytest

from lamina.schemas import HOURLY_KEYS, RPT_DAILY_SUMMARY, STG_EVENTS
from lamina.session import fresh_folder
from lamina.sources.store import Store
from tests.helpers import content, raw_rows

AT = datetime(2024, 1, 1)


def daily(spark, *days):
    rows = [(date(2024, 1, d), n, 1, 0, 0.0, 0.0, AT) for d, n in days]
    return spark.createDataFrame(rows, RPT_DAILY_SUMMARY.schema)


def test_only_the_scope_is_replaced(spark, store):
    store.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1), (2, 1), (3, 1)), [()])
    second = store.staged("b", "s", daily(spark, (2, 5)))
    for _ in range(2):  # repeating it changes nothing
        store.publish(RPT_DAILY_SUMMARY, second, [(date(2024, 1, 2),), (date(2024, 1, 3),)])
    found = {r["event_date"].day: r["total_events"] for r in store.read(RPT_DAILY_SUMMARY).collect()}
    assert found == {1: 1, 2: 5}


def test_only_wanted_partitions_are_listed(spark, store):
    store.publish(RPT_DAILY_SUMMARY, daily(spark, *[(d, d) for d in range(1, 31)]), [()])
    some = store.read(RPT_DAILY_SUMMARY, [(date(2024, 1, 5),), (date(2024, 2, 5),)])
    assert [r["total_events"] for r in some.collect()] == [5] and len(some.inputFiles()) == 1
    many = store.read(RPT_DAILY_SUMMARY, [(date(2024, 1, d),) for d in range(1, 26)])
    assert many.count() == 25


def test_staging_is_reused_when_complete(spark, store):
    first = store.staged("b", "s", daily(spark, (1, 1)))
    assert content(store.staged("b", "s", daily(spark, (1, 2)))) == content(first)
    store.clear_staging("b")
    assert store.staged("b", "s", daily(spark, (1, 2))).first()["total_events"] == 2


def test_odd_delivery_names(spark, store):
    from lamina.plans import bronze

    names = ["manual__2024-01-01T00:00:00+00:00", "a b/c=d%e", "x{1}"]
    rows = raw_rows(spark, *[("e", "u", "c", "s", 1.0, "2024-01-01 10:00", n) for n in names])
    bronze.ingest(store, rows, AT)
    bronze.ingest(store, rows, AT)
    assert sorted(store.first_level(STG_EVENTS)) == sorted(names)
    for name in names:
        assert [r["batch_id"] for r in store.read(STG_EVENTS, [(name,)]).collect()] == [name]


def test_hot_partition_is_split(spark, store):
    """A partition with most of the rows is written by several tasks."""
    from pyspark.sql import functions as F

    from lamina.sources.store import arranged

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 50)).alias("batch_id"),
        )
        arranged(rows, STG_EVENTS).write.partitionBy("batch_id").parquet(f"{store.root}/skewed")
        back = spark.read.parquet(f"{store.root}/skewed")
        assert back.count() == 60_000
        assert len(spark.read.parquet(f"{store.root}/skewed/batch_id=hot").inputFiles()) > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_bucket_count_is_kept(spark):
    root = fresh_folder(spark, "test")
    assert Store(spark, root, 8).user_buckets == 8
    assert Store(spark, root).user_buckets == 8
    with pytest.raises(ValueError, match="8 user buckets"):
        Store(spark, root, 4)


def test_keys_are_columns():
    from lamina.schemas import TABLES

    for t in TABLES:
        assert set(t.keys + t.partition_by + t.sort_by + t.metrics + t.nullable) <= set(t.column_names), t.table_id
        assert t.version is None or t.version in t.column_names
        assert t.contract == "append" or t.keys
    assert HOURLY_KEYS == ("event_date", "event_hour", "category", "source")
