"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lamina import registry
from lamina.plans import gold
from lamina.schemas import FACT_EVENTS
from tests.conftest import SMALL

RUNS_JOBS = {"bronze_ingest", "export_hourly_roundtrip", "export_daily_roundtrip", "incremental_replay", "stream_replay",
             "recovery_replay", "batch_ledger"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - RUNS_JOBS))
def test_no_pairs_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
        assert unwanted not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(entry.queries()["gold_daily_full"](spark, SMALL))
    assert "props" not in plan
    narrow = plan_of(entry.queries()["quarantine_by_reason"](spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in narrow


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(registry.facts(spark, SMALL))
    above, below = plan.split("Exchange hashpartitioning(event_id", 1)
    assert "WindowGroupLimit" in below.split("Scan")[0] and "Partial" not in above


def test_only_the_grouped_columns_travel(spark):
    """Hourly figures don't need the user, daily ones neither category nor channel, beyond a hash for ties."""
    plan = plan_of(entry.queries()["gold_daily_full"](spark, SMALL))
    exchanged = plan.split("Exchange hashpartitioning(event_id", 1)[1].split("WindowGroupLimit", 1)[0]
    assert "category" not in exchanged


def test_users_are_shuffled_after_they_are_combined(spark):
    plan = plan_of(entry.queries()["dim_users_scd2"](spark, SMALL))
    exchanges = [line for line in plan.splitlines() if "Exchange " in line]
    assert len(exchanges) == 4  # events, activity, profiles by delivery, versions by user
    assert "hashpartitioning(user_name" in exchanges[0]


@pytest.mark.parametrize("name", ["gold_hourly_for_batch", "gold_daily_for_batch"])
def test_other_days_are_left_out_before_the_grouping(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    assert plan.count("Scan parquet") == 2 and plan.count("Join") == 1
    above, below = plan.split("BroadcastHashJoin", 1)
    assert "LeftSemi" in below.splitlines()[0] and "Aggregate" in above


@pytest.mark.parametrize("figures", [gold.hourly_kpis_for_batch, gold.daily_kpis_for_batch])
def test_stored_facts_are_pruned_to_the_touched_days(spark, store, figures):
    rows = registry.facts(spark, SMALL).withColumn("_loaded_at", F.lit(None).cast("timestamp"))
    store.publish(FACT_EVENTS, rows, [()])
    plan = plan_of(figures(store.read(FACT_EVENTS), registry.BATCH))
    assert any("dynamicpruning" in line for line in plan.splitlines() if "PartitionFilters" in line)
