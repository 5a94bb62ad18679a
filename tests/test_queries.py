"""Every registered query against its SQL in another engine."""

import pytest

import __spark_entry__ as entry
from checks import oracle_sql
from checks.compare import differences, duck
from lamina import registry
from tests.conftest import SMALL

# These apply five deliveries each; test_batch_run covers the same ground on few rows, checks.compare runs them.
SLOW = {"gold_hourly_as_of", "incremental_replay", "recovery_replay", "stream_replay"}
NAMES = sorted(set(registry.queries()) - SLOW)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle_sql.statements())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, con, name):
    assert differences(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) == ""


def test_known_counts(spark):
    queries = entry.queries()
    reasons = {r["rejection_reason"]: r["row_count"] for r in queries["quarantine_by_reason"](spark, SMALL).collect()}
    assert reasons == {"empty_event_id": 48, "empty_user_name": 29, "empty_event_id,empty_user_name": 22}
    assert queries["silver_fact_current"](spark, SMALL).count() == 901
    assert queries["silver_fact_current"](spark, SMALL).where("is_revenue_event = 1").count() == 176
    assert queries["dim_users_scd2"](spark, SMALL).count() == 361
    assert queries["serving_upsert_hourly"](spark, SMALL).count() == 743


def test_entry(spark):
    assert entry.entry(spark).count() == 30


def test_delivery_fails_only_where_corrections_are_missing(spark):
    report = entry.queries()["delivery_validation"](spark, SMALL)
    assert report.where("event_date = '2024-01-10' and overall_status = 'fail'").isEmpty()
    assert not report.where("event_date > '2024-01-21' and overall_status = 'fail'").isEmpty()
