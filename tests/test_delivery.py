"""The comparison of serving with gold has to find every kind of difference."""

from datetime import date

import pytest

from lamina.plans import delivery
from lamina.schemas import HOURLY_KEYS, HOURLY_MEASURES
from tests.helpers import content

HOURLY = "event_date date, event_hour int, category string, source string, event_count long, revenue_events long, total_value double"
DAILY = "event_date date, total_events long, unique_users long, revenue_events long, total_revenue double, avg_value double"
DAY = date(2024, 1, 1)
ROWS = [(DAY, 1, "a", "web", 3, 1, 10.0), (DAY, 1, "b", "web", 3, 0, 20.0), (DAY, 2, "a", "api", 1, 0, 1.0)]
DAYS = [(DAY, 7, 2, 1, 10.0, 4.43)]


@pytest.fixture
def compared(spark):
    gold_hourly, gold_daily = spark.createDataFrame(ROWS, HOURLY), spark.createDataFrame(DAYS, DAILY)

    def run(hourly, daily=DAYS):
        served = spark.createDataFrame(hourly, HOURLY), spark.createDataFrame(daily, DAILY)
        report = {r["event_hour"]: r for r in delivery.validate(gold_hourly, gold_daily, *served).collect()}
        found = [r["mismatch"] for r in delivery.mismatches(gold_hourly, served[0]).collect()]
        found += [r["mismatch"] for r in delivery.daily_mismatches(gold_daily, served[1]).collect()]
        assert content(delivery.differences_below(gold_hourly, served[0])) == content(delivery.mismatches(gold_hourly, served[0]))
        return report, sorted(found)

    return run


def changed(index, **fields):
    names = [c.split()[0] for c in HOURLY.split(", ")]
    row = tuple(fields.get(n, v) for n, v in zip(names, ROWS[index]))
    return [row if i == index else r for i, r in enumerate(ROWS)]


def test_equal(compared):
    report, found = compared(ROWS)
    assert {r["overall_status"] for r in report.values()} == {"pass"} and not found


def test_within_tolerance(compared):
    report, found = compared(changed(0, total_value=10.004))
    assert report[1]["overall_status"] == "pass" and not found


def test_changed_value(compared):
    report, found = compared(changed(0, total_value=10.5))
    assert (report[1]["hourly_value_match"], report[1]["overall_status"], report[2]["overall_status"]) == (0, "fail", "pass")
    assert found == ["different"]


def test_swapped_values_leave_totals_alone(compared):
    report, found = compared([ROWS[0][:6] + (20.0,), ROWS[1][:6] + (10.0,), ROWS[2]])
    assert report[1]["overall_status"] == "pass" and found == ["different", "different"]


def test_missing_and_surplus_rows(compared):
    report, found = compared(ROWS[1:])
    assert report[1]["hourly_rows_match"] == 0 and found == ["missing"]
    report, found = compared(ROWS + [(DAY, 3, "a", "web", 1, 0, 1.0)])
    assert report[3]["overall_status"] == "fail" and report[3]["gold_hourly_rows"] == 0 and found == ["surplus"]


def test_daily(compared):
    report, found = compared(ROWS, [(DAY, 8, 2, 1, 10.0, 4.43)])
    assert {r["daily_events_match"] for r in report.values()} == {0} and found == ["different"]
    report, found = compared(ROWS, [])
    assert {r["daily_rows_match"] for r in report.values()} == {0} and found == ["missing"]


def test_unchecked_measures_are_checked_by_row(compared):
    _, found = compared(ROWS, [(DAY, 7, 3, 1, 10.0, 4.43)])
    assert found == ["different"]


def test_only_parts_that_differ_are_gone_into(spark):
    other = date(2024, 1, 2)
    gold = spark.createDataFrame([*ROWS, (other, 1, "a", "web", 3, 1, 10.0), (other, 2, "a", "web", 3, 1, 10.0)], HOURLY)
    served = spark.createDataFrame([*ROWS[::-1], (other, 1, "a", "web", 4, 1, 10.0), (other, 2, "a", "web", 3, 1, 10.0)], HOURLY)
    columns = [*HOURLY_KEYS, *HOURLY_MEASURES]
    assert [tuple(r) for r in delivery.differing_parts(gold, served, columns, ["event_date"]).collect()] == [(other,)]
    assert [tuple(r) for r in delivery.differing_parts(gold, served, columns, ["event_date", "event_hour"]).collect()] == [(other, 1)]


def test_rows_with_the_same_hashes_but_for_where_a_null_is(spark):
    gold, served = (spark.createDataFrame([(DAY, 1, *names, 1, 0, 1.0)], HOURLY) for names in (("x", None), (None, "x")))
    assert sorted(r["mismatch"] for r in delivery.differences_below(gold, served).collect()) == ["missing", "surplus"]
    assert delivery.mismatches(gold, gold).isEmpty()


def test_differences_by_measure(spark):
    gold = spark.createDataFrame(ROWS, HOURLY)
    found = delivery.mismatches(gold, spark.createDataFrame([*changed(0, event_count=5, total_value=10.001)[:2], (DAY, 3, "a", "api", 1, 0, None)], HOURLY))
    cells = [(r["event_hour"], r["mismatch"], r["measure"], r["gold_value"], r["serving_value"]) for r in delivery.by_measure(found, HOURLY_MEASURES).collect()]
    assert sorted(cells, key=repr) == [
        (1, "different", "event_count", 3.0, 5.0),
        (2, "missing", "event_count", 1.0, None), (2, "missing", "revenue_events", 0.0, None), (2, "missing", "total_value", 1.0, None),
        (3, "surplus", "event_count", None, 1.0), (3, "surplus", "revenue_events", None, 0.0), (3, "surplus", "total_value", None, None),
    ]
