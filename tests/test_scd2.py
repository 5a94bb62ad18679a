"""User versions: both forms against each other and against a plain loop."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lamina.functions import OPEN_END
from lamina.plans import scd2, silver
from lamina.schemas import EXACT
from lamina.sources import event_feed
from lamina.sources.event_feed import delivery_time
from tests.conftest import SMALL
from tests.helpers import content, raw_rows, users_of


@pytest.fixture(scope="module")
def facts(spark):
    daily = event_feed.deliveries(event_feed.events(spark, SMALL), "day")
    return silver.facts_from_raw(daily).cache()


def looped(facts, carry_totals):
    """Delivery after delivery in plain Python, over a small table."""
    batches = {}
    for r in facts.collect():
        batches.setdefault(r["batch_id"], {}).setdefault(r["user_name"], []).append(r)
    history, open_rows = [], {}

    def top(rows, column):
        values = [r[column] for r in rows]
        return min(set(values), key=lambda v: (-values.count(v), v))

    for batch_id in sorted(batches):
        ts = datetime.strptime(batch_id[6:], "%Y-%m-%d")
        for user, rows in batches[batch_id].items():
            new = {
                "user_name": user, "first_seen_date": min(r["event_date"] for r in rows),
                "last_seen_date": max(r["event_date"] for r in rows), "primary_category": top(rows, "category"),
                "primary_source": top(rows, "source"), "total_events": len(rows),
                "cents": round(sum(r["value"] for r in rows) * 100),
                "is_revenue_user": max(r["is_revenue_event"] for r in rows), "valid_from": ts, "valid_to": OPEN_END,
                "is_current": 1,
            }
            old = open_rows.get(user)
            if old:
                same = all(old[c] == new[c] for c in ("primary_category", "primary_source"))
                if same or carry_totals:
                    new["first_seen_date"] = old["first_seen_date"]
                    new["total_events"] += old["total_events"]
                    new["cents"] += old["cents"]
                    new["is_revenue_user"] = max(old["is_revenue_user"], new["is_revenue_user"])
                if same:
                    new["valid_from"] = old["valid_from"]
                else:
                    history.append({**old, "valid_to": ts, "is_current": 0})
            open_rows[user] = new
    out = history + list(open_rows.values())
    return sorted((tuple(sorted(r.items())) for r in out), key=repr)


@pytest.mark.parametrize("carry_totals", [True, False])
def test_one_pass_equals_loop(facts, carry_totals):
    ours = users_of(facts, carry_totals).withColumn("cents", F.round(F.col("total_value") * 100).cast("int"))
    assert content(ours, "user_key", "total_value") == looped(facts, carry_totals)


@pytest.mark.parametrize("carry_totals", [True, False])
def test_step_by_step_equals_one_pass(spark, facts, carry_totals):
    profiles = scd2.user_profiles(scd2.user_activity(facts, delivery_time(F.col("batch_id"))))
    whole = scd2.user_versions(profiles, carry_totals).drop("version_no").cache()
    early = profiles.where("batch_id < 'batch_2024-01-15'")
    state = scd2.user_versions(early, carry_totals).drop("version_no").withColumn("change", F.lit(None).cast("string"))
    days = [f"batch_2024-01-{d}" for d in (15, 16)]
    counts = []
    for day in days:
        step = scd2.advance_versions(
            state.where("is_current = 1").drop("change"), profiles.where(F.col("batch_id") == day), carry_totals
        )
        closed = state.where("is_current = 0").select(*step.columns)
        state = spark.createDataFrame(closed.unionByName(step).collect(), step.schema)
        counts.append(state.where("change = 'changed'").count())
    expected = scd2.user_versions(profiles.where("batch_id <= 'batch_2024-01-16'"), carry_totals)
    assert content(state, "change") == content(expected, "version_no")
    opened = [datetime(2024, 1, d) for d in (15, 16)]
    assert counts[-1] >= whole.where(F.col("valid_from") == opened[-1]).count() > 0
    assert dict(state.dtypes)["value_exact"] == EXACT.simpleString()


def test_versions_are_contiguous(facts):
    users = users_of(facts)
    assert users.where("is_current = 1").groupBy("user_name").count().where("count <> 1").isEmpty()
    a, b = users.alias("a"), users.alias("b")
    closed = users.where("is_current = 0").count()
    linked = a.join(b, (F.col("a.user_name") == F.col("b.user_name")) & (F.col("a.valid_to") == F.col("b.valid_from")))
    assert linked.count() == closed


def test_ties_take_the_first_in_order(spark):
    raw = raw_rows(
        spark,
        ("e1", "ann", "view", "web", 1.0, "2024-01-01 10:00", "batch_2024-01-01"),
        ("e2", "ann", "click", "api", 1.0, "2024-01-01 10:00", "batch_2024-01-01"),
    )
    row = users_of(silver.facts_from_raw(raw)).first()
    assert (row["primary_category"], row["primary_source"]) == ("click", "api")


def test_taking_away_cancels(spark):
    raw = raw_rows(
        spark,
        ("e1", "ann", "view", "web", 1.0000000001, "2024-01-01 10:00", "batch_2024-01-01"),
        ("e2", "ann", "view", "web", float("nan"), "2024-01-01 10:00", "batch_2024-01-01"),
    )
    facts = silver.facts_from_raw(raw)
    ts = delivery_time(F.col("batch_id"))
    gone = scd2.user_activity(facts.where("event_id = 'e2'"), ts, taken_away=True)
    left = scd2.net_activity(scd2.user_activity(facts, ts).unionByName(gone))
    assert scd2.user_versions(scd2.user_profiles(left)).first()["total_value"] == 1.0000000001
    all_gone = scd2.user_activity(facts, ts).unionByName(scd2.user_activity(facts, ts, taken_away=True))
    assert scd2.net_activity(all_gone).isEmpty()
