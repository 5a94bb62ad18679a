"""Applying deliveries one by one must give what all rows at once give."""

import json

import pytest
from pyspark.sql import functions as F

from lamina.functions import user_bucket
from lamina.plans import batch_run, bronze, delivery, gold, serve, silver
from lamina.schemas import (
    AGG_EVENTS_HOURLY, AGG_EVENTS_HOURLY_HISTORY, BENCHMARK_LOG, COLUMN_REGISTRY, DAILY_STATES, DATA_LINEAGE, DELIVERY_DIFFERENCES, DIM_USERS, EVENT_KEYS,
    EXPORT_DAILY, EXPORT_HOURLY, FACT_EVENTS, PIPELINE_RUNS, QUARANTINE_EVENTS, RPT_DAILY_SUMMARY, RPT_DAILY_SUMMARY_HISTORY,
    SERVING_DAILY, SERVING_HOURLY, STG_EVENTS, TABLE_REGISTRY, TABLES, USER_NUMBERS, VALIDATION_LOG,
)
from tests.helpers import content, raw_rows, users_of

D1, NOON, D2, D3, LAST = (
    "batch_2024-01-01", "batch_2024-01-01 12", "batch_2024-01-02", "batch_2024-01-03", "batch_2024-01-04"
)
ROWS = {
    D1: [
        ("e1", "ann", "view", "web", 1.0, "2024-01-01 10:00"),
        ("e2", "ann", "click", "web", 2.0, "2024-01-01 11:00"),
        ("e3", "bob", "PURCHASE", " Web", 3.5, "2024-01-01 10:30"),
        ("e4", "cid", "purchase", "api", 4.0, "2023-12-31 23:00"),
        ("", "ann", "view", "web", 1.0, "2024-01-01 10:00"),
    ],
    # Comes last although it belongs between the others: newer than e1 of D1, older than e2 of D2.
    NOON: [
        ("e1", "ann", "view", "app", 1.5, "2024-01-01 10:00"),
        ("e2", "ann", "view", "app", 7.0, "2024-01-01 11:00"),
        ("e9", "dan", "view", "app", 1.0, "2024-01-01 12:00"),
    ],
    # e2 moves to another day, e3 to another user, so bob is gone; e4 leaves 2023-12-31 empty.
    D2: [
        ("e2", "ann", "click", "web", 2.0, "2024-01-02 00:10"),
        ("e3", "eve", "purchase", "web", 3.5, "2024-01-01 10:30"),
        ("e4", "cid", "view", "api", -4.0, "2024-01-02 09:00"),
        ("e5", "ann", "view", "web", 0.1, "2024-01-02 09:00"),
        ("e6", "ann", "view", "web", 0.2, "2024-01-02 09:00"),
    ],
    D3: [("", "x", "view", "web", 1.0, "2024-01-03 10:00"), ("e8", "   ", "view", "web", 1.0, "2024-01-03 10:00")],
    LAST: [("e7", "ann", "view", "web", 5.0, "2024-01-04 10:00"), ("e10", "eve", "click", "api", 5.0, "2024-01-04 10:00")],
}


def feed_of(spark, *batches):
    return raw_rows(spark, *[(*row, b) for b in batches for row in ROWS[b]])


def check(spark, store, *batches):
    """All tables of `store` against the same figures computed from all rows at once."""
    facts = silver.facts_from_raw(feed_of(spark, *batches)).cache()
    assert content(store.read(FACT_EVENTS), "_loaded_at") == content(facts)
    hourly, daily = gold.hourly_kpis(facts), gold.daily_kpis(facts)
    assert content(store.read(AGG_EVENTS_HOURLY), "_updated_at") == content(hourly)
    assert content(store.read(RPT_DAILY_SUMMARY), "_updated_at") == content(daily)
    assert content(store.read(SERVING_HOURLY), "updated_at") == content(hourly)
    assert content(store.read(SERVING_DAILY), "updated_at") == content(daily)
    assert content(store.read(EXPORT_HOURLY), "_updated_at") == content(delivery.export_layout(hourly))
    assert content(store.read(EXPORT_DAILY), "_updated_at") == content(daily)
    assert content(store.read(DIM_USERS).drop("value_exact", "value_rest", "user_bucket")) == content(users_of(facts))


@pytest.fixture(scope="module")
def applied(spark):
    """A store after the deliveries came in the order D1, D2, D3, LAST; D2 is interrupted once."""
    from lamina.session import fresh_folder
    from lamina.sources.store import Store

    store = Store(spark, fresh_folder(spark, "test"), user_buckets=4)
    results = {D1: batch_run.run_batch(store, feed_of(spark, D1), D1)}

    publish = Store.publish

    def breaks_at_users(self, spec, *arguments):
        if spec is DIM_USERS:
            raise RuntimeError("executors lost")
        publish(self, spec, *arguments)

    Store.publish = breaks_at_users
    try:
        with pytest.raises(RuntimeError, match="executors lost"):
            batch_run.run_batch(store, feed_of(spark, D2), D2)
    finally:
        Store.publish = publish
    results["after failure"] = [r["status"] for r in store.read_latest(PIPELINE_RUNS).where(F.col("batch_id") == D2).collect()]
    for batch_id in (D2, D3, LAST):
        results[batch_id] = batch_run.run_batch(store, feed_of(spark, batch_id), batch_id)
    return store, results


def test_in_order_with_an_interruption(spark, applied):
    store, results = applied
    assert results["after failure"] == ["failed"]
    check(spark, store, D1, D2, D3, LAST)


def test_counts(applied):
    _, results = applied
    assert results[D1]["bronze_rows"] == 5 and results[D1]["quarantined_rows"] == 1
    assert (results[D1]["silver_rows"], results[D1]["dim_users_new"], results[D1]["dim_users_updated"]) == (4, 3, 0)
    # Eve is new. Ann's click leaves the first delivery and cid has only the second one left.
    assert (results[D2]["silver_rows"], results[D2]["dim_users_new"]) == (5, 2)
    assert (results[D3]["silver_rows"], results[D3]["quarantined_rows"]) == (0, 2)
    assert (results[LAST]["dim_users_new"], results[LAST]["dim_users_updated"]) == (0, 1)


def test_applied_deliveries_are_skipped(spark, applied):
    store, _ = applied
    before = content(store.read(DIM_USERS))
    assert batch_run.run_batch(store, feed_of(spark, D2), D2) == {}
    assert content(store.read(DIM_USERS)) == before
    assert store.read(STG_EVENTS).count() == sum(len(ROWS[b]) for b in (D1, D2, D3, LAST))


def test_snapshots_hold_what_was_reported_before(applied):
    store, _ = applied
    days = store.read(RPT_DAILY_SUMMARY_HISTORY).where(F.col("_snapshot_batch") == D2)
    assert {str(r["event_date"]): r["total_events"] for r in days.collect()} == {"2023-12-31": 1, "2024-01-01": 3}
    assert store.read(RPT_DAILY_SUMMARY_HISTORY).where(F.col("_snapshot_batch") == D1).isEmpty()
    hours = store.read(AGG_EVENTS_HOURLY_HISTORY).where(F.col("_snapshot_batch") == D2)
    assert hours.agg(F.sum("event_count")).first()[0] == 4


def test_logs(applied):
    store, _ = applied
    runs = store.read_latest(PIPELINE_RUNS)
    assert sorted(r["status"] for r in runs.collect()) == ["failed"] + ["success"] * 4
    assert runs.where("completed_at is null").isEmpty()
    assert store.read(VALIDATION_LOG).where("overall_status <> 'pass'").isEmpty()
    steps = {r["task_name"]: r for r in store.read(BENCHMARK_LOG).where(F.col("batch_id") == D1).collect()}
    assert {(r["status"], str(r["event_date"]), r["event_hour"]) for r in steps.values()} == {("success", "2024-01-01", 0)}
    assert {name: (r["rows_in"], r["rows_out"]) for name, r in steps.items()} == {
        "quarantine_rows": (5, 1), "transform_silver": (5, 4), "update_dim_users": (4, 3), "snapshot_hourly": (0, 0),
        "snapshot_daily": (0, 0), "aggregate_hourly": (4, 4), "aggregate_daily": (4, 2), "export_hourly": (4, 4),
        "export_daily": (2, 2), "serve_hourly": (4, 4), "serve_daily": (2, 2), "validate_delivery": (6, 3),
    }
    assert not store.read(BENCHMARK_LOG).where("task_name = 'update_dim_users' and status = 'failed'").isEmpty()


def test_quarantine(applied):
    store, _ = applied
    rows = store.read(QUARANTINE_EVENTS)
    assert rows.count() == 3
    assert {r["rejection_reason"] for r in rows.collect()} == {"empty_event_id", "empty_user_name"}


def test_staging_is_cleared(applied):
    store, _ = applied
    assert not any(store.exists(store._staging(b)) for b in (D1, D2, D3, LAST))


def test_sql_access(spark, applied):
    store, _ = applied
    for _ in range(2):
        store.register_tables("t_")
    expected = store.read(RPT_DAILY_SUMMARY).count()
    assert spark.table("t_gold.rpt_daily_summary").count() == expected
    plan = spark.sql("select count(*) from t_silver.fact_events where event_date = date'2024-01-01'")
    assert "PartitionFilters: [isnotnull(event_date" in plan._jdf.queryExecution().toString()


def check_past(spark, store, *batches):
    """Gold as of each of the deliveries, in the order they were applied, against what had come until then."""
    for n in range(1, len(batches) + 1):
        facts = silver.facts_from_raw(feed_of(spark, *batches[:n])).cache()
        hourly, daily = (serve.gold_as_of(store, spec, batches[n - 1]) for spec in (AGG_EVENTS_HOURLY, RPT_DAILY_SUMMARY))
        assert content(hourly, "_updated_at") == content(gold.hourly_kpis(facts))
        assert content(daily, "_updated_at") == content(gold.daily_kpis(facts))


def test_gold_as_of_each_delivery(spark, applied):
    """A day that a delivery leaves empty, days it fills first, and a delivery without events are among them."""
    store, _ = applied
    check_past(spark, store, D1, D2, D3, LAST)
    with pytest.raises(KeyError, match=NOON):
        serve.gold_as_of(store, RPT_DAILY_SUMMARY, NOON)


def test_gold_as_of_reads_only_first_changes(spark, applied):
    """LAST touches a day of its own, so the state before it needs nothing of the days of D1 and D2 but the tables."""
    store, _ = applied

    def history_of(batch_id):
        files = serve.gold_as_of(store, RPT_DAILY_SUMMARY, batch_id).inputFiles()
        return {f.split("_snapshot_batch=")[1].split("/")[0] for f in files if RPT_DAILY_SUMMARY_HISTORY.name in f}

    assert (history_of(D1), history_of(D2)) == ({D2}, set())


def test_late_delivery_rebuilds_the_past(spark, applied):
    """Last in this module, as it adds to the shared store."""
    store, _ = applied
    counts = batch_run.run_batch(store, feed_of(spark, NOON), NOON)
    assert counts["silver_rows"] == 2  # e2 was already corrected by a newer delivery
    check(spark, store, D1, NOON, D2, D3, LAST)
    buckets = store.read(DIM_USERS).withColumn("b", user_bucket(F.col("user_name"), 4))
    assert buckets.where("b <> user_bucket").isEmpty()
    check_past(spark, store, D1, D2, D3, LAST, NOON)


def test_closed_versions_are_only_added_to(spark, store):
    """Nothing that was closed before is written again by deliveries without corrections."""
    days = [f"batch_2024-01-0{n}" for n in range(1, 6)]
    rows = [(f"e{day}-{u}", f"user{u}", "view" if (n + u) % 2 else "click", "web", 1.0, f"2024-01-0{n} 10:00", day)
            for n, day in enumerate(days, 1) for u in range(8)]
    feed, kept = raw_rows(spark, *rows), {}
    for day in days:
        batch_run.run_batch(store, feed, day)
        live = store.partitions(DIM_USERS)
        closed = {part: versions for part, versions in live.items() if part[0] == 0}
        assert all(closed[part][: len(versions)] == versions for part, versions in kept.items())
        assert all(len(versions) == 1 for part, versions in live.items() if part[0] == 1)
        kept = closed
    assert sum(map(len, kept.values())) > len(kept)
    expected = content(users_of(silver.facts_from_raw(feed)))
    assert content(store.read(DIM_USERS).drop("value_exact", "value_rest", "user_bucket")) == expected
    assert store.draw_together(DIM_USERS, 2) == len(kept) and store.draw_together(DIM_USERS, 2) == 0
    assert content(store.read(DIM_USERS).drop("value_exact", "value_rest", "user_bucket")) == expected
    # A correction writes the closed versions of its users' buckets anew.
    again = raw_rows(spark, ("ebatch_2024-01-01-3", "user3", "view", "api", 2.0, "2024-01-01 10:00", "batch_2024-01-06"))
    batch_run.run_batch(store, again, "batch_2024-01-06")
    assert content(store.read(DIM_USERS).drop("value_exact", "value_rest", "user_bucket")) == content(users_of(silver.facts_from_raw(feed.union(again))))


def test_differing_rows_are_kept(spark, store, monkeypatch):
    batch_run.replay(store, feed_of(spark, D1, D2))
    # Equal days are not joined.
    with monkeypatch.context() as patched:
        patched.setattr(delivery, "mismatches", lambda *_: pytest.fail("joined"))
        serve.check_delivery(store, "well", [()])
    assert store.read(DELIVERY_DIFFERENCES).isEmpty()
    served = store.read(SERVING_HOURLY)
    wrong = served.withColumn("event_count", F.when(F.col("category") == "purchase", F.col("event_count") + 2).otherwise(F.col("event_count")))
    store.publish(SERVING_HOURLY, store.staged("wrong", "rows", wrong), [()])
    with pytest.raises(serve.DeliveryMismatch, match="2024-01-01 1 different rows"):
        serve.check_delivery(store, "ill", [()])
    (row,) = store.read(DELIVERY_DIFFERENCES).collect()
    assert (row["run_id"], row["table_id"], str(row["event_date"]), row["event_hour"], row["category"], row["source"]) == (
        "ill", "gold.agg_events_hourly", "2024-01-01", 10, "purchase", "web")
    assert (row["mismatch"], row["measure"], row["gold_value"], row["serving_value"]) == ("different", "event_count", 1.0, 3.0)


def test_catalog_is_registered_once(spark, store):
    for _ in range(2):
        batch_run.setup(store)
    tables, columns = store.read(TABLE_REGISTRY), store.read(COLUMN_REGISTRY)
    assert {r["table_id"] for r in tables.collect()} == {t.table_id for t in TABLES}
    assert tables.count() == len(TABLES)
    assert columns.count() == sum(len(t.columns) for t in TABLES)
    assert store.read(DATA_LINEAGE).count() == 7
    keys = columns.where("is_partition_key = 1 and table_id = 'silver.fact_events'")
    assert sorted(r["column_name"] for r in keys.collect()) == ["batch_id", "event_date"]


def test_unreadable_rows_are_set_aside_with_their_text(spark, store):
    """A bad time, a bad amount, no time at all, and a line its reader could not make out; the other rows go through."""
    rows = [
        ("e1", "ann", "view", "web", "1.5", "2024-01-01 10:00:00", D1, None), ("e2", "ann", "purchase", "web", "12x.5", "2024-01-01 10:00:00", D1, None),
        ("e3", "bob", "view", "web", " ", "2024-01-01 25:00:00", D1, None), ("e4", "bob", "view", "web", None, None, D1, None),
        ("", "bob", "view", "web", "?", "yesterday", D1, None), ("e5", "cid", None, None, "2", "2024-01-01 10:00:00", D1, "e5;cid;…"),
        ("e6", "cid", "view", "web", None, "2024-01-01 11:00:00", D1, ""),
    ]
    names = "event_id string, user_name string, category string, source string, value string, event_time string, batch_id string, _corrupt_record string"
    counts = batch_run.run_batch(store, spark.createDataFrame(rows, names).withColumn(
        "_corrupt_record", F.nullif(F.col("_corrupt_record"), F.lit(""))), D1)
    assert (counts["bronze_rows"], counts["quarantined_rows"], counts["silver_rows"]) == (7, 5, 2)
    aside = {r["event_id"]: (r["rejection_reason"], json.loads(r["_unreadable"] or "{}")) for r in store.read(QUARANTINE_EVENTS).collect()}
    assert aside == {
        "e2": ("unreadable_value", {"value": "12x.5"}), "e3": ("unreadable_event_time", {"event_time": "2024-01-01 25:00:00"}),
        "e4": ("empty_event_time", {}), "": ("empty_event_id,unreadable_event_time,unreadable_value", {"event_time": "yesterday", "value": "?"}),
        "e5": ("unreadable_record", {"record": "e5;cid;…"}),
    }
    assert {(r["event_id"], r["value"]) for r in store.read(FACT_EVENTS).collect()} == {("e1", 1.5), ("e6", 0.0)}


def test_a_delivery_with_other_content_is_refused(spark, store):
    rows = feed_of(spark, D1)
    bronze.ingest(store, rows, batch_run.now())
    bronze.ingest(store, rows.orderBy(F.rand(3)), batch_run.now())
    changes = {
        "one amount": rows.withColumn("value", F.when(F.col("event_id") == "e1", 1.25).otherwise(F.col("value"))),
        "two amounts swapped": rows.withColumn("value", F.expr("case event_id when 'e1' then 2.0 when 'e2' then 1.0 else value end")),
        "a blank for nothing": rows.withColumn("event_id", F.when(F.col("event_id") != "", F.col("event_id"))),
        "a row twice instead of another": rows.where("event_id <> 'e1'").union(rows.where("event_id = 'e2'")),
    }
    for what, changed in changes.items():
        with pytest.raises(bronze.ChangedDelivery, match=D1):
            bronze.ingest(store, changed, batch_run.now())
            pytest.fail(what)
    assert store.read(STG_EVENTS).count() == 5


def test_counts_cost_no_jobs_of_their_own(spark, store):
    """Rows set aside are counted while they are written: staging them and putting them in place are all there is to do."""
    bronze.ingest(store, feed_of(spark, D1), batch_run.now())
    tracker = spark.sparkContext.statusTracker()
    with store.transaction() as inner:
        run = batch_run.Run(inner, D1, batch_run.delivery_time)
        before = set(tracker.getJobIdsForGroup(None))
        batch_run._quarantine(run)
        during = len(set(tracker.getJobIdsForGroup(None)) - before)
        assert run.counts == {"bronze_rows": 5, "quarantined_rows": 1}
        # The same two writes without any counting.
        before = set(tracker.getJobIdsForGroup(None))
        staged = inner.staged(D1, "again", silver.rejected_rows(store.read(STG_EVENTS)))
        inner.publish(QUARANTINE_EVENTS, staged.withColumn("_unreadable", F.lit("")).withColumn("_quarantined_at", F.lit(run.at)), [(D1,)], [(D1,)])
        assert during == len(set(tracker.getJobIdsForGroup(None)) - before)


def test_a_delivery_looks_up_its_own_keys_only(spark, store, monkeypatch):
    """The index is read in the buckets of the delivery's keys, and the facts in the partitions it corrects; never whole."""
    batch_run.run_batch(store, feed_of(spark, D1), D1)
    read, asked = type(store).read, []

    def noted(self, spec, scopes=None):
        found = read(self, spec, scopes)
        if spec in (EVENT_KEYS, FACT_EVENTS):
            asked.append((spec, scopes, [f for f in found.inputFiles()]))
        return found

    monkeypatch.setattr(type(store), "read", noted)
    later = raw_rows(spark, ("e3", "eve", "view", "web", 1.0, "2024-01-01 10:00", D2))
    batch_run.run_batch(store, later, D2)
    monkeypatch.undo()
    (bucket,) = {r[0] for r in later.select(user_bucket(F.col("event_id"), 4)).collect()}
    for spec, scopes, files in asked:
        assert scopes is not None, spec.table_id
        if spec is EVENT_KEYS:
            assert files and all(f"key_bucket={bucket}/" in f for f in files)
    places = {r["event_id"]: r["batch_id"] for r in batch_run._current_places(
        batch_run.Run(store, D2, batch_run.delivery_time), store.read(EVENT_KEYS)).collect()}
    assert places == {"e1": D1, "e2": D1, "e3": D2, "e4": D1}


def test_index_is_drawn_together_and_made_anew(spark, store, monkeypatch):
    monkeypatch.setattr(batch_run, "KEY_VERSIONS", 2)
    names = [f"batch_2024-01-0{d}" for d in range(1, 6)]
    rows = raw_rows(spark, *[(f"e{i % 3}", "ann", "view", "web", float(i), "2024-01-01 10:00", n) for i, n in enumerate(names)])
    for name in names[:4]:
        batch_run.run_batch(store, rows, name)
    assert max(len(v) for v in store.partitions(EVENT_KEYS).values()) <= 2
    # A store without the index: it is made out of the facts.
    store.publish(EVENT_KEYS, store.read(EVENT_KEYS).limit(0), [()], [])
    batch_run.run_batch(store, rows, names[4])
    facts = {r["event_id"]: (r["batch_id"], r["event_date"]) for r in store.read(FACT_EVENTS).collect()}
    assert facts and {r["event_id"]: (r["batch_id"], r["event_date"]) for r in store.read(EVENT_KEYS).collect()} == facts
    assert {e: b for e, (b, _) in facts.items()} == {"e0": names[3], "e1": names[4], "e2": names[2]}


def test_delivery_by_hand(spark, store):
    """One hour and one day delivered again, and a check that sees a tampered row."""
    from datetime import date

    from lamina.plans import serve

    batch_run.run_batch(store, feed_of(spark, D1), D1)
    day = date(2024, 1, 1)
    summary = {(r["table_name"], r["scope"]): r["row_count"] for r in serve.summary(store, D1, "2024-01-01").collect()}
    assert summary["stg_events", "batch"] == 5 and summary["dim_users", "current"] == 3
    assert summary["agg_events_hourly", "date"] == 3 and summary["rpt_daily_summary_history", "total"] == 0

    good = content(store.read(SERVING_HOURLY), "updated_at")
    tampered = store.staged("tamper", "t", store.read(SERVING_HOURLY, [(day,)]).withColumn("event_count", F.lit(9).cast("long")))
    store.publish(SERVING_HOURLY, tampered, [(day,)])
    with pytest.raises(serve.DeliveryMismatch):
        serve.check_delivery(store, "by hand", [(day,)], 10)
    assert store.read(VALIDATION_LOG).where("run_id = 'by hand' and overall_status = 'fail'").count() == 1
    assert serve.serve_hour(store, day, 10) == 2
    serve.check_delivery(store, "by hand", [(day,)], 10)
    with pytest.raises(serve.DeliveryMismatch):
        serve.check_delivery(store, "by hand", [(day,)])
    assert serve.serve_hour(store, day, 11) == 1 and serve.serve_day(store, day) == 1
    assert content(store.read(SERVING_HOURLY), "updated_at") == good

    exported = content(store.read(EXPORT_HOURLY), "_updated_at")
    assert serve.export_hour(store, day, 10).endswith("event_date=2024-01-01/event_hour=10")
    assert serve.export_day(store, day).endswith("event_date=2024-01-01")
    assert content(store.read(EXPORT_HOURLY), "_updated_at") == exported


@pytest.mark.parametrize("broken", [FACT_EVENTS, AGG_EVENTS_HOURLY, SERVING_DAILY], ids=lambda spec: spec.table_id)
def test_a_failed_delivery_is_finished_before_a_later_one(spark, store, monkeypatch, broken):
    """D2 fails while publishing; a delivery that corrects the same events comes before D2 is run again."""
    batch_run.run_batch(store, feed_of(spark, D1), D1)
    publish = type(store).publish

    def breaks(self, spec, *arguments):
        if spec is broken:
            raise RuntimeError("executors lost")
        publish(self, spec, *arguments)

    monkeypatch.setattr(type(store), "publish", breaks)
    with pytest.raises(RuntimeError, match="executors lost"):
        batch_run.run_batch(store, feed_of(spark, D2), D2)
    monkeypatch.undo()
    assert batch_run.unfinished(store) == [D2]
    batch_run.run_batch(store, feed_of(spark, NOON), NOON)
    assert batch_run.unfinished(store) == [] and batch_run.run_batch(store, feed_of(spark, D2), D2) == {}
    check(spark, store, D1, NOON, D2)


@pytest.mark.parametrize("batch_id", [None, ""])
def test_rows_without_a_delivery_fail_before_anything_is_stored(spark, store, batch_id):
    rows = feed_of(spark, D1).withColumn("batch_id", F.when(F.col("event_id") == "e2", batch_id).otherwise(F.col("batch_id")))
    with pytest.raises(Exception, match="no batch_id in event e2"):
        batch_run.replay(store, rows)
    assert batch_run.replay(store, feed_of(spark, D1)) == [D1]
    check(spark, store, D1)


def test_a_delivery_that_grew_is_refused(spark, store):
    batch_run.replay(store, feed_of(spark, D1))
    grown = feed_of(spark, D1, D2).union(feed_of(spark, D1).where("event_id = 'e3'"))
    with pytest.raises(bronze.SplitDelivery, match=D1):
        batch_run.replay(store, grown)
    assert store.first_level(STG_EVENTS) == [D1]


def test_half_a_folder_is_written_again(spark, store):
    """A run is lost after some rows of D1 and all of D2 are in place, but before the ledger is written."""
    half = feed_of(spark, D1).limit(2).union(feed_of(spark, D2)).withColumn("_unreadable", F.lit(None).cast("string"))
    half = half.withColumn("_ingested_at", F.lit(None).cast("timestamp"))
    store.publish(STG_EVENTS, half, [()])
    assert bronze.stored_batches(store).isEmpty()
    assert batch_run.replay(store, feed_of(spark, D1, D2)) == [D1, D2]
    assert {r["batch_id"]: r["row_count"] for r in bronze.stored_batches(store).collect()} == {D1: 5, D2: 5}
    check(spark, store, D1, D2)


def test_a_delivery_stored_in_part_does_not_count(spark, store, monkeypatch):
    read = type(store).read
    monkeypatch.setattr(type(store), "read", lambda self, spec, *a: read(self, spec, *a).where(
        F.col("event_id") != "e2") if spec is STG_EVENTS else read(self, spec, *a))
    with pytest.raises(bronze.IncompleteDelivery, match=D1):
        bronze.ingest(store, feed_of(spark, D1), batch_run.now())
    assert bronze.stored_batches(store).isEmpty() and store.staged_batches() == []


def test_applied_deliveries_cost_no_jobs_of_their_own(spark, store, monkeypatch):
    def jobs_of_another_replay(*batches):
        batch_run.replay(store, feed_of(spark, *batches))
        with monkeypatch.context() as patched:
            patched.setattr(batch_run, "apply_batch", lambda *_: pytest.fail("applied again"))
            spark.sparkContext.setJobGroup(f"replay of {len(batches)}", "")
            assert batch_run.replay(store, feed_of(spark, *batches)) == list(batches)
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"replay of {len(batches)}"))

    assert jobs_of_another_replay(D1) == jobs_of_another_replay(D1, D2, LAST)


def test_the_time_of_a_delivery_decides_not_its_name(spark, store):
    """By name the second delivery would come first."""
    first, second = "scheduled__2024-01-05T11:00:00+00:00", "manual__2024-01-05T12:00:00+00:00"
    rows = raw_rows(
        spark, ("e1", "ann", "view", "web", 1.0, "2024-01-05 10:00", first), ("e1", "ann", "click", "api", 2.0, "2024-01-05 10:00", second),
        ("e2", "bob", "view", "web", 3.0, "2024-01-05 10:30", second), ("e2", "bob", "view", "web", 4.0, "2024-01-05 10:30", first),
    )
    assert batch_run.replay(store, rows.where(F.col("batch_id") == second)) == [second]
    assert batch_run.replay(store, rows) == [first, second]
    assert {(r["event_id"], r["value"], r["batch_id"]) for r in store.read(FACT_EVENTS).collect()} == {
        ("e1", 2.0, second), ("e2", 3.0, second),
    }
    later = raw_rows(spark, ("e1", "ann", "view", "web", 9.0, "2024-01-05 10:00", "backfill__2024-01-05T13:00:00+00:00"))
    batch_run.replay(store, later)
    assert {(r["event_id"], r["value"]) for r in store.read(FACT_EVENTS).collect()} == {("e1", 9.0), ("e2", 3.0)}
    assert store.read(RPT_DAILY_SUMMARY).first()["total_events"] == 2


def test_two_deliveries_within_an_hour(spark, store):
    early, late = "run__2024-01-05T11:00:00+00:00", "run__2024-01-05T11:30:00+00:00"
    rows = raw_rows(
        spark, ("e1", "ann", "view", "web", 1.0, "2024-01-05 10:00", early), ("e2", "ann", "click", "api", 2.0, "2024-01-05 11:10", late),
        ("e3", "ann", "click", "api", 2.0, "2024-01-05 11:20", late),
    )
    batch_run.replay(store, rows)
    versions = store.read(DIM_USERS).orderBy("valid_from").collect()
    assert [str(v["valid_from"]) for v in versions] == ["2024-01-05 11:00:00", "2024-01-05 11:30:00"]
    assert len({v["user_key"] for v in versions}) == 2


def test_only_states_of_written_partitions_are_made_anew(spark, store):
    for batch_id in (D1, D3):
        batch_run.run_batch(store, feed_of(spark, batch_id), batch_id)
    before, numbers = store.partitions(DAILY_STATES), content(store.read(USER_NUMBERS))
    batch_run.run_batch(store, feed_of(spark, LAST), LAST)
    after = store.partitions(DAILY_STATES)
    assert {p: v for p, v in after.items() if p in before} == before
    assert set(after) - set(before) == {("2024-01-04", LAST)}
    # A correction makes those anew that it takes events from; one that is left without events has none.
    batch_run.run_batch(store, feed_of(spark, D2), D2)
    corrected = store.partitions(DAILY_STATES)
    assert corrected[("2024-01-04", LAST)] == after[("2024-01-04", LAST)]
    assert corrected[("2024-01-01", D1)] != after[("2024-01-01", D1)]
    assert ("2023-12-31", D1) not in corrected
    assert set(corrected) == set(store.partitions(FACT_EVENTS))
    now = content(store.read(USER_NUMBERS))
    assert [row for row in now if row in numbers] == numbers
    numbered = store.read(USER_NUMBERS).select("user_no", "user_name").collect()
    assert len({n for n, _ in numbered}) == len({name for _, name in numbered}) == len(numbered)
    check(spark, store, D1, D3, LAST, D2)


def test_a_store_without_states_has_those_of_touched_days_made(spark, store):
    for batch_id in (D1, D2):
        batch_run.run_batch(store, feed_of(spark, batch_id), batch_id)
    with store.transaction() as inner:
        for spec in (DAILY_STATES, USER_NUMBERS):
            inner.publish(spec, inner.read(spec, []), [()], [])
    assert not store.partitions(DAILY_STATES)
    batch_run.run_batch(store, feed_of(spark, NOON), NOON)
    assert {p[0] for p in store.partitions(DAILY_STATES)} == {"2024-01-01"}
    assert store.partitions(DAILY_STATES).keys() == {p for p in store.partitions(FACT_EVENTS) if p[0] == "2024-01-01"}
    check(spark, store, D1, D2, NOON)
