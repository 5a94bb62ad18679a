"""All tables of a delivery change in one step, by one writer."""

import json
import time
from datetime import date, datetime

import pytest

from lamina.plans import batch_run
from lamina.schemas import (
    AGG_EVENTS_HOURLY, DIM_USERS, EXPORT_DAILY, EXPORT_HOURLY, FACT_EVENTS, RPT_DAILY_SUMMARY, SERVING_DAILY, SERVING_HOURLY, TABLES,
)
from lamina.sources import manifest
from lamina.sources.manifest import ConcurrentWrite, Files, Lease, LeaseHeld, LeaseLost
from lamina.sources.store import Store
from tests.helpers import content, raw_rows

AT = datetime(2024, 1, 1)
READ = (FACT_EVENTS, DIM_USERS, AGG_EVENTS_HOURLY, RPT_DAILY_SUMMARY, SERVING_HOURLY, SERVING_DAILY, EXPORT_HOURLY, EXPORT_DAILY)
FIRST, SECOND = "batch_2024-01-01", "batch_2024-01-02"
ROWS = [
    ("e1", "ann", "view", "web", 1.0, "2024-01-01 10:00", FIRST), ("e2", "bob", "purchase", "web", 2.0, "2024-01-01 11:00", FIRST),
    ("e2", "bob", "purchase", "app", 3.0, "2024-01-02 11:00", SECOND), ("e3", "ann", "click", "app", 0.0, "2024-01-02 12:00", SECOND),
]


def daily(spark, *days):
    return spark.createDataFrame([(date(2024, 1, d), n, 1, 0, 0.0, 0.0, AT) for d, n in days], RPT_DAILY_SUMMARY.schema)


def numbers(store):
    return {r["event_date"].day: r["total_events"] for r in store.read(RPT_DAILY_SUMMARY).collect()}


class Lost(RuntimeError):
    pass


def test_a_delivery_stopped_at_any_step_is_not_seen(spark, store, monkeypatch):
    """Every write and the commit fail in turn; all tables stay as they were, and the delivery goes through afterwards."""
    rows = raw_rows(spark, *ROWS)
    batch_run.run_batch(store, rows, FIRST)
    before = {spec.table_id: content(store.read(spec)) for spec in READ}
    steps = []

    def stops(method, at):
        real = getattr(Store, method)

        def step(self, *arguments):
            steps.append(method)
            if len(steps) == at:
                raise Lost(f"at {method} {at}")
            return real(self, *arguments)

        return step

    at, failures = 3, 0  # the first two writes store the raw rows
    while True:
        steps.clear()
        with monkeypatch.context() as patched:
            patched.setattr(Store, "_publish", stops("_publish", at))
            try:
                batch_run.run_batch(Store(spark, store.root), rows, SECOND)
                break
            except Lost:
                failures += 1
        assert {spec.table_id: content(store.read(spec)) for spec in READ} == before
        # Later steps are enough to see that nothing comes through; the first ones are all alike.
        at += 3
    assert failures >= 3
    assert {spec.table_id: content(store.read(spec)) for spec in READ} != before
    assert {r["event_id"]: r["value"] for r in store.read(FACT_EVENTS).collect()} == {"e1": 1.0, "e2": 3.0, "e3": 0.0}


def test_a_lost_rename_leaves_the_old_state(spark, store, monkeypatch):
    store.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1), (2, 2)), [()])
    for method in ("write", "move"):
        with monkeypatch.context() as patched, pytest.raises(Lost):
            def lost(self, path, *_, **__):
                raise Lost(path)

            with store.transaction() as inner:
                inner.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 7)), [()])
                assert numbers(inner) == {1: 7} and numbers(store) == {1: 1, 2: 2}
                patched.setattr(Files, method, lost)
        assert numbers(store) == {1: 1, 2: 2}
    store.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 7)), [()])
    assert numbers(store) == {1: 7}


def test_readers_keep_their_snapshot(spark, store):
    store.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1)), [()])
    pinned, held = store.snapshot(), store.read(RPT_DAILY_SUMMARY)
    for n in range(2, manifest.KEPT + 1):
        store.publish(RPT_DAILY_SUMMARY, daily(spark, (1, n)), [()])
        assert numbers(pinned) == {1: 1} and held.first()["total_events"] == 1 and numbers(store) == {1: n}
    for n in range(10, 10 + 2 * manifest.CHANGES):
        store.publish(RPT_DAILY_SUMMARY, daily(spark, (n % 3 + 1, n)), [(date(2024, 1, n % 3 + 1),)])
    # Lists are drawn together, and what no kept commit shows is deleted.
    assert len(numbers(store)) == 3
    files = store._files
    assert len(files.names(f"{store.root}/_manifest/heads")) == manifest.KEPT
    folders = [f for d in (1, 2, 3) for f in files.names(store.scope_path(RPT_DAILY_SUMMARY, (date(2024, 1, d),)))]
    assert len(folders) <= 3 + manifest.KEPT
    assert len(store._manifest.head().tables[RPT_DAILY_SUMMARY.table_id]) <= manifest.CHANGES + 1


def test_writers_of_the_same_partition_conflict(spark, store):
    other = Store(spark, store.root)
    other._lease = store._lease  # as if the lease did not help
    store.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1), (2, 1)), [()])
    with pytest.raises(ConcurrentWrite):
        with store.transaction() as inner:
            inner.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 2)), [(date(2024, 1, 1),)])
            other.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 3)), [(date(2024, 1, 1),)])
    assert numbers(store) == {1: 3, 2: 1}
    with store.transaction() as inner:
        inner.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 4)), [(date(2024, 1, 1),)])
        other.publish(RPT_DAILY_SUMMARY, daily(spark, (2, 5)), [(date(2024, 1, 2),)])
    assert numbers(store) == {1: 4, 2: 5}


def test_a_second_writer_is_refused_and_a_dead_one_replaced(spark, store):
    first, second = Store(spark, store.root, lease_seconds=60), Store(spark, store.root, lease_seconds=60)
    with first.writing():
        with first.writing():
            pass
        with pytest.raises(LeaseHeld):
            second.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1)), [()])
        first.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1)), [()])
    second.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 2)), [()])
    # A writer that was gone for long: its successor commits, it can't any more.
    with pytest.raises(LeaseLost):
        with first.transaction() as inner:
            inner.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 3)), [(date(2024, 1, 1),)])
            dead = json.dumps({"owner": first._lease.owner, "beat": time.time() - 61})
            first._files.write(first._lease.path, dead, replace=True)
            second.publish(RPT_DAILY_SUMMARY, daily(spark, (2, 4)), [(date(2024, 1, 2),)])
    assert numbers(store) == {1: 2, 2: 4}


def test_a_living_writer_shows_it(spark, store):
    lease = Lease(store._files, f"{store.root}/_beating", seconds=1.0)
    with lease:
        time.sleep(1.5)
        with pytest.raises(LeaseHeld):
            with Lease(store._files, lease.path, seconds=1.0):
                pass
    assert not store._files.exists(lease.path)


def test_log_of_a_failed_check_stays(spark, store):
    """What is logged outside the transaction is there although the transaction is not."""
    from lamina.schemas import BATCH_LEDGER

    ledger = spark.createDataFrame([("b", 1, None, None, AT)], BATCH_LEDGER.schema)
    with pytest.raises(Lost):
        with store.transaction() as inner:
            inner.publish(RPT_DAILY_SUMMARY, daily(spark, (1, 1)), [()])
            inner.settled.append(BATCH_LEDGER, ledger)
            inner.append(BATCH_LEDGER, ledger)
            raise Lost
    assert store.read(BATCH_LEDGER).count() == 1 and store.read(RPT_DAILY_SUMMARY).isEmpty()
    assert all(store.read(t).columns == t.column_names for t in TABLES)
