"""One delivery through all layers.

Work per delivery follows the delivery, not the history: facts are added in their own
partitions and only partitions holding a corrected event are rewritten, figures
are recomputed for the touched days, versions are advanced for the touched users. What is
collected to the driver are names of partitions (days, deliveries, buckets) and counts.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime

import pyspark
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lamina.functions import user_bucket
from lamina.plans import bronze, catalog, delivery, gold, scd2, serve, silver
from lamina.schemas import (
    AGG_EVENTS_HOURLY, AGG_EVENTS_HOURLY_HISTORY, BENCHMARK_LOG, COLUMN_REGISTRY, DAILY_STATES, DATA_LINEAGE, DIM_USERS, EVENT_KEYS,
    EXPORT_DAILY, EXPORT_HOURLY, FACT_EVENTS, PIPELINE_RUNS, QUARANTINE_EVENTS, RPT_DAILY_SUMMARY,
    RPT_DAILY_SUMMARY_HISTORY, SERVING_DAILY, SERVING_HOURLY, SNAPSHOT_DAYS, STG_EVENTS, TABLE_REGISTRY, USER_ACTIVITY,
    USER_NUMBERS, TableSpec,
)
from lamina.session import now
from lamina.sources.event_feed import delivery_time
from lamina.sources.store import Store, arranged

# Versions of a bucket of keys before it is written as a whole.
KEY_VERSIONS = 8


def place(batch_time: Callable[[Column], Column], batch_id: Column) -> Column:
    """Deliveries are ordered by their logical time, those of the same time by their ids."""
    return F.struct(batch_time(batch_id).alias("at"), batch_id.alias("id"))


class RowsLost(RuntimeError):
    """Raw rows are neither facts nor set aside."""


@dataclass
class Run:
    store: Store
    batch_id: str
    batch_time: Callable[[Column], Column]
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    at: datetime = field(default_factory=now)
    counts: dict[str, int] = field(default_factory=dict)
    timings: list[dict] = field(default_factory=list)

    @contextmanager
    def step(self, name: str, layer: str):
        """Times a step; rows_in and rows_out may be put into the yielded record."""
        record = {"task_name": name, "layer": layer, "rows_in": 0, "rows_out": 0, "started_at": now()}
        start = time.monotonic()
        status = "failed"
        try:
            yield record
            status = "success"
        finally:
            seconds = time.monotonic() - start
            record.update(
                status=status, ended_at=now(), duration_ms=int(seconds * 1000),
                rows_per_second=record["rows_out"] / seconds if seconds > 0 else 0.0,
            )
            self.timings.append(record)

    def comes_after(self, batch_id: Column) -> Column:
        """Whether a delivery belongs behind the one of this run."""
        return place(self.batch_time, batch_id) > place(self.batch_time, F.lit(self.batch_id))

    def staged(self, step: str, df: DataFrame) -> DataFrame:
        return self.store.staged(self.batch_id, step, df)

    def counted(
        self, step: str, rows: DataFrame, counts: dict[str, Column], rest: Callable[[DataFrame], DataFrame] = lambda rows: rows
    ) -> tuple[DataFrame, dict[str, int]]:
        """`rest` of `rows` staged, and `counts` over `rows`, which are taken while it is written; only where an earlier
        attempt has written it they are counted anew."""
        asked = [count.alias(name) for name, count in counts.items()]
        if self.store.is_staged(self.batch_id, step):
            return self.staged(step, rest(rows)), rows.agg(*asked).first().asDict()
        seen = Observation()
        return self.staged(step, rest(rows.observe(seen, *asked))), seen.get

    def write_own(self, spec: TableSpec, step: str, rows: DataFrame, counts: dict[str, Column], rest=lambda rows: rows) -> dict[str, int]:
        """Make `rest` of `rows` the delivery's own partition of `spec`; `n` among the counts is the number of rows it has there."""
        staged, found = self.counted(step, rows, counts, rest)
        own = (self.batch_id,)
        self.store.publish(spec, staged, [own], [own] if found["n"] else [])
        return found


def setup(store: Store) -> None:
    """Record all tables, columns and data flows in the catalog; adds only what changed."""
    at = now()
    for spec, records in (
        (TABLE_REGISTRY, catalog.table_records), (COLUMN_REGISTRY, catalog.column_records),
        (DATA_LINEAGE, catalog.lineage_records),
    ):
        new = catalog.unregistered(records(store.spark, at), store.read(spec), spec)
        if not new.isEmpty():
            store.append(spec, new)


def is_applied(store: Store, batch_id: str) -> bool:
    runs = store.read(PIPELINE_RUNS, [(batch_id,)])
    return not runs.where("status = 'success'").isEmpty()


def unfinished(store: Store) -> list[str]:
    """Deliveries that began, staged something and did not succeed; at most one unless runs overlap."""
    begun = [b for b in store.staged_batches() if not store.read(PIPELINE_RUNS, [(b,)]).isEmpty()]
    return sorted(b for b in begun if not is_applied(store, b))


def run_batch(
    store: Store, feed: DataFrame, batch_id: str, batch_time: Callable[[Column], Column] = delivery_time
) -> dict[str, int]:
    """Store the delivery `batch_id` from `feed` and apply it."""
    bronze.ingest(store, feed.where(F.col("batch_id") == batch_id), now())
    return apply_batch(store, batch_id, batch_time)


def apply_batch(
    store: Store, batch_id: str, batch_time: Callable[[Column], Column] = delivery_time
) -> dict[str, int]:
    """Bring a stored delivery through silver, gold and serving. Applied deliveries are skipped.

    All tables change in one commit, together with the record of the run's success; a run that fails leaves only its
    log and its staging tables. A delivery that failed is finished first: what it has staged is right only for the tables as they were.
    """
    with store.writing():
        if is_applied(store, batch_id):
            return {}
        for other in unfinished(store):
            if other != batch_id:
                apply_batch(store, other, batch_time)
        run = Run(store, batch_id, batch_time)
        _log_run(run, "running")
        try:
            with store.transaction() as run.store:
                _transform(run)
                _log_run(run, "success")
                _log_timings(run)
        except Exception:
            run.store = store
            _log_run(run, "failed")
            _log_timings(run)
            raise
        store.clear_staging(batch_id)
    return run.counts


def _transform(run: Run) -> None:
    """All steps; those that don't need each other's results run side by side."""
    with ThreadPoolExecutor(4) as pool:
        def start(job: Callable, *arguments) -> Future:
            return pool.submit(inheritable_thread_target(run.store.spark)(job), *arguments)

        accounted = start(_quarantine, run)
        parts, users = _apply_facts(run, accounted, start)
        days = sorted({p[0] for p in parts})
        scopes = [(d,) for d in days]
        _note_days(run, days)
        for figures in [start(_refresh_hourly, run, scopes), start(_refresh_daily, run, scopes, parts)]:
            figures.result()
        with run.step("validate_delivery", "validation") as record:
            compared = serve.check_delivery(run.store, run.run_id, scopes)
            rows = run.counts["gold_hourly_rows"] + run.counts["gold_daily_rows"]
            record.update(rows_in=rows, rows_out=compared.count())
        users.result()


def _quarantine(run: Run) -> None:
    """Set rejected rows aside."""
    store, scope = run.store, [(run.batch_id,)]
    with run.step("quarantine_rows", "silver") as record:
        reason = F.col("rejection_reason")
        counts = {"bronze": F.count(F.lit(1)), "n": F.count_if(reason != "")}
        n = run.write_own(QUARANTINE_EVENTS, "rejected", silver.judged(store.read(STG_EVENTS, scope)), counts, lambda rows: rows.where(
            reason != "").withColumn("_quarantined_at", F.lit(run.at)))
        run.counts.update(bronze_rows=n["bronze"], quarantined_rows=n["n"])
        record.update(rows_in=n["bronze"], rows_out=n["n"])


def _apply_facts(run: Run, accounted: Future, start: Callable[..., Future]) -> tuple[list[tuple[date, str]], Future]:
    """Add the delivery's events and take out the versions they replace.

    Returns the written partitions and the update of the users, which runs on beside the writing of the facts. Nothing is
    published before the rows are accounted for.
    """
    store, batch_id = run.store, run.batch_id
    with run.step("transform_silver", "silver") as record:
        incoming, seen = run.counted(
            "incoming", silver.clean_events(store.read(STG_EVENTS, [(batch_id,)])), {"valid": F.count(F.lit(1))}, silver.current_facts
        )
        # Only the buckets of keys that the delivery holds are looked up.
        own_buckets = [(r[0],) for r in incoming.select(user_bucket(F.col("event_id"), store.user_buckets)).distinct().collect()]
        found = _current_places(run, _event_keys(store, own_buckets).join(incoming.select("event_id"), "event_id", "left_semi"))
        hits = run.staged("hits", found.withColumn("newer", run.comes_after(F.col("batch_id"))))
        hit_parts = hits.select("event_date", "batch_id", "newer").distinct().collect()
        older = [(r["event_date"], r["batch_id"]) for r in hit_parts if not r["newer"]]
        winners = incoming
        if len(older) < len(hit_parts):
            newer = hits.where("newer").select("event_id")
            winners = incoming.join(newer, "event_id", "left_anti").select(*incoming.columns)

        content = winners.withColumn("_loaded_at", F.lit(run.at)).select(*FACT_EVENTS.column_names)
        # All winners are of this delivery: its time is read from its id once and not for each row.
        activity = scd2.user_activity(winners, run.batch_time(F.lit(batch_id)))
        if older:
            corrected = hits.where("not newer").select("event_id")
            before = store.read(FACT_EVENTS, older)
            content = content.unionByName(before.join(corrected, "event_id", "left_anti"))
            taken = before.select(*silver.FACT_COLUMNS).join(corrected, "event_id", "left_semi")
            activity = activity.unionByName(scd2.user_activity(taken, run.batch_time(F.col("batch_id")), taken_away=True))
        activity = activity.withColumn("applied_batch", F.lit(batch_id)).withColumn(
            "user_bucket", user_bucket(F.col("user_name"), store.user_buckets)
        ).select(*USER_ACTIVITY.column_names)
        accounted.result()
        came, aside = run.counts["bronze_rows"], run.counts["quarantined_rows"]
        if came != seen["valid"] + aside:
            raise RowsLost(f"{batch_id}: {came} rows, {seen['valid']} valid, {aside} set aside")
        # Both name the files of the table as it was, so neither has to wait for the other.
        facts = start(_publish_facts, run, content, winners, older)
        users = start(_apply_users, run, activity, facts)
        own = facts.result()
        start(_note_keys, run, winners.select("event_id", "event_date", "batch_id"), own_buckets).result()
        record.update(rows_in=run.counts["bronze_rows"], rows_out=run.counts["silver_rows"])
    return [*own, *older], users


def _publish_facts(run: Run, content: DataFrame, winners: DataFrame, older: list[tuple[date, str]]) -> list[tuple[date, str]]:
    """Returns the delivery's own partitions."""
    own = [(r["event_date"], run.batch_id) for r in winners.select("event_date").distinct().collect()]
    run.store.publish(FACT_EVENTS, content, [*own, *older], [*own, *older])
    run.counts["silver_rows"] = run.store.read(FACT_EVENTS, own).count()
    return own


def _note_days(run: Run, days: list[date]) -> None:
    """Note which days the delivery changes, and its place among the applied ones."""
    position = len(run.store.first_level(SNAPSHOT_DAYS))
    rows = run.store.spark.createDataFrame([(d, position, run.batch_id) for d in (None, *days)], SNAPSHOT_DAYS.schema)
    run.store.publish(SNAPSHOT_DAYS, rows, [(run.batch_id,)], [(run.batch_id,)])


def _event_keys(store: Store, buckets: list[tuple]) -> DataFrame:
    """(event_id, event_date, batch_id) of the events in the buckets; a store without the index has it made out of its facts."""
    if store.partitions(EVENT_KEYS) or not store.partitions(FACT_EVENTS):
        return store.read(EVENT_KEYS, buckets).select("event_id", "event_date", "batch_id")
    return store.read(FACT_EVENTS).select("event_id", "event_date", "batch_id")


def _current_places(run: Run, keys: DataFrame) -> DataFrame:
    """The last entry of each event: that of the latest delivery."""
    last = F.max_by(F.struct("event_date", "batch_id"), place(run.batch_time, F.col("batch_id")))
    return keys.groupBy("event_id").agg(last.alias("at")).select("event_id", "at.event_date", "at.batch_id")


def _note_keys(run: Run, entries: DataFrame, buckets: list[tuple]) -> None:
    """Add the delivery's entries to their buckets; one with many versions is written as a whole, without what was overridden."""
    store = run.store

    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("key_bucket", user_bucket(F.col("event_id"), store.user_buckets))

    if not store.partitions(EVENT_KEYS) and len(store.partitions(FACT_EVENTS)) > 0:
        # The facts as they are now hold the delivery's events too.
        store.publish(EVENT_KEYS, run.staged("keys", bucketed(store.read(FACT_EVENTS).select("event_id", "event_date", "batch_id"))), [()])
        return
    versions = store.partitions(EVENT_KEYS)
    full = [b for b in buckets if len(versions.get(b, ())) >= KEY_VERSIONS]
    added = run.staged("keys", bucketed(entries))
    parts = [(r[0],) for r in added.select("key_bucket").distinct().collect()]
    few = [b for b in parts if b not in full]
    if few:
        store.append(EVENT_KEYS, added.where(F.col("key_bucket").isin([b for b, in few])), few)
    if full:
        both = store.read(EVENT_KEYS, full).unionByName(added.where(F.col("key_bucket").isin([b for b, in full])))
        whole = run.staged("whole_keys", bucketed(_current_places(run, both)))
        store.publish(EVENT_KEYS, whole, full, full)


def _apply_users(run: Run, activity: DataFrame, facts: Future) -> None:
    """Advance the versions of the delivery's users; rebuild those whose past was corrected.

    A delivery that is older than one already applied changes the past of all its users.
    """
    store, batch_id = run.store, run.batch_id
    with run.step("update_dim_users", "silver") as record:
        # Grouping has dealt the changes evenly over tasks, so they are written from there, all into one partition.
        store.append(USER_ACTIVITY, activity.sortWithinPartitions(*USER_ACTIVITY.sort_by), [(batch_id,)])
        activity = store.read(USER_ACTIVITY, [(batch_id,)])
        others = [(b,) for b in store.first_level(USER_ACTIVITY) if b != batch_id]
        late = not store.spark.createDataFrame(others, "id string").where(run.comes_after(F.col("id"))).isEmpty()
        buckets = {
            r["user_bucket"]: late or r["corrected"]
            for r in activity.groupBy("user_bucket").agg(F.max(F.col("n") < 0).alias("corrected")).collect()
        }
        rebuilt_buckets = [b for b, rebuilt in buckets.items() if rebuilt]
        # Closed versions are read, and written again, only where the past changes.
        scopes = [(1, b) for b in buckets] + [(0, b) for b in rebuilt_buckets]
        versions = store.read(DIM_USERS, scopes)
        profiled = activity.where("n > 0")
        if rebuilt_buckets:
            names = (activity if late else activity.where("n < 0")).select("user_name").distinct()
            versions = versions.join(names, "user_name", "left_anti")
            profiled = profiled.join(names, "user_name", "left_anti")
        profiles = scd2.user_profiles(profiled.select(*scd2.ACTIVITY_KEYS, "n", "value_exact", "revenue_n"))
        moved = scd2.advance_versions(versions.where("is_current = 1"), profiles)
        closed = versions.where("is_current = 0").withColumn("change", F.lit(None).cast("string"))
        result = moved.unionByName(closed.select(*moved.columns))
        if rebuilt_buckets:
            history = store.read(USER_ACTIVITY).where(F.col("user_bucket").isin(rebuilt_buckets))
            whole = scd2.user_versions(
                scd2.user_profiles(scd2.net_activity(history.join(names, "user_name", "left_semi")))
            )
            kind = F.when(F.col("version_no") == 1, "new").otherwise("changed")
            change = F.when(F.col("valid_from") == run.batch_time(F.lit(batch_id)), kind)
            result = result.unionByName(whole.withColumn("change", change).select(*moved.columns))
        result = result.withColumn("user_bucket", user_bucket(F.col("user_name"), store.user_buckets))
        staged = run.staged("users", result)
        groups = staged.groupBy("is_current", "user_bucket", "change").agg(F.count("*").alias("n")).collect()
        parts = {(r["is_current"], r["user_bucket"]) for r in groups}
        added = parts.difference(scopes)
        just_closed = (F.col("is_current") == 0) & ~F.col("user_bucket").isin(rebuilt_buckets)
        store.publish(DIM_USERS, staged.where(~just_closed), scopes, parts - added)
        if added:
            store.append(DIM_USERS, arranged(staged.where(just_closed), DIM_USERS, len(added)), added)
        new, changed = (sum(r["n"] for r in groups if r["change"] == kind) for kind in ("new", "changed"))
        run.counts.update(dim_users_new=new, dim_users_updated=changed)
        facts.result()
        record.update(rows_in=run.counts["silver_rows"], rows_out=new + changed)


def _refresh_hourly(run: Run, scopes: list[tuple]) -> None:
    _refresh(
        run, "hourly", lambda: gold.hourly_kpis(run.store.read(FACT_EVENTS, scopes)), AGG_EVENTS_HOURLY, AGG_EVENTS_HOURLY_HISTORY, EXPORT_HOURLY, SERVING_HOURLY,
        scopes, delivery.export_layout,
    )


def _refresh_daily(run: Run, scopes: list[tuple], parts: list[tuple[date, str]]) -> None:
    def figures() -> DataFrame:
        _update_states(run, scopes, parts)
        return gold.daily_from_states(run.store.read(DAILY_STATES, scopes))

    _refresh(
        run, "daily", figures, RPT_DAILY_SUMMARY, RPT_DAILY_SUMMARY_HISTORY, EXPORT_DAILY, SERVING_DAILY, scopes, lambda rows: rows,
    )


def _update_states(run: Run, scopes: list[tuple], parts: list[tuple[date, str]]) -> None:
    """Make the daily states of the written fact partitions anew; other deliveries' states of the days stay.

    In a store whose facts are older than the states, those of the touched days are made as well.
    """
    store = run.store
    days = {str(d) for d, in scopes}
    held = {p for p in store.partitions(FACT_EVENTS) if p[0] in days}
    known = set(store.partitions(DAILY_STATES))
    written = {(str(d), b) for d, b in parts}
    wanted = sorted((written & held) | (held - known))
    if not wanted:
        store.publish(DAILY_STATES, store.read(DAILY_STATES, []), written, [])
        return
    facts = store.read(FACT_EVENTS, wanted)
    names = facts.select("user_name").distinct()
    # Only the buckets of users in these partitions are looked up.
    buckets = [(r[0],) for r in names.select(user_bucket(F.col("user_name"), store.user_buckets)).distinct().collect()]
    numbers = store.read(USER_NUMBERS, buckets)
    fresh = run.staged("numbers", gold.new_user_numbers(names, numbers, store.user_buckets))
    added = [(r[0],) for r in fresh.select("user_bucket").distinct().collect()]
    if added:
        store.append(USER_NUMBERS, arranged(fresh, USER_NUMBERS, len(added)), added)
    states = run.staged("states", gold.daily_states(facts, numbers.unionByName(fresh)))
    store.publish(DAILY_STATES, states, written, wanted)


def _refresh(
    run: Run, label: str, kpis: Callable[[], DataFrame], table: TableSpec, history: TableSpec,
    export: TableSpec, serving: TableSpec, scopes: list[tuple], export_form: Callable[[DataFrame], DataFrame],
) -> None:
    """Snapshot, recompute, export and serve the figures of the touched days."""
    store = run.store
    with run.step(f"snapshot_{label}", "gold") as record:
        before = store.read(table, scopes).withColumn("_snapshot_ts", F.lit(run.at)).withColumn(
            "_snapshot_batch", F.lit(run.batch_id)
        )
        kept = run.write_own(history, f"snapshot_{label}", before, {"n": F.count(F.lit(1))})["n"]
        record.update(rows_in=kept, rows_out=kept)
    with run.step(f"aggregate_{label}", "gold") as record:
        fresh = kpis().withColumn("_updated_at", F.lit(run.at))
        staged = run.staged(label, fresh.select(*table.column_names))
        exported = export_form(staged)
        # The first measure of both tables counts events.
        per_folder = exported.groupBy(*export.partition_by).agg(
            F.count("*").alias("n"), F.sum(table.metrics[0]).alias("events")
        ).collect()
        sizes = {tuple(r[c] for c in export.partition_by): r["n"] for r in per_folder}
        days = {p[:1] for p in sizes}
        store.publish(table, staged, scopes, days)
        rows = run.counts[f"gold_{label}_rows"] = sum(sizes.values())
        record.update(rows_in=sum(r["events"] for r in per_folder), rows_out=rows)
    with run.step(f"export_{label}", "export") as record:
        store.publish(export, exported, scopes, sizes)
        record.update(rows_in=rows, rows_out=rows)
    with run.step(f"serve_{label}", "export") as record:
        # Whole days are delivered, so the merge by key comes down to putting the
        # day's rows in place; keys that gold no longer has go too.
        store.publish(serving, staged.withColumnRenamed("_updated_at", "updated_at"), scopes, days)
        record.update(rows_in=rows, rows_out=rows)


def _log_run(run: Run, status: str) -> None:
    """A failed run is logged with what it counted before it failed."""
    done = None if status == "running" else now()
    count_columns = [c for c, dtype, _ in PIPELINE_RUNS.columns if dtype.typeName() == "long"]
    record = {
        "run_id": run.run_id, "batch_id": run.batch_id, "status": status, "started_at": run.at, "completed_at": done,
        "_updated_at": done or run.at, **{c: run.counts.get(c, 0) for c in count_columns},
    }
    names = [c for c in PIPELINE_RUNS.column_names if c != "execution_date"]
    schema = PIPELINE_RUNS.schema
    rows = run.store.spark.createDataFrame(
        [tuple(record[c] for c in names)], type(schema)([schema[c] for c in names])
    )
    run.store.append(PIPELINE_RUNS, rows.withColumn("execution_date", run.batch_time(F.col("batch_id"))), [(run.batch_id,)])


def _log_timings(run: Run) -> None:
    """Measurements are an extra: failing to store them never fails the run."""
    shared = {
        "run_id": run.run_id, "framework": "spark", "framework_version": pyspark.__version__, "batch_id": run.batch_id,
        "extra": catalog.as_json(run.counts), "_recorded_at": now(),
    }
    try:
        schema = BENCHMARK_LOG.schema
        names = [c for c in BENCHMARK_LOG.column_names if c not in ("event_date", "event_hour")]
        rows = run.store.spark.createDataFrame(
            [tuple({**t, **shared}[c] for c in names) for t in run.timings], type(schema)([schema[c] for c in names])
        )
        at = run.batch_time(F.col("batch_id"))
        run.store.append(BENCHMARK_LOG, rows.withColumn("event_date", F.to_date(at)).withColumn("event_hour", F.hour(at)))
    except Exception as error:  # noqa: BLE001
        print(f"step times of {run.batch_id} not stored: {error}")


def replay(store: Store, feed: DataFrame, batch_time: Callable[[Column], Column] = delivery_time) -> list[str]:
    """Store all new deliveries of `feed` in one pass, then apply what is not applied yet in order."""
    with store.writing():
        return _replayed(store, feed, batch_time)


def _replayed(store: Store, feed: DataFrame, batch_time: Callable[[Column], Column]) -> list[str]:
    bronze.ingest(store, feed, now())
    # One look at the logs for all of them; those applied before cost nothing further.
    done = store.read(PIPELINE_RUNS).where("status = 'success'").select("batch_id", F.lit(True).alias("applied")).distinct()
    stored = bronze.stored_batches(store).join(done, "batch_id", "left").select("batch_id", "applied")
    batches = stored.orderBy(place(batch_time, F.col("batch_id"))).collect()
    for batch_id, applied in batches:
        if not applied:
            apply_batch(store, batch_id, batch_time)
    return [batch_id for batch_id, _ in batches]
