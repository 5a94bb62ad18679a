"""Delivery on stored tables: export, merge into serving, check, summary.

`apply_batch` delivers the days a delivery touched. The functions for one hour or one day
are for delivering again by hand.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.plans import delivery, gold, quality
from lamina.schemas import (
    AGG_EVENTS_HOURLY, AGG_EVENTS_HOURLY_HISTORY, DIM_USERS, EXPORT_DAILY, EXPORT_HOURLY, FACT_EVENTS,
    DAILY_KEYS, DAILY_MEASURES, DELIVERY_DIFFERENCES, HOURLY_KEYS, HOURLY_MEASURES, QUARANTINE_EVENTS, RPT_DAILY_SUMMARY,
    RPT_DAILY_SUMMARY_HISTORY, SERVING_DAILY, SERVING_HOURLY, SNAPSHOT_DAYS, STG_EVENTS, VALIDATION_LOG, TableSpec,
)
from lamina.session import now
from lamina.sources.store import Store, arranged


class DeliveryMismatch(RuntimeError):
    """The serving tables differ from gold."""


def _gold_hour(store: Store, day: date, hour: int) -> DataFrame:
    return store.read(AGG_EVENTS_HOURLY, [(day,)]).where(F.col("event_hour") == hour)


def export_hour(store: Store, day: date, hour: int) -> str:
    """Write the hour's figures as Parquet in place of what was exported for it; returns the folder."""
    rows = delivery.export_layout(_gold_hour(store, day, hour))
    store.publish(EXPORT_HOURLY, rows, [(day, f"{hour:02d}")])
    return store.scope_path(EXPORT_HOURLY, (day, f"{hour:02d}"))


def export_day(store: Store, day: date) -> str:
    store.publish(EXPORT_DAILY, store.read(RPT_DAILY_SUMMARY, [(day,)]), [(day,)])
    return store.scope_path(EXPORT_DAILY, (day,))


def serve_hour(store: Store, day: date, hour: int) -> int:
    """Merge the hour's figures into the serving table; returns how many rows were merged."""
    return _merge(store, SERVING_HOURLY, day, _gold_hour(store, day, hour), delivery.upsert_hourly)


def serve_day(store: Store, day: date) -> int:
    return _merge(store, SERVING_DAILY, day, store.read(RPT_DAILY_SUMMARY, [(day,)]), delivery.upsert_daily)


def _merge(store: Store, spec: TableSpec, day: date, rows: DataFrame, upsert) -> int:
    rows = rows.drop("_updated_at").withColumn("updated_at", F.lit(now())).select(*spec.column_names)
    attempt = f"serve-{uuid.uuid4().hex}"
    store.publish(spec, store.staged(attempt, "merged", upsert(store.read(spec, [(day,)]), rows)), [(day,)])
    store.clear_staging(attempt)
    return rows.count()


def check_delivery(store: Store, run_id: str, days: list[tuple], hour: int | None = None) -> DataFrame:
    """Compare gold and serving for whole days or one hour of them; log the comparison, then fail on a difference.

    Besides the totals of each hour every single row is compared, by digests of days first. What differs is
    kept in `catalog.delivery_differences`.
    """
    def rows(spec: TableSpec, scopes: list[tuple] = days) -> DataFrame:
        found = store.read(spec, scopes)
        return found if hour is None or "event_hour" not in found.columns else found.where(F.col("event_hour") == hour)

    hourly, daily, served_hourly, served_daily = map(
        rows, (AGG_EVENTS_HOURLY, RPT_DAILY_SUMMARY, SERVING_HOURLY, SERVING_DAILY)
    )
    report = delivery.validate(hourly, daily, served_hourly, served_daily)
    # One row per hour of the compared days.
    found = report.withColumn("run_id", F.lit(run_id)).withColumn("validated_at", F.lit(now())).select(
        *VALIDATION_LOG.column_names
    ).collect()
    log = store.spark.createDataFrame(found, VALIDATION_LOG.schema)
    # Stays in the log even where the difference found stops a commit.
    store.settled.append(VALIDATION_LOG, log)
    problems = [f"{r['event_date']} {r['event_hour']:02d}h totals" for r in found if r["overall_status"] == "fail"]
    for spec, served, keys, measures in (
        (AGG_EVENTS_HOURLY, SERVING_HOURLY, HOURLY_KEYS, HOURLY_MEASURES), (RPT_DAILY_SUMMARY, SERVING_DAILY, DAILY_KEYS, DAILY_MEASURES),
    ):
        # Names of partitions, none where all is well.
        apart = delivery.differing_parts(rows(spec), rows(served), [*keys, *measures], ["event_date"])
        scopes = sorted(tuple(r) for r in apart.collect())
        if scopes:
            found = delivery.differences_below(rows(spec, scopes), rows(served, scopes), keys, measures)
            problems += _kept(store, run_id, spec, found, measures)
    if problems:
        raise DeliveryMismatch(f"{run_id}: " + "; ".join(problems))
    return log


def _kept(store: Store, run_id: str, spec: TableSpec, found: DataFrame, measures: tuple[str, ...]) -> list[str]:
    """Store the differing rows, measure by measure; returns how many of each kind there are by day."""
    attempt = f"check-{uuid.uuid4().hex}"
    staged = store.staged(attempt, "differing", found)
    # At most three kinds a day; every differing row is counted.
    counted = staged.groupBy("event_date", "mismatch").agg(F.count("*").alias("n")).orderBy("event_date", "mismatch").collect()
    absent = {c: dtype for c, dtype, _ in DELIVERY_DIFFERENCES.columns[3:6] if c not in found.columns}
    kept = delivery.by_measure(staged, measures).select(
        "*", *[F.lit(None).cast(dtype).alias(c) for c, dtype in absent.items()],
        F.lit(run_id).alias("run_id"), F.lit(spec.table_id).alias("table_id"), F.lit(now()).alias("validated_at"),
    )
    if counted:
        days = sorted({(r["event_date"],) for r in counted})
        store.settled.append(DELIVERY_DIFFERENCES, arranged(kept, DELIVERY_DIFFERENCES), days)
    store.clear_staging(attempt)
    return [f"{r['event_date']} {r['n']} {r['mismatch']} rows" for r in counted]


def gold_as_of(store: Store, table: TableSpec, batch_id: str) -> DataFrame:
    """The hourly or daily figures as they stood once the delivery `batch_id` had been applied.

    Of the history only the partitions of those later deliveries are read that were the first to change a day.
    """
    history = {AGG_EVENTS_HOURLY: AGG_EVENTS_HOURLY_HISTORY, RPT_DAILY_SUMMARY: RPT_DAILY_SUMMARY_HISTORY}[table]
    pinned = store.snapshot()
    own = pinned.read(SNAPSHOT_DAYS, [(batch_id,)]).select("position").first()
    if own is None:
        raise KeyError(f"{batch_id} has not been applied, or before changed days were noted")
    later = pinned.read(SNAPSHOT_DAYS).where(F.col("position") > own["position"])
    # Names of deliveries, at most one a day.
    first = [tuple(r) for r in gold.first_changes(later).select("_snapshot_batch").distinct().collect()]
    return gold.as_of(pinned.read(table), pinned.read(history, first), later)


def summary(store: Store, batch_id: str, event_date: str) -> DataFrame:
    """Row counts of all layers in one job."""
    tables = (
        STG_EVENTS, FACT_EVENTS, QUARANTINE_EVENTS, DIM_USERS, AGG_EVENTS_HOURLY, RPT_DAILY_SUMMARY,
        AGG_EVENTS_HOURLY_HISTORY, RPT_DAILY_SUMMARY_HISTORY,
    )
    return quality.layer_summary({t.table_id: store.read(t) for t in tables}, batch_id, event_date)
