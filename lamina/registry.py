"""The registered queries: every job over the whole events table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import column_profile
from lamina.plans import batch_run, bronze, catalog, delivery, gold, quality, scd2, serve, silver
from lamina.schemas import (
    AGG_EVENTS_HOURLY, DELIVERY_DIFFERENCES, DIM_USERS, EXPORT_DAILY, EXPORT_HOURLY, RPT_DAILY_SUMMARY, SERVING_DAILY, SERVING_HOURLY, STG_EVENTS, TableSpec,
    USER_NUMBERS,
)
from lamina.session import fresh_folder, written
from lamina.sources import event_feed
from lamina.sources.store import Store
from lamina.streaming import feed

# The delivery, day and days the scoped queries are about.
BATCH, BATCH_DAY, SUMMARY_DATE = "batch_2024-01-20 11", "batch_2024-01-20", "2024-01-20"
UPSERT_FROM, UPSERT_TO = "2024-01-15", "2024-01-25"
# Time stamp of the records that are not compared by time.
_REGISTERED_AT = datetime(2024, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return event_feed.deliveries(event_feed.events(spark, folder))


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return silver.facts_from_raw(raw(spark, folder))


def versions(facts_df: DataFrame, carry_totals: bool = True) -> DataFrame:
    """User dimension by daily deliveries."""
    by_day = facts_df.withColumn("batch_id", F.substring("batch_id", 1, len(BATCH_DAY)))
    activity = scd2.user_activity(by_day, event_feed.delivery_time(F.col("batch_id")))
    return scd2.user_versions(scd2.user_profiles(activity), carry_totals)


def users(spark: SparkSession, folder: str, carry_totals: bool = True) -> DataFrame:
    return versions(facts(spark, folder), carry_totals).select(*scd2.DIM_COLUMNS)


def ingest_new_batches_only(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw(spark, folder)
    known = rows.select("batch_id").where(F.substring("batch_id", 1, len(BATCH_DAY)) <= BATCH_DAY).distinct()
    return bronze.new_rows(rows, known)


def quarantine_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    rejected = silver.rejected_rows(raw(spark, folder))
    return rejected.groupBy("rejection_reason").agg(F.count("*").alias("row_count"))


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """Daily states of every delivery. Users get their numbers in two goes, those up to a day first."""
    rows, buckets = written(facts(spark, folder), "facts"), 16
    early = rows.where(F.substring("batch_id", 1, len(BATCH_DAY)) <= BATCH_DAY)
    first = written(gold.new_user_numbers(early, spark.createDataFrame([], USER_NUMBERS.schema), buckets), "numbers")
    numbers = written(first.unionByName(gold.new_user_numbers(rows, first, buckets)), "numbers")
    return written(gold.daily_states(rows, numbers), "states")


def gold_weekly_from_states(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of weeks, each user counted once, from the daily states of all deliveries."""
    return gold.daily_from_states(_states(spark, folder), F.to_date(F.date_trunc("week", "event_date"))).withColumnRenamed(
        "event_date", "week_start")


def gold_before(spark: SparkSession, folder: str) -> DataFrame:
    """Facts as they stood before the delivery."""
    return silver.facts_from_raw(raw(spark, folder).where(F.col("batch_id") < BATCH))


def touched_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the delivery's rows; it is the newest delivery at that point, so all of them are current."""
    return own_rows(spark, folder).select("event_date").distinct()


def own_rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver.clean_events(raw(spark, folder).where(F.col("batch_id") == BATCH))


def gold_hourly_for_batch(spark: SparkSession, folder: str) -> DataFrame:
    return gold.hourly_kpis_for_batch(facts(spark, folder), BATCH, own_rows(spark, folder))


def gold_daily_for_batch(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_kpis_for_batch(facts(spark, folder), BATCH, own_rows(spark, folder))


def snapshot_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return gold.snapshot(gold.hourly_kpis(gold_before(spark, folder)), touched_dates(spark, folder), BATCH)


def snapshot_daily(spark: SparkSession, folder: str) -> DataFrame:
    return gold.snapshot(gold.daily_kpis(gold_before(spark, folder)), touched_dates(spark, folder), BATCH)


def served_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts the serving tables were last filled from."""
    seen = raw(spark, folder).where(F.substring("batch_id", 1, len(BATCH_DAY)) <= BATCH_DAY)
    return silver.facts_from_raw(seen)


def _upsert_window(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_date").between(F.to_date(F.lit(UPSERT_FROM)), F.to_date(F.lit(UPSERT_TO))))


def serving_upsert_hourly(spark: SparkSession, folder: str) -> DataFrame:
    new = gold.hourly_kpis(_upsert_window(facts(spark, folder)))
    return delivery.upsert_hourly(gold.hourly_kpis(served_facts(spark, folder)), new)


def serving_upsert_daily(spark: SparkSession, folder: str) -> DataFrame:
    new = gold.daily_kpis(_upsert_window(facts(spark, folder)))
    return delivery.upsert_daily(gold.daily_kpis(served_facts(spark, folder)), new)


def delivery_validation(spark: SparkSession, folder: str) -> DataFrame:
    now, served = written(facts(spark, folder), "facts"), written(served_facts(spark, folder), "facts")
    return delivery.validate(
        gold.hourly_kpis(now), gold.daily_kpis(now), gold.hourly_kpis(served), gold.daily_kpis(served)
    )


def delivery_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return delivery.mismatches(
        gold.hourly_kpis(facts(spark, folder)), gold.hourly_kpis(served_facts(spark, folder))
    )


def delivery_mismatches_daily(spark: SparkSession, folder: str) -> DataFrame:
    return delivery.daily_mismatches(
        gold.daily_kpis(facts(spark, folder)), gold.daily_kpis(served_facts(spark, folder))
    )


def delivery_differences(spark: SparkSession, folder: str) -> DataFrame:
    """What is kept of a comparison that fails: stored gold against serving tables that were filled before the latest deliveries."""
    store = Store(spark, fresh_folder(spark, "differences"))
    now, served = written(facts(spark, folder), "facts"), written(served_facts(spark, folder), "facts")
    with store.transaction() as inner:
        for spec, kpis, rows in (
            (AGG_EVENTS_HOURLY, gold.hourly_kpis, now), (RPT_DAILY_SUMMARY, gold.daily_kpis, now),
            (SERVING_HOURLY, gold.hourly_kpis, served), (SERVING_DAILY, gold.daily_kpis, served),
        ):
            inner.publish(spec, kpis(rows).withColumn(spec.version, F.lit(_REGISTERED_AT)), [()])
    try:
        serve.check_delivery(store, "run", [()])
    except serve.DeliveryMismatch:
        pass
    return store.read(DELIVERY_DIFFERENCES).drop("run_id", "validated_at")


def layer_sources(spark: SparkSession, folder: str) -> list[tuple[DataFrame, dict[str, Column]]]:
    """The layers as (rows, tables that are parts of them). The facts feed four tables and are written once."""
    now, whole = written(facts(spark, folder), "facts"), F.lit(True)
    return [
        (silver.judged(raw(spark, folder)), {
            "bronze.stg_events": whole, "silver.quarantine_events": F.expr("rejection_reason <> ''"),
        }),
        (now, {"silver.fact_events": whole}),
        (versions(now).select(*scd2.DIM_COLUMNS), {"silver.dim_users": whole}),
        (gold.hourly_kpis(now), {"gold.agg_events_hourly": whole}),
        (gold.daily_kpis(now), {"gold.rpt_daily_summary": whole}),
    ]


def snapshots(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    before, days = written(gold_before(spark, folder), "before"), written(touched_dates(spark, folder), "days")
    return {
        "gold.agg_events_hourly_history": gold.snapshot(gold.hourly_kpis(before), days, BATCH),
        "gold.rpt_daily_summary_history": gold.snapshot(gold.daily_kpis(before), days, BATCH),
    }


def measured(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of the layers, one row a table, written so that they are not counted for each use."""
    sources = layer_sources(spark, folder) + [(df, {t: F.lit(True)}) for t, df in snapshots(spark, folder).items()]
    return written(catalog.table_sizes(sources), "sizes")


def layer_summary(spark: SparkSession, folder: str) -> DataFrame:
    parts = {t: df.where(c) for df, tables in layer_sources(spark, folder) for t, c in tables.items()}
    return quality.layer_summary(parts | snapshots(spark, folder), BATCH, SUMMARY_DATE)


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All registered tables, with their rows where the events alone fill them."""
    records = catalog.table_records(spark, _REGISTERED_AT).withColumn("tags", F.concat_ws(",", "tags"))
    return records.join(measured(spark, folder), "table_id", "left").select(
        "table_id", "layer", "table_name", "engine", "partition_key", "order_key", "tags", "row_count"
    )


def catalog_columns(spark: SparkSession, folder: str) -> DataFrame:
    """All registered columns, with rows and missing values where the events alone fill the table."""
    sizes = catalog.column_sizes(layer_sources(spark, folder))
    return catalog.column_records(spark, _REGISTERED_AT).join(sizes, ["table_id", "column_name"], "left").select(
        "table_id", "column_name", "data_type", "is_nullable", "is_partition_key", "is_order_key", "row_count", "missing_count"
    )


def lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Registered data flows with the rows on both ends."""
    return _with_rows(
        catalog.lineage_records(spark, _REGISTERED_AT).select("source_table_id", "target_table_id", "transformation"),
        measured(spark, folder), {"source_table_id": "source_rows", "target_table_id": "target_rows"},
    )


def lineage_closure(spark: SparkSession, folder: str) -> DataFrame:
    """What is computed from what, over any number of steps, with the rows on both ends."""
    return _with_rows(
        catalog.lineage_closure(spark, catalog.lineage_records(spark, _REGISTERED_AT)),
        measured(spark, folder), {"ancestor": "ancestor_rows", "descendant": "descendant_rows"},
    )


def _with_rows(edges: DataFrame, sizes: DataFrame, names: dict[str, str]) -> DataFrame:
    for key, rows in names.items():
        edges = edges.join(sizes.select(F.col("table_id").alias(key), F.col("row_count").alias(rows)), key)
    return edges


def run_log_current(spark: SparkSession, folder: str) -> DataFrame:
    """State of every run: a start record per delivery and, for six in seven, an end record with counts."""
    accounted = quality.row_accounting(raw(spark, folder)).withColumn(
        "batch_ts", event_feed.delivery_time(F.col("batch_id"))
    )
    unfinished = (F.dayofmonth("batch_ts") * 24 + F.hour("batch_ts")) % 7 == 0
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.lit("running").alias("status"), zero.alias("bronze_rows"), zero.alias("silver_rows"),
        F.col("batch_ts").alias("_updated_at"),
    )
    end = F.struct(
        F.lit("success").alias("status"), F.col("bronze_rows"), F.col("valid_rows").alias("silver_rows"),
        (F.col("batch_ts") + F.make_dt_interval(mins=F.lit(5))).alias("_updated_at"),
    )
    records = accounted.select(
        F.concat(F.lit("run_"), "batch_id").alias("run_id"), "batch_id",
        F.inline(F.when(unfinished, F.array(start)).otherwise(F.array(start, end))),
    )
    return catalog.current_runs(records).drop("_updated_at")


def benchmark_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Step times by framework, with the events read as measurements."""
    number, ms = F.col("event_id"), (F.col("value") * 10).cast("long")
    log = event_feed.table(spark, folder, "events").select(
        F.when(number % 3 == 0, "alpha").when(number % 3 == 1, "beta").otherwise("gamma").alias("framework"),
        F.col("event_type").alias("task_name"),
        ms.alias("duration_ms"),
        F.when(ms == 0, 0.0).otherwise(F.col("user_id") / (ms / 1000.0)).alias("rows_per_second"),
        F.when(number % 10 == 0, "failed").otherwise("success").alias("status"),
    )
    return catalog.compare_tasks(log).withColumn("avg_throughput", F.round("avg_throughput", 4))


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """All deliveries, with the time as text, stored and read back."""
    store = Store(spark, fresh_folder(spark, "ingest"))
    as_text = F.date_format("event_time", bronze.TIME_FORMAT)
    bronze.ingest(store, raw(spark, folder).withColumn("event_time", as_text), _REGISTERED_AT)
    return store.read(STG_EVENTS).select(*silver.RAW_NAMES)


def batch_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger after daily deliveries came in two goes, the second one with those of the first."""
    store = Store(spark, fresh_folder(spark, "ledger"))
    rows = event_feed.deliveries(event_feed.events(spark, folder), "day")
    for part in (rows.where(F.col("batch_id") <= BATCH_DAY), rows):
        bronze.ingest(store, part, _REGISTERED_AT)
    return bronze.stored_batches(store)


def redelivery_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """What is said of daily deliveries that come again, in any order: some with an amount changed, some with rows lost."""
    rows = event_feed.deliveries(event_feed.events(spark, folder), "day")
    day = F.dayofmonth(F.to_date(F.substring("batch_id", 7, 10)))
    changed = (day % 3 == 0) & (F.lower("category") == "purchase")
    again = rows.where(~((day % 5 == 0) & (F.col("source") == "api"))).withColumn(
        "value", F.when(changed, F.col("value") + 1).otherwise(F.col("value"))
    )
    ledger = bronze.content_of(bronze.parsed(rows.where(F.col("batch_id") <= BATCH_DAY)))
    return bronze.verdicts(bronze.content_of(bronze.parsed(again)), ledger)


def unreadable_rows_aside(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each delivery by the reason they are set aside for, empty for valid ones, where times and amounts come as text and
    some can't be read. All rows are stored and read back."""
    store = Store(spark, fresh_folder(spark, "unreadable"))
    last = F.right("event_id", F.lit(2))
    text = raw(spark, folder).withColumn("batch_id", F.substring("batch_id", 1, len(BATCH_DAY))).withColumn(
        "event_time", F.when(last == "11", "2024-13-45 99:00:00").otherwise(F.date_format("event_time", bronze.TIME_FORMAT))
    ).withColumn("value", F.when(last.isin("11", "22"), F.concat(F.lit("n/a "), "category")).otherwise(F.col("value").cast("string")))
    bronze.ingest(store, text, _REGISTERED_AT)
    return silver.judged(store.read(STG_EVENTS)).groupBy("batch_id", "rejection_reason").agg(
        F.count("*").alias("row_count"), F.count("_unreadable").alias("with_text")
    )


def publish_interrupted(spark: SparkSession, folder: str) -> DataFrame:
    """What readers see of four tables that are to change together, where the writer is lost before each of the writes in turn and
    before the commit, and after a run that goes through (step 5)."""
    store = Store(spark, fresh_folder(spark, "interrupted"))

    def versions_of(facts_df: DataFrame) -> dict[TableSpec, DataFrame]:
        stamp = F.lit(_REGISTERED_AT)
        hourly, daily = (written(kpis(facts_df), "figures") for kpis in (gold.hourly_kpis, gold.daily_kpis))
        return {
            AGG_EVENTS_HOURLY: hourly.withColumn("_updated_at", stamp), RPT_DAILY_SUMMARY: daily.withColumn("_updated_at", stamp),
            SERVING_HOURLY: hourly.withColumn("updated_at", stamp), SERVING_DAILY: daily.withColumn("updated_at", stamp),
        }

    def put(tables: dict[TableSpec, DataFrame], lost_at: int | None = None) -> None:
        with store.transaction() as inner:
            for step, (spec, rows) in enumerate(tables.items()):
                if step == lost_at:
                    raise _Interrupted(spec.table_id)
                inner.publish(spec, rows, [()])
            if lost_at == len(tables):
                raise _Interrupted("commit")

    put(versions_of(written(served_facts(spark, folder), "facts")))
    fresh, seen = versions_of(written(facts(spark, folder), "facts")), []
    for step in range(len(fresh) + 2):
        try:
            put(fresh, step)
        except _Interrupted:
            pass
        for spec in fresh:
            measure = F.sum(spec.metrics[0]).alias("events")
            seen.append(store.read(spec).agg(F.count("*").alias("row_count"), measure).select(
                F.lit(step).alias("step"), F.lit(spec.table_id).alias("table_id"), "row_count", "events"))
    return reduce(DataFrame.unionByName, seen)


def export_hourly_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, fresh_folder(spark, "export"))
    rows = gold.hourly_kpis(facts(spark, folder)).withColumn("_updated_at", F.lit(_REGISTERED_AT))
    return _exported(store, EXPORT_HOURLY, delivery.export_layout(rows))


def export_daily_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(spark, fresh_folder(spark, "export"))
    rows = gold.daily_kpis(facts(spark, folder)).withColumn("_updated_at", F.lit(_REGISTERED_AT))
    return _exported(store, EXPORT_DAILY, rows)


def _exported(store: Store, spec: TableSpec, rows: DataFrame) -> DataFrame:
    store.publish(spec, store.staged("whole", "export", rows), [()])
    store.clear_staging("whole")
    return store.read(spec).drop("_updated_at")


def _weekly_feed(spark: SparkSession, folder: str) -> DataFrame:
    return event_feed.deliveries(event_feed.events(spark, folder), "week")


def incremental_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Daily figures after applying all weekly deliveries one by one; the same as from all rows at once."""
    store = Store(spark, fresh_folder(spark, "replay"))
    batch_run.replay(store, _weekly_feed(spark, folder))
    return store.read(RPT_DAILY_SUMMARY).drop("_updated_at")


def gold_hourly_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly figures as they stood after each of the weekly deliveries, all told from the last state and the history."""
    store = Store(spark, fresh_folder(spark, "as_of"))
    weeks = batch_run.replay(store, _weekly_feed(spark, folder))
    return reduce(DataFrame.unionByName, [
        serve.gold_as_of(store, AGG_EVENTS_HOURLY, week).drop("_updated_at").withColumn("as_of", F.lit(week)) for week in weeks
    ])


class _Interrupted(RuntimeError):
    pass


class _BreaksAtDaily(Store):
    """A store whose writer is lost when it publishes the daily figures."""

    def publish(self, spec: TableSpec, *arguments) -> None:
        if spec is RPT_DAILY_SUMMARY:
            raise _Interrupted(spec.table_id)
        super().publish(spec, *arguments)


def recovery_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Daily figures where the second weekly delivery fails on its way and the third is asked for before it is repaired."""
    store = Store(spark, fresh_folder(spark, "recovery"))
    bronze.ingest(store, _weekly_feed(spark, folder), _REGISTERED_AT)
    weeks = sorted(r["batch_id"] for r in bronze.stored_batches(store).collect())
    for batch_id in weeks[:1]:
        batch_run.apply_batch(store, batch_id)
    for batch_id in weeks[1:2]:
        try:
            batch_run.apply_batch(_BreaksAtDaily(spark, store.root), batch_id)
        except _Interrupted:
            pass
    for batch_id in [*weeks[2:], *weeks[1:2]]:
        batch_run.apply_batch(store, batch_id)
    return store.read(RPT_DAILY_SUMMARY).drop("_updated_at")


def stream_replay(spark: SparkSession, folder: str) -> DataFrame:
    """User versions after a streaming query applied all weekly deliveries one by one."""
    root = fresh_folder(spark, "stream")
    store = Store(spark, f"{root}/tables")
    source = (
        spark.readStream.schema(event_feed.table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(folder)
    )
    feed_rows = event_feed.deliveries(event_feed.with_instants(source), "week")
    feed.start(store, feed_rows, f"{root}/checkpoint").awaitTermination()
    return store.read(DIM_USERS).select(*scd2.DIM_COLUMNS)


def queries() -> dict[str, Query]:
    return {
        "bronze_ingest": bronze_ingest,
        "ingest_new_batches_only": ingest_new_batches_only,
        "quarantine_rows": lambda s, d: silver.rejected_rows(raw(s, d)),
        "quarantine_by_reason": quarantine_by_reason,
        "silver_clean": lambda s, d: silver.clean_events(raw(s, d)),
        "silver_fact_current": facts,
        "dim_users_scd2": users,
        "dim_users_scd2_reset": lambda s, d: users(s, d, carry_totals=False),
        "dim_users_current": lambda s, d: users(s, d).where("is_current = 1"),
        "dim_users_change_counts": lambda s, d: scd2.version_changes(versions(facts(s, d))),
        "gold_hourly_full": lambda s, d: gold.hourly_kpis(facts(s, d)),
        "gold_daily_full": lambda s, d: gold.daily_kpis(facts(s, d)),
        "gold_daily_from_states": lambda s, d: gold.daily_from_states(_states(s, d)),
        "gold_weekly_from_states": gold_weekly_from_states,
        "gold_hourly_for_batch": gold_hourly_for_batch,
        "gold_daily_for_batch": gold_daily_for_batch,
        "snapshot_hourly": snapshot_hourly,
        "snapshot_daily": snapshot_daily,
        "serving_upsert_hourly": serving_upsert_hourly,
        "serving_upsert_daily": serving_upsert_daily,
        "export_hourly_roundtrip": export_hourly_roundtrip,
        "export_daily_roundtrip": export_daily_roundtrip,
        "row_accounting": lambda s, d: quality.row_accounting(raw(s, d)),
        "batch_row_counts": lambda s, d: quality.batch_row_counts(raw(s, d)),
        "layer_summary": layer_summary,
        "delivery_validation": delivery_validation,
        "delivery_mismatches": delivery_mismatches,
        "delivery_mismatches_daily": delivery_mismatches_daily,
        "delivery_differences": delivery_differences,
        "catalog_tables": catalog_tables,
        "catalog_columns": catalog_columns,
        "column_profile": lambda s, d: column_profile(facts(s, d)),
        "lineage_edges": lineage_edges,
        "lineage_closure": lineage_closure,
        "run_log_current": run_log_current,
        "benchmark_compare": benchmark_compare,
        "batch_ledger": batch_ledger,
        "redelivery_verdicts": redelivery_verdicts,
        "unreadable_rows_aside": unreadable_rows_aside,
        "publish_interrupted": publish_interrupted,
        "gold_hourly_as_of": gold_hourly_as_of,
        "incremental_replay": incremental_replay,
        "recovery_replay": recovery_replay,
        "stream_replay": stream_replay,
    }
