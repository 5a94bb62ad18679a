"""Every table of the engine, declared once.

Readers, writers, the SQL registration and the metadata catalog all work from
these declarations, so none of them can drift from the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
DATE, TS = T.DateType(), T.TimestampType()
# Money is added up exactly in this type, see lamina.functions.money. With 38 digits Spark
# would have to cut decimals when adding two of them.
EXACT = T.DecimalType(37, 10)
# Sums of 64-bit hashes.
HASH_SUM = T.DecimalType(38, 0)


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    description: str
    columns: tuple[tuple[str, T.DataType, str], ...]
    #: "append" keeps every row; "latest" means one current row per `keys`.
    contract: str = "append"
    keys: tuple[str, ...] = ()
    version: str | None = None
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    metrics: tuple[str, ...] = ()
    #: Partitions are small whatever the input looks like: aggregates and hash buckets.
    small_partitions: bool = False
    nullable: tuple[str, ...] = field(default=())

    @property
    def table_id(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, dtype, True, {"comment": text}) for name, dtype, text in self.columns]
        )

    @property
    def column_names(self) -> list[str]:
        return [c[0] for c in self.columns]


RAW_COLUMNS = (
    ("event_id", STRING, "Identifier given by the source; blank means missing"),
    ("user_name", STRING, "User name as delivered"),
    ("category", STRING, "Event category as delivered"),
    ("source", STRING, "Channel as delivered"),
    ("value", DOUBLE, "Amount as delivered"),
    ("event_time", TS, "When the event happened"),
    ("batch_id", STRING, "Delivery the row came with"),
)

STG_EVENTS = TableSpec(
    "bronze", "stg_events", "Deliveries exactly as received",
    RAW_COLUMNS + (
        ("_unreadable", STRING, "Texts of the row that could not be read, as JSON by field"),
        ("_ingested_at", TS, "Run that stored the row"),
    ),
    partition_by=("batch_id",), sort_by=("event_id",), tags=("raw", "append-only"), metrics=("value",),
)

FACT_EVENTS = TableSpec(
    "silver", "fact_events", "Valid events, cleaned, one row per event_id",
    (
        ("event_id", STRING, "Event key, unique in the table"),
        ("user_name", STRING, "User name, lower case without outer blanks"),
        ("category", STRING, "Category, lower case without outer blanks"),
        ("source", STRING, "Channel, lower case without outer blanks"),
        ("value", DOUBLE, "Amount, never below zero"),
        ("event_time", TS, "When the event happened"),
        ("event_date", DATE, "Day of event_time"),
        ("event_hour", INT, "Hour of event_time, 0 to 23"),
        ("is_revenue_event", INT, "1 for a purchase with a positive amount"),
        ("batch_id", STRING, "Delivery this version came with"),
        ("_loaded_at", TS, "Run that stored the row"),
    ),
    contract="latest", keys=("event_id",), version="batch_id",
    # A delivery only ever adds its own directories and rewrites the ones that
    # hold an event it corrects; readers prune on the day and on the delivery.
    partition_by=("event_date", "batch_id"), sort_by=("event_hour", "event_id"),
    tags=("facts", "deduplicated"), metrics=("value", "is_revenue_event"),
)

QUARANTINE_EVENTS = TableSpec(
    "silver", "quarantine_events", "Rows that lack an event or a user, with the reason",
    RAW_COLUMNS + (
        ("rejection_reason", STRING, "Comma separated list of what is missing or unreadable"),
        ("_unreadable", STRING, "Texts of the row that could not be read, as JSON by field"),
        ("_quarantined_at", TS, "Run that stored the row"),
    ),
    partition_by=("batch_id",), sort_by=("event_id", "user_name"), tags=("rejected", "data-quality"),
)

EVENT_KEYS = TableSpec(
    "silver", "event_keys", "Where the current version of each event lies; later deliveries override earlier entries",
    (
        ("event_id", STRING, "Event key"),
        ("event_date", DATE, "Day of the current version"),
        ("batch_id", STRING, "Delivery of the current version"),
        ("key_bucket", INT, "Hash bucket of event_id"),
    ),
    keys=("event_id", "batch_id"), partition_by=("key_bucket",), sort_by=("event_id",), tags=("index",), small_partitions=True,
)

DIM_USERS = TableSpec(
    "silver", "dim_users", "Users with every version of their main category and channel",
    (
        ("user_key", STRING, "Hash of user_name and valid_from"),
        ("user_name", STRING, "Cleaned user name"),
        ("first_seen_date", DATE, "First day of the user's first delivery"),
        ("last_seen_date", DATE, "Last day of the user's latest delivery in this version"),
        ("primary_category", STRING, "Most frequent category of the delivery"),
        ("primary_source", STRING, "Most frequent channel of the delivery"),
        ("total_events", LONG, "Events up to the end of this version"),
        ("total_value", DOUBLE, "Amount up to the end of this version"),
        ("is_revenue_user", INT, "1 once the user had a revenue event"),
        ("valid_from", TS, "Logical time of the delivery that opened the version"),
        ("valid_to", TS, "Logical time of the delivery that closed it"),
        ("is_current", INT, "1 for the open version"),
        ("value_exact", EXACT, "Exact part of total_value, so that it can be added to"),
        ("value_rest", DOUBLE, "Part of total_value that is no finite decimal"),
        ("user_bucket", INT, "Hash bucket of user_name"),
    ),
    contract="latest", keys=("user_name", "valid_from"), version="valid_to",
    # Closed versions don't change any more but by corrections, so they lie apart and are only added to.
    partition_by=("is_current", "user_bucket"), sort_by=("user_name", "valid_from"),
    tags=("dimension", "history"), metrics=("total_events", "total_value"),
    small_partitions=True,
)

USER_NUMBERS = TableSpec(
    "silver", "user_numbers", "A number for each user that never changes, for sets of users as bitmaps",
    (
        ("user_name", STRING, "Cleaned user name"),
        ("user_no", LONG, "Place in the hash bucket, times the number of buckets, plus the bucket"),
        ("user_bucket", INT, "Hash bucket of user_name"),
    ),
    keys=("user_name",), partition_by=("user_bucket",), sort_by=("user_name",), tags=("index", "append-only"), small_partitions=True,
)

USER_ACTIVITY = TableSpec(
    "silver", "user_activity", "Signed per-delivery changes of each user's activity",
    (
        ("user_name", STRING, "Cleaned user name"),
        ("batch_id", STRING, "Delivery the counted events belong to"),
        ("batch_ts", TS, "Logical time of that delivery"),
        ("event_date", DATE, "Day of the events"),
        ("category", STRING, "Category of the events"),
        ("source", STRING, "Channel of the events"),
        ("n", LONG, "Events added, negative when a correction took them away"),
        ("value_exact", EXACT, "Exact part of the amount"),
        ("value_rest", DOUBLE, "Amount of each event where it is no finite decimal, else 0"),
        ("revenue_n", LONG, "Revenue events"),
        ("user_bucket", INT, "Hash bucket of user_name"),
        ("applied_batch", STRING, "Delivery that caused the change"),
    ),
    # Sorted by bucket, so that a reader of some buckets skips the row groups of the others.
    partition_by=("applied_batch",), sort_by=("user_bucket", "user_name"), tags=("activity", "append-only"),
)

_HOURLY = (
    ("event_date", DATE, "Day"),
    ("event_hour", INT, "Hour of the day, 0 to 23"),
    ("category", STRING, "Event category"),
    ("source", STRING, "Channel"),
    ("event_count", LONG, "Events"),
    ("revenue_events", LONG, "Revenue events"),
    ("total_value", DOUBLE, "Sum of amounts"),
    ("_updated_at", TS, "Run that computed the row"),
)
_DAILY = (
    ("event_date", DATE, "Day"),
    ("total_events", LONG, "Events"),
    ("unique_users", LONG, "Distinct users"),
    ("revenue_events", LONG, "Revenue events"),
    ("total_revenue", DOUBLE, "Sum of amounts of revenue events"),
    ("avg_value", DOUBLE, "Mean amount per event"),
    ("_updated_at", TS, "Run that computed the row"),
)
_SNAPSHOT = (
    ("_snapshot_ts", TS, "Run that took the snapshot"),
    ("_snapshot_batch", STRING, "Delivery the snapshot was taken for"),
)
HOURLY_KEYS = ("event_date", "event_hour", "category", "source")
HOURLY_MEASURES = ("event_count", "revenue_events", "total_value")
DAILY_KEYS = ("event_date",)
DAILY_MEASURES = ("total_events", "unique_users", "revenue_events", "total_revenue", "avg_value")

AGG_EVENTS_HOURLY = TableSpec(
    "gold", "agg_events_hourly", "Hourly figures by category and channel", _HOURLY,
    contract="latest", keys=HOURLY_KEYS, version="_updated_at",
    partition_by=("event_date",), sort_by=HOURLY_KEYS[1:], tags=("aggregate", "hourly"), metrics=HOURLY_MEASURES,
    small_partitions=True,
)
RPT_DAILY_SUMMARY = TableSpec(
    "gold", "rpt_daily_summary", "Daily figures", _DAILY,
    contract="latest", keys=DAILY_KEYS, version="_updated_at",
    partition_by=("event_date",), tags=("aggregate", "daily"), metrics=DAILY_MEASURES,
    small_partitions=True,
)
DAILY_STATES = TableSpec(
    "gold", "daily_states", "What each delivery adds to the daily figures of a day, in a form that adds up over deliveries and days",
    (
        ("event_date", DATE, "Day"),
        ("batch_id", STRING, "Delivery of the current events"),
        ("user_block", LONG, "Block of 32,768 user numbers"),
        ("users", T.BinaryType(), "Bitmap of the block's users with events"),
        ("total_events", LONG, "Events"),
        ("revenue_events", LONG, "Revenue events"),
        ("value_exact", EXACT, "Exact part of the amount"),
        ("value_rest", DOUBLE, "Part of the amount that is no finite decimal"),
        ("paid_exact", EXACT, "Exact part of the amount of revenue events"),
        ("paid_rest", DOUBLE, "Part of that amount that is no finite decimal"),
    ),
    keys=("event_date", "batch_id", "user_block"), partition_by=("event_date", "batch_id"), sort_by=("user_block",),
    tags=("aggregate", "daily", "mergeable"), metrics=("total_events", "revenue_events"),
)
AGG_EVENTS_HOURLY_HISTORY = TableSpec(
    "gold", "agg_events_hourly_history", "Hourly figures as they stood before a delivery changed them",
    _HOURLY + _SNAPSHOT, partition_by=("_snapshot_batch",), sort_by=HOURLY_KEYS,
    tags=("audit", "append-only"), metrics=HOURLY_MEASURES,
)
RPT_DAILY_SUMMARY_HISTORY = TableSpec(
    "gold", "rpt_daily_summary_history", "Daily figures as they stood before a delivery changed them",
    _DAILY + _SNAPSHOT, partition_by=("_snapshot_batch",), sort_by=DAILY_KEYS,
    tags=("audit", "append-only"), metrics=DAILY_MEASURES,
)
SNAPSHOT_DAYS = TableSpec(
    "gold", "snapshot_days", "Days whose figures a delivery changed, in the order deliveries were applied",
    (
        ("event_date", DATE, "Day; empty in one row of each delivery, which stands for the delivery itself"),
        ("position", LONG, "Deliveries applied before"),
        ("_snapshot_batch", STRING, "Delivery"),
    ),
    keys=("_snapshot_batch", "event_date"), partition_by=("_snapshot_batch",), tags=("audit", "index"), nullable=("event_date",),
    small_partitions=True,
)

SERVING_HOURLY = TableSpec(
    "serving", "agg_events_hourly", "Hourly figures as consumers see them",
    _HOURLY[:-1] + (("updated_at", TS, "Last time the row was written"),),
    contract="latest", keys=HOURLY_KEYS, version="updated_at",
    partition_by=("event_date",), sort_by=HOURLY_KEYS[1:], tags=("delivery",), metrics=HOURLY_MEASURES,
    small_partitions=True,
)
SERVING_DAILY = TableSpec(
    "serving", "rpt_daily_summary", "Daily figures as consumers see them",
    _DAILY[:-1] + (("updated_at", TS, "Last time the row was written"),),
    contract="latest", keys=DAILY_KEYS, version="updated_at",
    partition_by=("event_date",), tags=("delivery",), metrics=DAILY_MEASURES,
    small_partitions=True,
)

# The export names its folders by day and two-digit hour, so the hour is text there.
EXPORT_HOURLY = TableSpec(
    "export", "agg_events_hourly", "Hourly figures as Parquet files by day and hour",
    (_HOURLY[0], ("event_hour", STRING, "Hour of the day, 00 to 23"), *_HOURLY[2:]),
    keys=HOURLY_KEYS, partition_by=("event_date", "event_hour"), sort_by=HOURLY_KEYS[2:],
    small_partitions=True,
)
EXPORT_DAILY = TableSpec(
    "export", "rpt_daily_summary", "Daily figures as Parquet files by day", _DAILY,
    keys=DAILY_KEYS, partition_by=("event_date",),
    small_partitions=True,
)

_TAGS = T.ArrayType(STRING)
TABLE_REGISTRY = TableSpec(
    "catalog", "table_registry", "One record per table",
    (
        ("table_id", STRING, "layer.table"),
        ("database_name", STRING, "Database of the table"),
        ("table_name", STRING, "Name without the database"),
        ("layer", STRING, "Layer of the table"),
        ("engine", STRING, "Storage contract: append or latest"),
        ("description", STRING, "What the table holds"),
        ("owner", STRING, "Team responsible"),
        ("partition_key", STRING, "Partition columns"),
        ("order_key", STRING, "Key and sort columns"),
        ("tags", _TAGS, "Labels"),
        ("updated_at", TS, "When the record was written"),
    ),
    contract="latest", keys=("table_id",), version="updated_at", tags=("metadata",),
)
COLUMN_REGISTRY = TableSpec(
    "catalog", "column_registry", "One record per column",
    (
        ("column_id", STRING, "layer.table.column"),
        ("table_id", STRING, "Table of the column"),
        ("column_name", STRING, "Name"),
        ("data_type", STRING, "Spark type"),
        ("is_nullable", INT, "1 if the column may be empty"),
        ("is_partition_key", INT, "1 if the table is partitioned by it"),
        ("is_order_key", INT, "1 if it is part of the key or sort order"),
        ("description", STRING, "What the column holds"),
        ("tags", _TAGS, "Labels"),
        ("updated_at", TS, "When the record was written"),
    ),
    contract="latest", keys=("column_id",), version="updated_at", tags=("metadata",),
)
DATA_LINEAGE = TableSpec(
    "catalog", "data_lineage", "Which table feeds which",
    (
        ("lineage_id", STRING, "source->target"),
        ("source_table_id", STRING, "Table read"),
        ("target_table_id", STRING, "Table written"),
        ("transformation", STRING, "What happens on the way"),
        ("job", STRING, "Function that does it"),
        ("layer_from", STRING, "Layer read"),
        ("layer_to", STRING, "Layer written"),
        ("updated_at", TS, "When the record was written"),
    ),
    contract="latest", keys=("lineage_id",), version="updated_at", tags=("metadata",),
)
BATCH_LEDGER = TableSpec(
    "catalog", "batch_ledger", "Deliveries that are stored whole, written after their rows",
    (
        ("batch_id", STRING, "Delivery"),
        ("row_count", LONG, "Rows that came, the same as the rows stored"),
        ("content_low", HASH_SUM, "Sum of one hash of the rows, whatever their order"),
        ("content_high", HASH_SUM, "Sum of another hash of the rows"),
        ("_stored_at", TS, "Run that stored it"),
    ),
    keys=("batch_id",), tags=("metadata", "runs"), metrics=("row_count",),
)
PIPELINE_RUNS = TableSpec(
    "catalog", "pipeline_runs", "Start and end of every run",
    (
        ("run_id", STRING, "Run"),
        ("batch_id", STRING, "Delivery the run applied"),
        ("execution_date", TS, "Logical time of the delivery"),
        ("bronze_rows", LONG, "Rows received"),
        ("quarantined_rows", LONG, "Rows set aside"),
        ("silver_rows", LONG, "Events added or corrected"),
        ("gold_hourly_rows", LONG, "Hourly rows recomputed"),
        ("gold_daily_rows", LONG, "Daily rows recomputed"),
        ("dim_users_new", LONG, "Users seen for the first time"),
        ("dim_users_updated", LONG, "Users that got a new version"),
        ("status", STRING, "running, success or failed"),
        ("started_at", TS, "Start of the run"),
        ("completed_at", TS, "End of the run, empty while it runs"),
        ("_updated_at", TS, "When the record was written"),
    ),
    contract="latest", keys=("run_id",), version="_updated_at", partition_by=("batch_id",),
    tags=("metadata", "runs"), nullable=("completed_at",),
)
_SIDES = ("gold", "serving")
VALIDATION_LOG = TableSpec(
    "catalog", "validation_log", "Every comparison of gold with the serving tables",
    (
        ("run_id", STRING, "Run that compared"),
        ("event_date", DATE, "Day compared"),
        ("event_hour", INT, "Hour compared"),
    )
    + tuple(
        (f"{side}_{metric}", dtype, f"{metric.replace('_', ' ')} in the {side} table")
        for side in _SIDES
        for metric, dtype in (
            ("hourly_rows", LONG), ("hourly_events", LONG), ("hourly_value", DOUBLE),
            ("daily_rows", LONG), ("daily_events", LONG),
        )
    )
    + tuple(
        (f"{metric}_match", INT, f"1 if {metric.replace('_', ' ')} agree")
        for metric in ("hourly_rows", "hourly_events", "hourly_value", "daily_rows", "daily_events")
    )
    + (
        ("overall_status", STRING, "pass or fail"),
        ("validated_at", TS, "When the comparison ran"),
    ),
    sort_by=("event_date", "event_hour"), tags=("metadata", "validation"),
)
DELIVERY_DIFFERENCES = TableSpec(
    "catalog", "delivery_differences", "Measures that a comparison of gold with the serving tables found to differ",
    (
        ("run_id", STRING, "Run that compared"),
        ("table_id", STRING, "Gold table compared"),
        ("event_date", DATE, "Day of the row"),
        ("event_hour", INT, "Hour of the row, empty for daily rows"),
        ("category", STRING, "Category of the row, empty for daily rows"),
        ("source", STRING, "Channel of the row, empty for daily rows"),
        ("mismatch", STRING, "missing or surplus in the serving table, or different"),
        ("measure", STRING, "Measure that differs; all of them for missing and surplus rows"),
        ("gold_value", DOUBLE, "Value in gold"),
        ("serving_value", DOUBLE, "Value in the serving table"),
        ("validated_at", TS, "When the comparison ran"),
    ),
    partition_by=("event_date",), sort_by=("event_hour", "category", "source", "measure"), tags=("metadata", "validation"),
    nullable=("event_hour", "category", "source", "gold_value", "serving_value"),
)
BENCHMARK_LOG = TableSpec(
    "catalog", "benchmark_log", "Time and throughput of every step",
    (
        ("run_id", STRING, "Run"),
        ("framework", STRING, "Engine that ran the step"),
        ("framework_version", STRING, "Version of that engine"),
        ("task_name", STRING, "Step"),
        ("layer", STRING, "Layer the step belongs to"),
        ("status", STRING, "success or failed"),
        ("started_at", TS, "Start"),
        ("ended_at", TS, "End"),
        ("duration_ms", LONG, "Wall clock"),
        ("rows_in", LONG, "Rows read, 0 if the step failed"),
        ("rows_out", LONG, "Rows written, 0 if the step failed"),
        ("rows_per_second", DOUBLE, "rows_out by second, 0 for no duration"),
        ("batch_id", STRING, "Delivery"),
        ("event_date", DATE, "Day of the delivery's logical time"),
        ("event_hour", INT, "Hour of the delivery's logical time"),
        ("extra", STRING, "Further facts as JSON"),
        ("_recorded_at", TS, "When the record was written"),
    ),
    sort_by=("task_name",), tags=("metadata", "metrics"),
)

TABLES: tuple[TableSpec, ...] = (
    STG_EVENTS, FACT_EVENTS, EVENT_KEYS, QUARANTINE_EVENTS, DIM_USERS, USER_ACTIVITY, USER_NUMBERS,
    AGG_EVENTS_HOURLY, RPT_DAILY_SUMMARY, DAILY_STATES, AGG_EVENTS_HOURLY_HISTORY, RPT_DAILY_SUMMARY_HISTORY,
    SNAPSHOT_DAYS, SERVING_HOURLY, SERVING_DAILY,
    TABLE_REGISTRY, COLUMN_REGISTRY, DATA_LINEAGE, BATCH_LEDGER, PIPELINE_RUNS, VALIDATION_LOG, DELIVERY_DIFFERENCES,
    BENCHMARK_LOG,
)

# The data flows between tables, (source, target, what happens, function).
LINEAGE: tuple[tuple[TableSpec, TableSpec, str, str], ...] = (
    (STG_EVENTS, FACT_EVENTS, "clean valid rows, keep the newest of each event", "silver.clean_events"),
    (STG_EVENTS, QUARANTINE_EVENTS, "set aside rows without event or user", "silver.rejected_rows"),
    (FACT_EVENTS, DIM_USERS, "versions of each user's main category and channel", "scd2.user_versions"),
    (FACT_EVENTS, AGG_EVENTS_HOURLY, "sums by day, hour, category and channel", "gold.hourly_kpis"),
    (FACT_EVENTS, RPT_DAILY_SUMMARY, "sums and distinct users by day", "gold.daily_kpis"),
    (AGG_EVENTS_HOURLY, AGG_EVENTS_HOURLY_HISTORY, "copy before recomputing", "gold.snapshot"),
    (RPT_DAILY_SUMMARY, RPT_DAILY_SUMMARY_HISTORY, "copy before recomputing", "gold.snapshot"),
)
