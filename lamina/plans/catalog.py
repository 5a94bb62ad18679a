"""Metadata of the tables, and queries over it."""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import keep_latest
from lamina.schemas import COLUMN_REGISTRY, DATA_LINEAGE, LINEAGE, TABLE_REGISTRY, TABLES, TableSpec

OWNER = "data-engineering"


def _rows(spark: SparkSession, spec: TableSpec, records: list[dict], at: datetime) -> DataFrame:
    rows = [tuple(at if c == spec.version else r[c] for c in spec.column_names) for r in records]
    return spark.createDataFrame(rows, spec.schema)


def table_records(spark: SparkSession, at: datetime) -> DataFrame:
    return _rows(spark, TABLE_REGISTRY, [
        {
            "table_id": t.table_id, "database_name": t.layer, "table_name": t.name, "layer": t.layer,
            "engine": t.contract, "description": t.description, "owner": OWNER,
            "partition_key": ", ".join(t.partition_by),
            "order_key": ", ".join(dict.fromkeys(t.keys + t.sort_by)), "tags": list(t.tags),
        }
        for t in TABLES
    ], at)


def column_records(spark: SparkSession, at: datetime) -> DataFrame:
    return _rows(spark, COLUMN_REGISTRY, [
        {
            "column_id": f"{t.table_id}.{name}", "table_id": t.table_id, "column_name": name,
            "data_type": dtype.simpleString(), "is_nullable": int(name in t.nullable),
            "is_partition_key": int(name in t.partition_by),
            "is_order_key": int(name in t.keys + t.sort_by), "description": text,
            "tags": ["metric"] if name in t.metrics else [],
        }
        for t in TABLES for name, dtype, text in t.columns
    ], at)


def lineage_records(spark: SparkSession, at: datetime) -> DataFrame:
    return _rows(spark, DATA_LINEAGE, [
        {
            "lineage_id": f"{a.table_id}->{b.table_id}", "source_table_id": a.table_id, "target_table_id": b.table_id,
            "transformation": text, "job": job, "layer_from": a.layer, "layer_to": b.layer,
        }
        for a, b, text, job in LINEAGE
    ], at)


def unregistered(records: DataFrame, registered: DataFrame, spec: TableSpec) -> DataFrame:
    """Records that are new or differ from the current registered ones."""
    content = [c for c in spec.column_names if c != spec.version]
    current = keep_latest(registered, spec.keys, spec.version)
    return records.join(current.select(*content), content, "left_anti").select(*spec.column_names)


def lineage_closure(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Every table with everything that is computed from it, directly or not, and the shortest distance."""
    return spark.sql(
        """
        with recursive reach (ancestor, descendant, depth) as (
          select source_table_id, target_table_id, 1 from {edges}
          union all
          select r.ancestor, e.target_table_id, r.depth + 1
          from reach r join {edges} e on e.source_table_id = r.descendant
        )
        select ancestor, descendant, min(depth) as depth from reach group by ancestor, descendant
        """,
        edges=edges,
    )


def table_sizes(sources: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(table_id, row_count). A source comes with the tables that are parts of it, and is read once for all of them."""
    def of_source(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
        cells = [F.struct(F.lit(t).alias("table_id"), F.count_if(c).alias("row_count")) for t, c in parts.items()]
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

    return reduce(DataFrame.unionByName, [of_source(df, parts) for df, parts in sources])


def column_sizes(sources: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(table_id, column_name, row_count, missing_count) of every column, one pass for each source.

    Columns of the source that a table doesn't have are not to be joined with.
    """
    def of_source(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
        def missing(name: str) -> Column:
            value = F.col(name)
            text = df.schema[name].dataType.typeName() == "string"
            return value.isNull() | (value == "") if text else value.isNull()

        cells = [
            F.struct(
                F.lit(t).alias("table_id"), F.lit(name).alias("column_name"), F.count_if(c).alias("row_count"),
                F.count_if(c & missing(name)).alias("missing_count"),
            )
            for t, c in parts.items() for name in df.columns
        ]
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

    return reduce(DataFrame.unionByName, [of_source(df, parts) for df, parts in sources])


def current_runs(runs: DataFrame) -> DataFrame:
    return keep_latest(runs, ["run_id"], "_updated_at")


def compare_tasks(benchmark_log: DataFrame) -> DataFrame:
    """Mean duration and throughput of successful steps by step and framework."""
    return (
        benchmark_log.where("status = 'success'")
        .groupBy("framework", "task_name")
        .agg(
            (F.sum("duration_ms") / F.count("duration_ms")).alias("avg_ms"),
            F.avg("rows_per_second").alias("avg_throughput"),
        )
        .orderBy("task_name", "framework")
    )


def as_json(extra: dict | None) -> str:
    return json.dumps(extra or {}, sort_keys=True)
