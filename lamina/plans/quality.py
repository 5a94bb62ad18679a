"""Row accounting across the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.plans.silver import clean_events, current_facts, judged



def row_accounting(raw: DataFrame) -> DataFrame:
    """Per delivery: every raw row is either valid or set aside. One pass over the raw rows."""
    valid = F.col("rejection_reason") == ""
    return (
        judged(raw).groupBy("batch_id")
        .agg(
            F.count("*").alias("bronze_rows"),
            F.count_if(valid).alias("valid_rows"),
            F.count_if(F.col("rejection_reason") != "").alias("quarantined_rows"),
        )
        .withColumn("is_balanced", (F.col("bronze_rows") == F.col("valid_rows") + F.col("quarantined_rows")).cast("int"))
    )


def batch_row_counts(raw: DataFrame) -> DataFrame:
    """Per delivery: rows received, set aside, valid, and those still the newest of their event."""
    accounted = row_accounting(raw).select(
        "batch_id", "bronze_rows", "quarantined_rows", "valid_rows", F.lit(0).cast("long").alias("current_rows")
    )
    zero = F.lit(0).cast("long")
    facts = current_facts(clean_events(raw)).groupBy("batch_id").agg(F.count("*").alias("current_rows")).select(
        "batch_id", zero.alias("bronze_rows"), zero.alias("quarantined_rows"), zero.alias("valid_rows"), "current_rows"
    )
    return accounted.unionByName(facts).groupBy("batch_id").agg(
        *[F.sum(c).alias(c) for c in ("bronze_rows", "quarantined_rows", "valid_rows", "current_rows")]
    )


def layer_summary(tables: dict[str, DataFrame], batch_id: str, event_date: str) -> DataFrame:
    """Row counts over the layers: in all, of one delivery, of one day.

    `tables` maps table ids to DataFrames. Each table is read once.
    """
    scopes = {
        "bronze.stg_events": ("total", "batch"),
        "silver.fact_events": ("total", "batch"),
        "silver.quarantine_events": ("total", "batch"),
        "silver.dim_users": ("current",),
        "gold.agg_events_hourly": ("date",),
        "gold.rpt_daily_summary": ("date",),
        "gold.agg_events_hourly_history": ("total",),
        "gold.rpt_daily_summary_history": ("total",),
    }
    conditions = {
        "total": F.lit(True),
        "batch": F.expr("batch_id") == batch_id,
        "current": F.expr("is_current") == 1,
        "date": F.expr("event_date") == F.to_date(F.lit(event_date)),
    }

    def counted(table_id: str, wanted: tuple[str, ...]) -> DataFrame:
        layer, name = table_id.split(".")
        counts = tables[table_id].agg(*[F.count_if(conditions[s]).alias(s) for s in wanted])
        rows = F.inline(F.array(*[F.struct(F.lit(s).alias("scope"), F.col(s).alias("row_count")) for s in wanted]))
        return counts.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), rows)

    return reduce(DataFrame.unionByName, [counted(t, s) for t, s in scopes.items()])
