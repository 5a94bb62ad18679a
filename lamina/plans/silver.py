"""Raw deliveries to valid facts and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import cleaned, rejection_reason
from lamina.operators import keep_latest
from lamina.schemas import FACT_EVENTS, QUARANTINE_EVENTS, RAW_COLUMNS

FACT_COLUMNS = [c for c in FACT_EVENTS.column_names if not c.startswith("_")]
RAW_NAMES = [c[0] for c in RAW_COLUMNS]
REJECTED_COLUMNS = [c for c in QUARANTINE_EVENTS.column_names if not c.startswith("_")]


def judged(raw: DataFrame) -> DataFrame:
    """Raw rows with the reason they can't be used, empty for valid ones. Stored rows know which of their texts were unreadable."""
    unreadable = F.col("_unreadable") if "_unreadable" in raw.columns else None
    reason = rejection_reason(F.col("event_id"), F.col("user_name"), F.col("event_time"), unreadable)
    return raw.withColumn("rejection_reason", reason)


def rejected_rows(raw: DataFrame) -> DataFrame:
    return judged(raw).where("rejection_reason <> ''").select(*REJECTED_COLUMNS)


def clean_events(raw: DataFrame) -> DataFrame:
    """Valid rows with tidy text, amounts from zero up, and the derived columns.

    The revenue flag looks at the cleaned category and amount. NULL amounts count as 0
    and NaN stays NaN, but is no revenue.
    """
    amount = F.coalesce("value", F.lit(0.0))
    tidy = judged(raw).where("rejection_reason = ''").select(
        "event_id",
        *[cleaned(F.col(c)).alias(c) for c in ("user_name", "category", "source")],
        F.when(amount < 0, F.lit(0.0)).otherwise(amount).alias("value"),
        "event_time",
        "batch_id",
    )
    paid = (F.col("category") == "purchase") & (F.col("value") > 0) & ~F.isnan("value")
    return (
        tidy.withColumn("event_date", F.to_date("event_time"))
        .withColumn("event_hour", F.hour("event_time"))
        .withColumn("is_revenue_event", paid.cast("int"))
        .select(*FACT_COLUMNS)
    )


def current_facts(cleaned_rows: DataFrame) -> DataFrame:
    """One row per event: the newest delivery wins.

    Copies within one delivery have no order; the latest, then the largest, then any fixed
    one of them is taken. The hash stands for the text columns, so that they don't have to travel.
    """
    any_fixed = F.xxhash64("user_name", "category", "source")
    return keep_latest(cleaned_rows, FACT_EVENTS.keys, FACT_EVENTS.version, ["event_time", "value", any_fixed])


def facts_from_raw(raw: DataFrame) -> DataFrame:
    return current_facts(clean_events(raw))
