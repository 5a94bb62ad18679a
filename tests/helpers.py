from datetime import datetime

from lamina.plans import scd2, silver
from lamina.sources.event_feed import delivery_time
from pyspark.sql import functions as F

RAW = (
    "event_id string, user_name string, category string, source string, value double, "
    "event_time timestamp, batch_id string"
)


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M")


def raw_rows(spark, *rows):
    """Rows of (event_id, user, category, source, value, time, delivery)."""
    return spark.createDataFrame([(*r[:5], at(r[5]) if r[5] else None, r[6]) for r in rows], RAW)


def content(df, *without):
    """Rows as a sorted list of dicts' items, for comparison."""
    names = sorted(c for c in df.columns if c not in without)
    return sorted((tuple((n, row[n]) for n in names) for row in df.select(*names).collect()), key=repr)


def users_of(facts, carry_totals=True):
    activity = scd2.user_activity(facts, delivery_time(F.col("batch_id")))
    return scd2.user_versions(scd2.user_profiles(activity), carry_totals).select(*scd2.DIM_COLUMNS)


def rebuilt_facts(raw):
    return silver.facts_from_raw(raw)
