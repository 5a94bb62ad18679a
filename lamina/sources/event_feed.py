"""Deliveries of raw events, derived from the `events` table.

The events table is clean and unique. The feed gives it the faults a real source
has, by rules on the event number, so that every cleaning rule has work to do:
missing keys, untidy text, negative amounts, and corrections that arrive a day
later under the same event_id. FIXTURES.md lists the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TIME_IN_ID = (
    r"(\d{4}-\d{2}-\d{2})(?:[T _](\d{2})(?::(\d{2})(?::(\d{2})(?:\.\d+)?)?)?(Z|[+-]\d{2}:\d{2})?)?"
)
# Size of a delivery, and how its batch_id writes the start: batch_2024-01-20 11 or batch_2024-01-20.
PERIODS = {"hour": "yyyy-MM-dd HH", "day": "yyyy-MM-dd", "week": "yyyy-MM-dd"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return with_instants(table(spark, folder, "events"))


def with_instants(raw_events: DataFrame) -> DataFrame:
    """Stored times carry no zone; they are UTC."""
    return raw_events.withColumn("ts", F.col("ts").cast("timestamp"))


def deliveries(events_df: DataFrame, period: str = "hour") -> DataFrame:
    """Raw rows as a source would deliver them, from a batch or a streaming events table."""
    no = F.col("event_id")
    no_both = no % 50 == 7
    arrivals = F.when(no % 50 == 9, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    name = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    untidy = F.concat(F.lit("  User_"), F.col("user_id").cast("string"), F.lit(" "))
    channel = F.element_at(
        F.array(F.lit("web"), F.lit(" Mobile"), F.lit("api"), F.lit("partner")),
        ((no + F.col("user_id")) % 4 + 1).cast("int"),
    )
    amount = F.col("value") + F.col("arrival")
    arrived = F.date_trunc("hour", "ts") + F.make_dt_interval(hours=F.col("arrival") * 24)
    return (
        events_df.select("event_id", "user_id", "event_type", "value", "ts", F.explode(arrivals).alias("arrival"))
        .select(
            F.when((no % 20 == 3) | no_both, F.lit("")).otherwise(F.concat(F.lit("ev_"), no.cast("string")))
            .alias("event_id"),
            F.when(no_both | (no % 33 == 4), F.lit("")).when(no % 7 == 2, untidy).otherwise(name).alias("user_name"),
            F.when(no % 11 == 5, F.upper("event_type")).otherwise(F.col("event_type")).alias("category"),
            channel.alias("source"),
            F.when(no % 13 == 6, -amount).otherwise(amount).alias("value"),
            F.date_trunc("second", "ts").alias("event_time"),
            F.concat(F.lit("batch_"), F.date_format(F.date_trunc(period, arrived), PERIODS[period])).alias("batch_id"),
        )
    )


def delivery_time(batch_id):
    """Logical time of a delivery: the first date in its id with the time of day that follows, as far as it is given.

    Without an offset the time is UTC. An id that holds no date raises.
    """
    def part(group: int, absent: str):
        found = F.regexp_extract(batch_id, _TIME_IN_ID, group)
        return F.when(found == "", absent).otherwise(found)

    missing = F.raise_error(F.concat(F.lit("no date in delivery id "), batch_id)).cast("string")
    day = F.regexp_extract(batch_id, _TIME_IN_ID, 1)
    clock = F.concat_ws(":", part(2, "00"), part(3, "00"), part(4, "00"))
    text = F.concat(F.when(day == "", missing).otherwise(day), F.lit(" "), clock, part(5, "Z"))
    return F.to_timestamp(text, "yyyy-MM-dd HH:mm:ssXXX")
