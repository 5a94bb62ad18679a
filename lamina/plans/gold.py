"""Hourly and daily figures, whole or for what one delivery touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import exact_part, money, money_sum, rest_part, user_bucket
from lamina.schemas import DAILY_KEYS, EXACT, HOURLY_KEYS


def _hourly_measures():
    return (
        F.count("*").alias("event_count"),
        F.sum("is_revenue_event").alias("revenue_events"),
        money_sum(F.col("value")).alias("total_value"),
    )


def hourly_kpis(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*HOURLY_KEYS).agg(*_hourly_measures())


def daily_kpis(facts: DataFrame) -> DataFrame:
    """Daily figures in two groupings.

    Rows are first combined by day and user, which bounds what a hot user sends
    through the shuffle and makes the distinct count a plain count afterwards.
    """
    return _daily_from(facts, ())


def _daily_parts():
    value = F.col("value")
    revenue_value = F.when(F.col("is_revenue_event") == 1, value).otherwise(F.lit(0.0))
    return (
        F.count("*").alias("events"),
        F.sum("is_revenue_event").alias("revenue_events"),
        F.sum(exact_part(value)).alias("exact"), F.sum(rest_part(value)).alias("rest"),
        F.sum(exact_part(revenue_value)).alias("paid_exact"), F.sum(rest_part(revenue_value)).alias("paid_rest"),
    )


def _daily_from(facts: DataFrame, extra) -> DataFrame:
    by_user = facts.groupBy("event_date", "user_name").agg(
        *_daily_parts(), *[F.max(flag).alias(name) for name, flag in extra]
    )
    total = money(F.sum(F.col("exact")), F.sum("rest"))
    return by_user.groupBy("event_date").agg(
        F.sum("events").alias("total_events"),
        F.count("user_name").alias("unique_users"),
        F.sum("revenue_events").alias("revenue_events"),
        money(F.sum("paid_exact"), F.sum("paid_rest")).alias("total_revenue"),
        (total / F.sum("events")).alias("avg_value"),
        *[F.max(name).alias(name) for name, _ in extra],
    )


def new_user_numbers(names: DataFrame, known: DataFrame, buckets: int) -> DataFrame:
    """(user_name, user_no, user_bucket) of the users in `names` that `known` has no number for.

    `known` holds whole hash buckets, at least those of the names. Numbers of a bucket follow each other, so that
    those of all buckets lie close together and blocks of numbers are well filled.
    """
    taken = known.groupBy("user_bucket").agg(F.count("*").alias("taken"))
    fresh = names.select("user_name").distinct().join(known.select("user_name"), "user_name", "left_anti")
    fresh = fresh.withColumn("user_bucket", user_bucket(F.col("user_name"), buckets)).join(taken, "user_bucket", "left")
    place = F.coalesce("taken", F.lit(0)) + F.row_number().over(Window.partitionBy("user_bucket").orderBy("user_name")) - 1
    return fresh.select("user_name", (place * buckets + F.col("user_bucket")).alias("user_no"), "user_bucket")


def daily_states(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Figures of each (day, delivery) by block of user numbers, with the users as a bitmap.

    Rows are combined by user before they meet the numbers, so a hot user is one row per task; a group has at most
    as many rows as a block has numbers. A user without a number fails the job.
    """
    by_user = facts.groupBy("event_date", "batch_id", "user_name").agg(*_daily_parts())
    unknown = F.raise_error(F.concat(F.lit("no number for user "), F.col("user_name"))).cast("long")
    numbered = by_user.join(numbers.select("user_name", "user_no"), "user_name", "left").withColumn(
        "user_no", F.coalesce("user_no", unknown)
    )
    return numbered.groupBy("event_date", "batch_id", F.bitmap_bucket_number("user_no").alias("user_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users"),
        F.sum("events").alias("total_events"), F.sum("revenue_events").alias("revenue_events"),
        F.sum("exact").cast(EXACT).alias("value_exact"), F.sum("rest").alias("value_rest"),
        F.sum("paid_exact").cast(EXACT).alias("paid_exact"), F.sum("paid_rest").alias("paid_rest"),
    )


def daily_from_states(states: DataFrame, period: Column | None = None) -> DataFrame:
    """The figures of `daily_kpis` from the states of all deliveries of the days; facts are not looked at.

    `period`, a date computed from event_date, gives the figures of longer periods, with each user counted once.
    """
    period = F.col("event_date") if period is None else period
    blocks = states.groupBy(period.alias("event_date"), "user_block").agg(
        F.bitmap_count(F.bitmap_or_agg("users")).alias("seen"),
        *[F.sum(c).alias(c) for c in ("total_events", "revenue_events", "value_exact", "value_rest", "paid_exact", "paid_rest")],
    )
    total = money(F.sum("value_exact"), F.sum("value_rest"))
    return blocks.groupBy("event_date").agg(
        F.sum("total_events").alias("total_events"),
        F.sum("seen").alias("unique_users"),
        F.sum("revenue_events").alias("revenue_events"),
        money(F.sum("paid_exact"), F.sum("paid_rest")).alias("total_revenue"),
        (total / F.sum("total_events")).alias("avg_value"),
    )


def _near(facts: DataFrame, batch_id: str, own: DataFrame | None) -> DataFrame:
    """Facts of the days that rows of the delivery lie in.

    A DATE column holds at most 3,652,059 different days, which bounds the broadcast. On stored facts the days prune
    the partitions.
    """
    own = facts.where(F.col("batch_id") == batch_id) if own is None else own
    return facts.join(F.broadcast(own.select("event_date").distinct()), "event_date", "left_semi").select(*facts.columns)


def hourly_kpis_for_batch(facts: DataFrame, batch_id: str, own: DataFrame | None = None) -> DataFrame:
    """Hourly figures of every (day, hour) that holds a current row of `batch_id`.

    The figures cover the rows of all deliveries. Other days are left out before anything is grouped; which hours
    hold the delivery each group notes itself. `own` are the delivery's cleaned rows, current or not,
    where they are cheaper to come by than out of `facts`.
    """
    touched = F.max("_hit").over(Window.partitionBy("event_date", "event_hour"))
    return (
        _near(facts, batch_id, own).groupBy(*HOURLY_KEYS)
        .agg(*_hourly_measures(), F.max(F.col("batch_id") == batch_id).alias("_hit"))
        .withColumn("_hit", touched).where("_hit").drop("_hit")
    )


def daily_kpis_for_batch(facts: DataFrame, batch_id: str, own: DataFrame | None = None) -> DataFrame:
    """Daily figures of every day that holds a current row of `batch_id`; `own` as for the hourly ones."""
    hit = ("_hit", F.col("batch_id") == batch_id)
    return _daily_from(_near(facts, batch_id, own), [hit]).where("_hit").drop("_hit")


def as_of(current: DataFrame, history: DataFrame, changed_later: DataFrame) -> DataFrame:
    """Gold as it stood before the deliveries of `changed_later`, its rows (event_date, position, _snapshot_batch).

    A day is what the first of them found there, even where that was nothing; days none of them changed are current.
    """
    first = first_changes(changed_later)
    then = history.join(first, ["event_date", "_snapshot_batch"], "left_semi")
    since = current.join(first, "event_date", "left_anti")
    return since.select(*current.columns).unionByName(then.select(*current.columns))


def first_changes(changes: DataFrame) -> DataFrame:
    """The first delivery that changed each day; one row a day of the calendar."""
    days = changes.where(F.col("event_date").isNotNull())
    return days.groupBy("event_date").agg(F.min_by("_snapshot_batch", "position").alias("_snapshot_batch"))


def snapshot(gold: DataFrame, touched_dates: DataFrame, batch_id: str) -> DataFrame:
    """Gold rows of the touched days as they stand, marked with the delivery.

    `touched_dates` has one row per day, so it fits a broadcast for any real calendar;
    its size is still checked.
    """
    return (
        gold.join(touched_dates.select(*DAILY_KEYS).distinct(), list(DAILY_KEYS), "left_semi")
        .select(*gold.columns)
        .withColumn("_snapshot_batch", F.lit(batch_id))
    )
