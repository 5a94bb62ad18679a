"""User dimension with versions.

A version is a run of consecutive deliveries in which the user's most frequent
category and channel stay the same. Two forms give the same rows: `user_versions`
computes whole histories in one pass, `advance_versions` moves the open
versions on by one delivery.

`carry_totals=True` keeps counting over a user's whole life. With False, totals, first
day and revenue flag start again with every version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import OPEN_END, exact_part, money, rest_part, user_key
from lamina.schemas import EXACT

ACTIVITY_KEYS = ("user_name", "batch_id", "batch_ts", "event_date", "category", "source", "value_rest")
DIM_COLUMNS = [
    "user_key", "user_name", "first_seen_date", "last_seen_date", "primary_category", "primary_source",
    "total_events", "total_value", "is_revenue_user", "valid_from", "valid_to", "is_current",
]
# What the stored table holds on top, so that totals can be added to exactly.
PARTS = ["value_exact", "value_rest"]
_EXACT = EXACT.simpleString()


def user_activity(facts: DataFrame, batch_ts: Column, taken_away: bool = False) -> DataFrame:
    """Events per user, delivery, day, category and channel, negative for events taken away.

    The map side combines rows of a hot user into one per combination, so no user
    is ever gathered row by row.
    """
    value = F.col("value")

    def signed(amount: Column) -> Column:
        return F.negative(amount) if taken_away else amount

    return (
        facts.withColumn("batch_ts", batch_ts)
        .withColumn("value_rest", rest_part(value))
        .groupBy(*ACTIVITY_KEYS)
        .agg(
            signed(F.count("*")).alias("n"),
            signed(F.coalesce(F.sum(exact_part(value)).cast(_EXACT), F.lit(0).cast(_EXACT))).alias("value_exact"),
            signed(F.sum("is_revenue_event")).alias("revenue_n"),
        )
    )


def net_activity(changes: DataFrame) -> DataFrame:
    """Signed changes added up; combinations that were taken away entirely are gone."""
    return (
        changes.groupBy(*ACTIVITY_KEYS)
        .agg(
            F.sum("n").alias("n"),
            F.sum("value_exact").cast(_EXACT).alias("value_exact"),
            F.sum("revenue_n").alias("revenue_n"),
        )
        .where("n > 0")
    )


def user_profiles(activity: DataFrame) -> DataFrame:
    """One row per user and delivery: counts, days, and the most frequent category and channel.

    Among equally frequent values the alphabetically first one is taken. All groupings below
    are within a user's delivery, so the repartition of the already combined rows is the
    only shuffle. It spreads a hot user over that user's deliveries.
    """
    facet = F.explode(
        F.array(
            F.struct(F.lit("category").alias("facet"), F.col("category").alias("label")),
            F.struct(F.lit("source").alias("facet"), F.col("source").alias("label")),
        )
    )

    def once(amount: Column) -> Column:
        """Every event is in both facets; amounts are counted in one of them."""
        return F.when(F.col("facet") == "category", amount)

    per_label = (
        activity.repartition("user_name", "batch_id")
        .select("*", facet).select("*", "col.*")
        .groupBy("user_name", "batch_id", "batch_ts", "facet", "label")
        .agg(
            F.sum("n").alias("n"),
            F.sum(once(F.col("value_exact"))).cast(_EXACT).alias("value_exact"),
            F.sum(once(F.col("n") * F.col("value_rest"))).alias("value_rest"),
            F.sum(once(F.col("revenue_n"))).alias("revenue_n"),
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
        )
    )

    def top(facet_name: str) -> Column:
        ranked = F.struct((-F.col("n")).alias("rank"), F.col("label"))
        return F.min(F.when(F.col("facet") == facet_name, ranked))["label"]

    return per_label.groupBy("user_name", "batch_id", "batch_ts").agg(
        top("category").alias("primary_category"),
        top("source").alias("primary_source"),
        F.sum(once(F.col("n"))).alias("n"),
        F.sum("value_exact").cast(_EXACT).alias("value_exact"),
        F.sum("value_rest").alias("value_rest"),
        (F.sum("revenue_n") > 0).cast("int").alias("has_revenue"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def user_versions(profiles: DataFrame, carry_totals: bool = True) -> DataFrame:
    """Whole histories from profiles. One row per version, with its number in `version_no`."""
    by_time = Window.partitionBy("user_name").orderBy("batch_ts", "batch_id")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    label = F.struct("primary_category", "primary_source")
    steps = (
        profiles.withColumn("_before", F.lag(label).over(by_time))
        .withColumn("_opens", F.when(F.col("_before").isNull() | (F.col("_before") != label), 1).otherwise(0))
        .withColumn("_next_opens", F.lead("_opens").over(by_time))
        .withColumn("_next_ts", F.lead("batch_ts").over(by_time))
        .withColumn("version_no", F.sum("_opens").over(so_far))
    )
    if carry_totals:
        running = so_far
    else:
        running = (
            Window.partitionBy("user_name", "version_no").orderBy("batch_ts", "batch_id")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
    opened = F.last(F.when(F.col("_opens") == 1, F.col("batch_ts")), ignorenulls=True).over(so_far)
    last_of_version = F.col("_next_opens").isNull() | (F.col("_next_opens") == 1)
    return (
        steps.select(
            "user_name", "primary_category", "primary_source", "version_no", "_next_ts",
            F.col("last_date").alias("last_seen_date"),
            last_of_version.alias("_is_last"),
            opened.alias("valid_from"),
            F.first("first_date").over(running).alias("first_seen_date"),
            F.sum("n").over(running).alias("total_events"),
            F.sum("value_exact").over(running).cast(_EXACT).alias("value_exact"),
            F.sum("value_rest").over(running).alias("value_rest"),
            F.max("has_revenue").over(running).alias("is_revenue_user"),
        )
        .where("_is_last")
        .withColumn("valid_to", F.coalesce("_next_ts", F.lit(OPEN_END)))
        .withColumn("is_current", F.col("_next_ts").isNull().cast("int"))
        .transform(_completed)
        .select(*DIM_COLUMNS, *PARTS, "version_no")
    )


def _completed(versions: DataFrame) -> DataFrame:
    return (
        versions.withColumn("total_value", money(F.col("value_exact"), F.col("value_rest")))
        .withColumn("user_key", user_key(F.col("user_name"), F.col("valid_from")))
    )


def advance_versions(open_versions: DataFrame, profiles: DataFrame, carry_totals: bool = True) -> DataFrame:
    """Open versions moved on by the profiles of one newer delivery.

    Users without a profile pass unchanged. `change` says what happened: 'new' for a user seen
    first, 'changed' for a new version, 'kept' for the same version with new totals, NULL for a
    version that was closed or not touched.
    """
    old = open_versions.select(F.col("user_name").alias("_user"), F.struct(*DIM_COLUMNS, *PARTS).alias("o"))
    both = old.join(profiles, old["_user"] == profiles["user_name"], "full_outer")
    had, has = F.col("_user").isNotNull(), F.col("user_name").isNotNull()
    same = (F.col("o.primary_category") == F.col("primary_category")) & (
        F.col("o.primary_source") == F.col("primary_source")
    )
    moved = had & has & ~same
    adds = had & (same if not carry_totals else F.lit(True))

    def added(column: str, batch_value: Column) -> Column:
        return F.when(adds, F.col(f"o.{column}") + batch_value).otherwise(batch_value)

    fields = {
        "user_name": F.col("user_name"),
        "first_seen_date": F.when(adds, F.col("o.first_seen_date")).otherwise(F.col("first_date")),
        "last_seen_date": F.col("last_date"),
        "primary_category": F.col("primary_category"),
        "primary_source": F.col("primary_source"),
        "total_events": added("total_events", F.col("n")),
        "is_revenue_user": F.when(adds, F.greatest("o.is_revenue_user", "has_revenue")).otherwise(F.col("has_revenue")),
        "valid_from": F.when(had & same, F.col("o.valid_from")).otherwise(F.col("batch_ts")),
        "valid_to": F.lit(OPEN_END).cast("timestamp"),
        "is_current": F.lit(1),
        "value_exact": added("value_exact", F.col("value_exact")).cast(_EXACT),
        "value_rest": added("value_rest", F.col("value_rest")),
        "change": F.when(~had, F.lit("new")).when(moved, F.lit("changed")).otherwise(F.lit("kept")),
    }
    names = list(fields)

    def previous(**replaced: Column) -> Column:
        return F.struct(*[
            (replaced[n] if n in replaced else F.lit(None).cast("string") if n == "change" else F.col(f"o.{n}")).alias(n)
            for n in names
        ])

    opened = F.struct(*[column.alias(name) for name, column in fields.items()])
    closed = previous(valid_to=F.col("batch_ts"), is_current=F.lit(0))
    outcome = (
        F.when(~has, F.array(previous()))
        .when(moved, F.array(closed, opened))
        .otherwise(F.array(opened))
    )
    return both.select(F.inline(outcome)).transform(_completed).select(*DIM_COLUMNS, *PARTS, "change")


def version_changes(versions: DataFrame) -> DataFrame:
    """New users and new versions of known users, by delivery time."""
    return versions.groupBy("valid_from").agg(
        F.count_if(F.col("version_no") == 1).alias("new_users"),
        F.count_if(F.col("version_no") > 1).alias("updated_users"),
    )
