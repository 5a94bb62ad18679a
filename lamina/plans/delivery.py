"""Serving tables and the comparison with their source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import money_sum, user_bucket
from lamina.operators import upsert_by_key
from lamina.schemas import DAILY_KEYS, DAILY_MEASURES, HASH_SUM, HOURLY_KEYS, HOURLY_MEASURES

# Fixed value: amounts closer than this are the same.
TOLERANCE = 0.01
# Hash buckets that the rows of an hour are told apart by.
KEY_BUCKETS = 64
_FLAGS = ("hourly_rows", "hourly_events", "hourly_value", "daily_rows", "daily_events")


def upsert_hourly(serving: DataFrame, gold: DataFrame) -> DataFrame:
    return upsert_by_key(serving, gold, HOURLY_KEYS)


def upsert_daily(serving: DataFrame, gold: DataFrame) -> DataFrame:
    return upsert_by_key(serving, gold, DAILY_KEYS)


def export_layout(gold_hourly: DataFrame) -> DataFrame:
    """Hourly rows with the hour as two digits, the way the export's folders name it."""
    return gold_hourly.withColumn("event_hour", F.lpad(F.col("event_hour").cast("string"), 2, "0"))


def _near(a: Column, b: Column) -> Column:
    return (F.abs(a - b) < TOLERANCE) | a.eqNullSafe(b)


def hour_totals(hourly: DataFrame, side: str) -> DataFrame:
    return hourly.groupBy("event_date", "event_hour").agg(
        F.count("*").alias(f"{side}_hourly_rows"),
        F.sum("event_count").alias(f"{side}_hourly_events"),
        money_sum(F.col("total_value")).alias(f"{side}_hourly_value"),
    )


def day_totals(daily: DataFrame, side: str) -> DataFrame:
    return daily.groupBy("event_date").agg(
        F.count("*").alias(f"{side}_daily_rows"),
        F.sum("total_events").alias(f"{side}_daily_events"),
    )


def validate(
    gold_hourly: DataFrame, gold_daily: DataFrame, serving_hourly: DataFrame, serving_daily: DataFrame
) -> DataFrame:
    """Totals of both sides for every hour either side has, the five match flags and the verdict."""
    hours = hour_totals(gold_hourly, "gold").join(
        hour_totals(serving_hourly, "serving"), ["event_date", "event_hour"], "full_outer"
    )
    days = day_totals(gold_daily, "gold").join(day_totals(serving_daily, "serving"), "event_date", "full_outer")
    zero_of = {"hourly_value": F.lit(0.0)}
    both = hours.join(days, "event_date", "left").select(
        "event_date", "event_hour",
        *[
            F.coalesce(f"{side}_{m}", zero_of.get(m, F.lit(0).cast("long"))).alias(f"{side}_{m}")
            for side in ("gold", "serving") for m in _FLAGS
        ],
    )

    def agrees(metric: str) -> Column:
        a, b = F.col(f"gold_{metric}"), F.col(f"serving_{metric}")
        return _near(a, b) if metric in zero_of else a == b

    flagged = both.select("*", *[agrees(m).cast("int").alias(f"{m}_match") for m in _FLAGS])
    passed = F.least(*[F.col(f"{m}_match") for m in _FLAGS]) == 1
    return flagged.withColumn("overall_status", F.when(passed, "pass").otherwise("fail"))


def mismatches(
    gold: DataFrame, serving: DataFrame, keys: tuple[str, ...] = HOURLY_KEYS, measures: tuple[str, ...] = HOURLY_MEASURES
) -> DataFrame:
    """Rows that are missing, surplus, or differ in any measure. Finds swaps that leave totals alone. NULL keys are equal."""
    a = gold.select(F.struct(*keys).alias("gk"), F.struct(*measures).alias("g"))
    b = serving.select(F.struct(*keys).alias("sk"), F.struct(*measures).alias("s"))
    same_key = F.lit(True)
    for key in keys:
        same_key = same_key & F.col(f"gk.{key}").eqNullSafe(F.col(f"sk.{key}"))
    doubles = {f.name for f in gold.schema.fields if f.dataType.typeName() == "double"}
    equal = F.lit(True)
    for m in measures:
        x, y = F.col(f"g.{m}"), F.col(f"s.{m}")
        equal = equal & (_near(x, y) if m in doubles else x.eqNullSafe(y))
    kind = (
        F.when(F.col("s").isNull(), F.lit("missing"))
        .when(F.col("g").isNull(), F.lit("surplus"))
        .when(~F.coalesce(equal, F.lit(False)), F.lit("different"))
    )
    return (
        a.join(b, same_key, "full_outer")
        .withColumn("mismatch", kind).where("mismatch is not null")
        .select(
            *[F.coalesce(f"gk.{k}", f"sk.{k}").alias(k) for k in keys], "mismatch",
            *[F.col(f"g.{m}").alias(f"gold_{m}") for m in measures],
            *[F.col(f"s.{m}").alias(f"serving_{m}") for m in measures],
        )
    )


def daily_mismatches(gold: DataFrame, serving: DataFrame) -> DataFrame:
    return mismatches(gold, serving, DAILY_KEYS, DAILY_MEASURES)


def digests(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Count and two sums of row hashes by part; equal ones mean equal rows in any order. Combined before the shuffle."""
    # A hash passes over NULLs, so it has to be told where they are.
    cells = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    sums = [F.sum(hashed.cast(HASH_SUM)) for hashed in (F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells))]
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), sums[0].alias("low"), sums[1].alias("high"))


def differing_parts(gold: DataFrame, serving: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Parts, by columns that are never NULL, whose digests differ between the two sides or that only one side has."""
    sides = [digests(rows, columns, by).select(*by, F.struct("rows", "low", "high").alias(name)) for name, rows in (("g", gold), ("s", serving))]
    return sides[0].join(sides[1], by, "full_outer").where(~F.col("g").eqNullSafe(F.col("s"))).select(*by)


def differences_below(
    gold: DataFrame, serving: DataFrame, keys: tuple[str, ...] = HOURLY_KEYS, measures: tuple[str, ...] = HOURLY_MEASURES
) -> DataFrame:
    """The rows of `mismatches`, found by going down a tree of digests: hours, then hash buckets of keys; rows
    are only joined in buckets that differ. Both sides should already be narrowed to the days that differ."""
    columns = [*keys, *measures]
    at_hours = [k for k in ("event_date", "event_hour") if k in keys]
    bucket = user_bucket(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), KEY_BUCKETS)
    gold, serving = gold.withColumn("_bucket", bucket), serving.withColumn("_bucket", bucket)
    for by in (at_hours, [*at_hours, "_bucket"]):
        parts = differing_parts(gold, serving, columns, by)
        gold, serving = gold.join(parts, by, "left_semi"), serving.join(parts, by, "left_semi")
    return mismatches(gold, serving, keys, measures)


def by_measure(found: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """One row for each measure that differs; for rows that one side lacks, each measure."""
    def cell(measure: str) -> Column:
        a, b = F.col(f"gold_{measure}").cast("double"), F.col(f"serving_{measure}").cast("double")
        return F.struct(
            F.lit(measure).alias("measure"), a.alias("gold_value"), b.alias("serving_value"),
            F.coalesce(_near(a, b), F.lit(False)).alias("agrees"),
        )

    names = [c for c in found.columns if not c.startswith(("gold_", "serving_"))]
    cells = found.select(*names, F.inline(F.array(*[cell(m) for m in measures])))
    return cells.where((F.col("mismatch") != "different") | ~F.col("agrees")).drop("agrees")
