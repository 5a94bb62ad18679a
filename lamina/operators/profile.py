"""What the columns of a table hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """One row per column: rows, missing values, distinct values, smallest, largest.

    Counts, minimum and maximum come from one pass without a shuffle of rows. Exact
    distinct counts go through (column, value) groups that are combined before the
    shuffle, so a value that fills a third of the table costs no more than a rare one;
    `exact_distinct=False` uses a sketch in the same single pass instead.
    """
    def missing(name: str):
        value = F.col(name)
        if isinstance(df.schema[name].dataType, T.StringType):
            return value.isNull() | (value == "")
        return value.isNull()

    def record(name: str):
        fields = [
            F.lit(name).alias("column_name"),
            F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
            F.count("*").alias("row_count"),
            F.count_if(missing(name)).alias("missing_count"),
            F.min(name).cast("string").alias("min_value"),
            F.max(name).cast("string").alias("max_value"),
        ]
        if not exact_distinct:
            fields.append(F.approx_count_distinct(name).alias("distinct_count"))
        return F.struct(*fields)

    columns = ["column_name", "data_type", "row_count", "missing_count", "distinct_count", "min_value", "max_value"]
    summary = (
        df.agg(F.array(*[record(c) for c in df.columns]).alias("records"))
        .select(F.inline("records"))
    )
    if not exact_distinct:
        return summary.select(*columns)
    def text(name: str):
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            # 0.0 and -0.0 are one value.
            value = F.when(value == 0, F.lit(0.0).cast(df.schema[name].dataType)).otherwise(value)
        return value.cast("string")

    values = df.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in df.columns
            ])
        ).alias("cell")
    ).select("cell.column_name", "cell.value")
    distinct = (
        values.where(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.lit(1).alias("one"))
        .groupBy("column_name").agg(F.count("one").alias("distinct_count"))
    )
    return (
        summary.join(distinct, "column_name", "left")
        .withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)).cast("long"))
        .select(*columns)
    )
