"""Merge rows into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_by_key(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`target` with `rows` put in: same key replaces, new key adds.

    A key that appears twice in `rows` fails the job, as there is no right winner. Both sides meet in one grouping by key,
    so each is computed once; NULL keys are equal to each other.
    """
    keys = list(keys)
    both = target.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    merged = both.groupBy(*keys).agg(
        *[F.max_by(c, "_new").alias(c) for c in target.columns if c not in keys], F.sum("_new").alias("_copies")
    )
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    twice = F.raise_error(F.concat(F.lit("upsert got a key twice: "), named)).cast("boolean")
    return merged.where(F.when(F.col("_copies") > 1, twice).otherwise(F.lit(True))).select(*target.columns)
