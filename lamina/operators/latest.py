"""Latest-wins: one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(
    df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """The row with the greatest `version` for every key.

    Equal versions are decided by `ties`, by default by all other columns, so the
    result never depends on row order. Few or narrow ties let Spark drop columns before the
    shuffle that the query doesn't need. Each key is limited to one row before that
    shuffle (WindowGroupLimit), so a key with very many copies sends one row per map task.
    """
    order = [F.col(version), *(ties or [c for c in df.columns if c not in keys and c != version])]
    newest = Window.partitionBy(*keys).orderBy(*[(F.col(c) if isinstance(c, str) else c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
