"""Sums of money that do not depend on how the rows are partitioned.

Adding doubles gives other last digits with every partitioning. Amounts are
therefore added as decimals with ten places, which also absorbs the noise of a
double around a two-place amount. What has no such decimal (NaN, infinity,
beyond 10^18) is added on the side as double, so that it still shows in the total.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PER_ROW = "decimal(28,10)"


def exact_part(value: Column) -> Column:
    return value.try_cast(_PER_ROW)


def rest_part(value: Column) -> Column:
    return F.when(exact_part(value).isNull(), value).otherwise(F.lit(0.0))


def money(exact_sum: Column, rest_sum: Column) -> Column:
    """The total as double from the two summed parts; no rows give 0."""
    return F.coalesce(exact_sum.cast("double"), F.lit(0.0)) + F.coalesce(rest_sum, F.lit(0.0))


def money_sum(value: Column) -> Column:
    return money(F.sum(exact_part(value)), F.sum(rest_part(value)))
