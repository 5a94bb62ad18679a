"""Keys of the user dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end of validity of an open version.
OPEN_END = datetime(9999, 12, 31)


def user_key(user_name: Column, valid_from: Column) -> Column:
    return F.sha2(F.concat_ws("|", user_name, F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss")), 256)


def user_bucket(user_name: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user_name), F.lit(buckets)).cast("int")
