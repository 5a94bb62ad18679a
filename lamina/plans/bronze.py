"""Storing deliveries as they come, each exactly once."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.plans.silver import RAW_NAMES
from lamina.schemas import BATCH_LEDGER, HASH_SUM, STG_EVENTS
from lamina.sources.store import Store

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_CONTENT = ("row_count", "content_low", "content_high")
# A hash is added up in three parts of so many bits, so that the sums of 2^42 rows fit a LONG.
_PART_BITS = 21


class SplitDelivery(RuntimeError):
    """Another number of rows came for a delivery that was stored before."""


class ChangedDelivery(SplitDelivery):
    """As many rows came for a delivery as were stored before, but not the same ones."""


class IncompleteDelivery(RuntimeError):
    """What was stored of a delivery is not what came."""


def parsed(feed: DataFrame) -> DataFrame:
    """Rows with `event_time` as a timestamp and `value` as a number.

    Text that is neither stays with its row, as JSON by field in `_unreadable`, and so does the `_corrupt_record` of a reader; such
    rows are set aside later. Blank text counts as missing. A row that names no delivery fails the whole: it could be neither
    found again nor told from others.
    """
    nameless = F.raise_error(F.concat(F.lit("no batch_id in event "), F.coalesce("event_id", F.lit("")))).cast("string")
    named = F.when(F.coalesce(F.col("batch_id"), F.lit("")) == "", nameless).otherwise(F.col("batch_id"))

    def is_text(column: str) -> bool:
        return feed.schema[column].dataType.typeName() == "string"

    read = {
        "event_time": F.try_to_timestamp("event_time", F.lit(TIME_FORMAT)) if is_text("event_time") else F.col("event_time"),
        "value": F.col("value").try_cast("double") if is_text("value") else F.col("value"),
    }
    texts = [
        F.when((F.trim(c) != "") & read[c].isNull(), F.col(c)).alias(c) for c in read if is_text(c)
    ]
    if "_corrupt_record" in feed.columns:
        texts.append(F.col("_corrupt_record").alias("record"))
    unreadable = F.lit(None).cast("string")
    if texts:
        # Fields without a text are left out; a row without any is `{}`.
        unreadable = F.nullif(F.to_json(F.struct(*texts)), F.lit("{}"))
    return feed.select(
        *[named.alias(c) if c == "batch_id" else read.get(c, F.col(c)).alias(c) for c in RAW_NAMES], unreadable.alias("_unreadable")
    )


def _hash_sum(hashed: Column) -> Column:
    """The sum of 64-bit hashes. Adding LONGs costs a fraction of adding decimals for each row."""
    low = F.lit((1 << _PART_BITS) - 1).cast("long")
    parts = [hashed.bitwiseAND(low), F.shiftright(hashed, _PART_BITS).bitwiseAND(low), F.shiftright(hashed, 2 * _PART_BITS)]
    sums = [F.sum(part).cast("decimal(20,0)") * F.lit(1 << _PART_BITS * i).cast("decimal(13,0)") for i, part in enumerate(parts)]
    return (sums[0] + sums[1] + sums[2]).cast(HASH_SUM)


def content_of(rows: DataFrame) -> DataFrame:
    """(batch_id, row_count, content_low, content_high): what each delivery holds, whatever the order of its rows.

    Two sums of 64-bit hashes over all columns; equal rows count as often as they come.
    """
    columns = [part for c in (*RAW_NAMES, "_unreadable") for part in (F.col(c), F.col(c).isNull())]

    def total(*seed) -> Column:
        return _hash_sum(F.xxhash64(*seed, *columns))

    return rows.groupBy("batch_id").agg(
        F.count("*").alias("row_count"), total().alias("content_low"), total(F.lit("high")).alias("content_high")
    )


def stored_batches(store: Store) -> DataFrame:
    """(batch_id, row_count) of the deliveries stored whole. A folder alone may be what a lost run left."""
    return store.read(BATCH_LEDGER).select("batch_id", "row_count")


def new_rows(feed: DataFrame, known_batches: DataFrame) -> DataFrame:
    """Rows of deliveries that are not among the known ones."""
    return feed.join(known_batches, "batch_id", "left_anti").select(*feed.columns)


def _named(found: DataFrame) -> list[str]:
    return sorted(r["batch_id"] for r in found.select("batch_id").collect())


def verdicts(came: DataFrame, ledger: DataFrame) -> DataFrame:
    """(batch_id, verdict) of deliveries that came, by what the ledger holds of them: `new`, `same` rows in any order, `split` where their
    number differs, `changed` where only their content does. Ledgers from before contents were summed know the number alone."""
    known = ledger.select("batch_id", *[F.col(c).alias(f"known_{c}") for c in _CONTENT])
    alike = F.lit(True)
    for c in _CONTENT[1:]:
        alike = alike & (F.col(c).eqNullSafe(F.col(f"known_{c}")) | F.col(f"known_{c}").isNull())
    verdict = (
        F.when(F.col("known_row_count").isNull(), "new").when(F.col("row_count") != F.col("known_row_count"), "split")
        .when(alike, "same").otherwise("changed")
    )
    return came.join(known, "batch_id", "left").select("batch_id", verdict.alias("verdict"))


def ingest(store: Store, feed: DataFrame, at: datetime) -> None:
    """Store every delivery in `feed` that is not stored yet. A delivery comes whole or not at all.

    It counts as stored once it is in the ledger, which is committed together with its rows, when these are the ones that came. A delivery in the
    ledger that comes again with other rows is refused, as the difference would be lost without a word.
    """
    attempt = f"ingest-{uuid.uuid4().hex}"
    try:
        with store.transaction() as inner:
            _ingest(inner, attempt, parsed(feed), at)
    finally:
        store.clear_staging(attempt)


def _ingest(store: Store, attempt: str, raw: DataFrame, at: datetime) -> None:
    came = store.staged(attempt, "came", content_of(raw))
    judged = store.staged(attempt, "judged", verdicts(came, store.read(BATCH_LEDGER)))
    for verdict, error in (("split", SplitDelivery), ("changed", ChangedDelivery)):
        refused = _named(judged.where(F.col("verdict") == verdict))
        if refused:
            raise error(", ".join(refused))
    fresh = came.join(judged.where("verdict = 'new'"), "batch_id", "left_semi")
    names = [(b,) for b in _named(fresh)]
    if not names:
        return
    rows = raw.join(fresh.select("batch_id"), "batch_id", "left_semi").withColumn("_ingested_at", F.lit(at))
    store.publish(STG_EVENTS, rows, names, names)
    stored = content_of(store.read(STG_EVENTS, names))
    incomplete = _named(verdicts(fresh, stored).where("verdict <> 'same'"))
    if incomplete:
        raise IncompleteDelivery(", ".join(incomplete))
    store.append(BATCH_LEDGER, fresh.withColumn("_stored_at", F.lit(at)))
