"""Deliveries arriving as files, applied by a streaming query.

No watermark is needed: all state lives in the tables, and late or corrected
events recompute the days they touch, however old. One query is one writer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lamina.plans import bronze
from lamina.plans.batch_run import apply_batch, place
from lamina.plans.bronze import SplitDelivery
from lamina.session import now
from lamina.sources.event_feed import delivery_time
from lamina.sources.store import Store

__all__ = ["SplitDelivery", "apply_micro_batch", "start"]


def apply_micro_batch(store: Store, batch_time: Callable[[Column], Column] = delivery_time):
    """Handler for foreachBatch: stores the deliveries of the micro-batch and applies them in order.

    A micro-batch that is repeated after a failure finds its deliveries stored and goes on from
    there. A stored delivery that comes again with another number of rows was split
    by the source, which would lose rows, so that fails.
    """
    def handle(rows: DataFrame, _epoch: int) -> None:
        bronze.ingest(store, rows, now())
        for row in rows.select("batch_id").distinct().orderBy(place(batch_time, F.col("batch_id"))).collect():
            apply_batch(store, row["batch_id"], batch_time)

    return handle


def start(
    store: Store, feed: DataFrame, checkpoint: str, batch_time: Callable[[Column], Column] = delivery_time
) -> StreamingQuery:
    """Work off what has arrived, then stop; started again it goes on where it stopped."""
    return (
        feed.writeStream.foreachBatch(apply_micro_batch(store, batch_time))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
