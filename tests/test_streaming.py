"""Deliveries as files through a streaming query."""

import pytest

from lamina.plans import gold, silver
from lamina.schemas import PIPELINE_RUNS, RPT_DAILY_SUMMARY, STG_EVENTS
from lamina.session import fresh_folder
from lamina.streaming import feed
from tests.helpers import RAW, content
from tests.test_batch_run import D1, D2, LAST, feed_of


def test_files_in_steps(spark, store):
    folder, checkpoint = fresh_folder(spark, "source"), fresh_folder(spark, "checkpoint")

    def arrive(*batches):
        feed_of(spark, *batches).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(RAW).parquet(folder)
        feed.start(store, source, checkpoint).awaitTermination()

    arrive(D1)
    arrive(D2, LAST)
    expected = gold.daily_kpis(silver.facts_from_raw(feed_of(spark, D1, D2, LAST)))
    assert content(store.read(RPT_DAILY_SUMMARY), "_updated_at") == content(expected)
    assert store.read_latest(PIPELINE_RUNS).count() == 3

    # A repeated micro-batch changes nothing; a delivery that grew is refused.
    handle = feed.apply_micro_batch(store)
    handle(feed_of(spark, D1), 7)
    assert store.read(STG_EVENTS).count() == 12
    with pytest.raises(feed.SplitDelivery):
        handle(feed_of(spark, D1).union(feed_of(spark, D1).limit(1)), 8)
