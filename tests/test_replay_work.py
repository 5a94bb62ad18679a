"""What a delivery costs must not wait for one task, nor be done twice."""

from lamina.plans import batch_run, bronze
from lamina.schemas import HASH_SUM, USER_ACTIVITY, QUARANTINE_EVENTS
from lamina.sources.store import Store
from pyspark.sql import functions as F
from tests.helpers import content, raw_rows

DAY = "batch_2024-01-01"


def test_a_delivery_is_written_by_several_tasks(spark, store):
    empty = spark.createDataFrame([], QUARANTINE_EVENTS.schema)
    rows = spark.range(400_000).select(
        F.lit(DAY).alias("batch_id"), F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema if f.name not in ("batch_id", "event_id")],
    )
    store.publish(QUARANTINE_EVENTS, rows, [(DAY,)], [(DAY,)])
    stored = store.read(QUARANTINE_EVENTS)
    assert len(stored.inputFiles()) > 1
    assert stored.select("event_id").distinct().count() == 400_000


def test_partitions_without_rows_are_not_noted(spark, store):
    rows = spark.createDataFrame([], QUARANTINE_EVENTS.schema)
    store.publish(QUARANTINE_EVENTS, rows, [(DAY,)], [(DAY,)])
    assert store.partitions(QUARANTINE_EVENTS) == {}
    assert store.read(QUARANTINE_EVENTS).count() == 0


def test_hash_sums_are_exact(spark):
    hashes = [-(2**63), -(2**63), -(2**63) + 1, -1, 0, 1, 2**21, -(2**42) - 5, 2**63 - 1]
    found = spark.createDataFrame([(h,) for h in hashes], "h long").agg(bronze._hash_sum(F.col("h")).alias("s"))
    assert found.schema["s"].dataType == HASH_SUM
    assert int(found.first()["s"]) == sum(hashes)


def test_facts_and_activity_are_written_once(spark, store, monkeypatch):
    steps, staged = [], Store.staged
    monkeypatch.setattr(Store, "staged", lambda self, batch, step, df: steps.append(step) or staged(self, batch, step, df))
    rows = raw_rows(spark, ("e1", "ann", "view", "web", 1.0, "2024-01-01 10:00", DAY), ("e2", "bob", "view", "web", 2.0, "2024-01-01 11:00", DAY))
    assert batch_run.run_batch(store, rows, DAY)["silver_rows"] == 2
    assert not {"facts", "activity"} & set(steps)
    held = store.read(USER_ACTIVITY).select("user_name", "applied_batch", "n")
    assert content(held) == content(spark.createDataFrame([("ann", DAY, 1), ("bob", DAY, 1)], "user_name string, applied_batch string, n long"))
