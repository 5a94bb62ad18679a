"""The job script from text files to tables."""

from pyspark.sql import functions as F

from jobs import apply_deliveries
from lamina.plans import gold, silver
from lamina.schemas import RPT_DAILY_SUMMARY, TABLE_REGISTRY, TABLES
from lamina.session import fresh_folder
from lamina.sources.store import Store
from tests.helpers import content
from tests.test_batch_run import D1, LAST, feed_of


def test_csv(spark):
    folder = fresh_folder(spark, "job")
    rows = feed_of(spark, D1, LAST)
    as_text = rows.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    as_text.write.option("header", "true").csv(f"{folder}/source")
    arguments = ["--root", f"{folder}/tables", "--source", f"{folder}/source", "--format", "csv"]
    apply_deliveries.run(spark, apply_deliveries.parse([*arguments, "--register", "job_"]))
    store = Store(spark, f"{folder}/tables")
    expected = content(gold.daily_kpis(silver.facts_from_raw(rows)))
    assert content(store.read(RPT_DAILY_SUMMARY), "_updated_at") == expected
    assert content(spark.table("job_gold.rpt_daily_summary"), "_updated_at") == expected
    assert store.read(TABLE_REGISTRY).count() == len(TABLES)
