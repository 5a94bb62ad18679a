"""Apply raw deliveries to a store.

    spark-submit jobs/apply_deliveries.py --root <folder> --source <folder> [--format parquet|json|csv|orc]
                                          [--stream <checkpoint folder>] [--user-buckets N] [--register PREFIX]

The source holds rows of event_id, user_name, category, source, value, event_time
(timestamp, or text as 2024-01-31 23:59:59) and batch_id. Rows whose time or value can't be read are set aside. Without --stream all new deliveries are applied once;
with it only files that arrived since the last call are read.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import types as T  # noqa: E402

from lamina.plans import batch_run  # noqa: E402
from lamina.schemas import RAW_COLUMNS  # noqa: E402
from lamina.session import build_session  # noqa: E402
from lamina.sources.store import Store  # noqa: E402
from lamina.streaming import feed  # noqa: E402

TEXT = {"json", "csv"}


def raw_schema(file_format: str) -> T.StructType:
    def stored_as(name: str, dtype: T.DataType) -> T.DataType:
        return T.StringType() if name in ("event_time", "value") and file_format in TEXT else dtype

    fields = [T.StructField(name, stored_as(name, dtype)) for name, dtype, _ in RAW_COLUMNS]
    # Where the reader puts a line it can't read; it is set aside with its delivery, if it names one.
    return T.StructType(fields + [T.StructField("_corrupt_record", T.StringType())] * (file_format in TEXT))


def run(spark, arguments: argparse.Namespace) -> None:
    store = Store(spark, arguments.root, arguments.user_buckets)
    batch_run.setup(store)
    reader = spark.readStream if arguments.stream else spark.read
    reader = reader.format(arguments.format).schema(raw_schema(arguments.format))
    if arguments.format == "csv":
        reader = reader.option("header", "true")
    rows = reader.load(arguments.source)
    if arguments.stream:
        feed.start(store, rows, arguments.stream).awaitTermination()
    else:
        batch_run.replay(store, rows)
    if arguments.register is not None:
        store.register_tables(arguments.register)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--root", required=True)
    parser.add_argument("--source", required=True)
    parser.add_argument("--format", default="parquet", choices=["parquet", "json", "csv", "orc"])
    parser.add_argument("--stream")
    parser.add_argument("--user-buckets", type=int)
    parser.add_argument("--register", nargs="?", const="")
    return parser.parse_args(argv)


if __name__ == "__main__":
    run(build_session("apply_deliveries"), parse())
