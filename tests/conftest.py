import pytest

from lamina.session import build_session, fresh_folder
from lamina.sources.store import Store

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", {"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    return Store(spark, fresh_folder(spark, "test"), user_buckets=4)
