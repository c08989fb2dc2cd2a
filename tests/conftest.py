import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("broadsheet-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def own_settings(spark):
    """What a query of an earlier test has set does not hold in the next."""
    from broadsheet.plans.session import SETTINGS

    for name in SETTINGS:
        spark.conf.unset(name)


@pytest.fixture
def frame(spark):
    """A frame from rows and a schema text."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples of the named columns."""

    def read(df, *columns):
        return sorted(tuple(r) for r in df.select(*columns).collect())

    return read


@pytest.fixture
def at():
    """Hours after the start of 2024, without a zone."""

    def time(hours):
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)

    return time
