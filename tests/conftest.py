import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

SF = "/root/testdata/sf0.001"
START = dt.date(2021, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def pipeline(spark):
    from tidemark.plans.queries import pipeline_for

    return pipeline_for(spark, SF)


def day(n: int) -> dt.date:
    """The n-th day (from 1) of the fixtures' calendar."""
    return START + dt.timedelta(days=n - 1)


def daily(spark, values, column="v", series="A", kind="bigint"):
    """A series with one value per day from day 1."""
    rows = [(series, day(i), v) for i, v in enumerate(values, start=1)]
    return spark.createDataFrame(rows, f"country_region string, date date, {column} {kind}")


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("country_region", "date"))).collect()]
