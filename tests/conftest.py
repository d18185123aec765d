import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def paged(spark):
    """``paged(column_function, html)``: the function applied to one page whose tags are paired."""
    from pyspark.sql import functions as F

    from showloom.functions import html as H

    def of(fn, given):
        one = spark.createDataFrame([(given,)], "c string").select(H.page(F.col("c")).alias("c"))
        return one.select(fn(F.col("c")).alias("v")).first()["v"]

    return of


@pytest.fixture
def value(spark):
    """``value(column_function, text)``: the function applied to one value."""
    from pyspark.sql import functions as F

    def of(fn, given, type_="string"):
        one = spark.createDataFrame([(given,)], f"c {type_}")
        return one.select(fn(F.col("c")).alias("v")).first()["v"]

    return of
