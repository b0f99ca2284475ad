from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def one_column(spark: SparkSession, values) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "v string")


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a Column function to texts; results in the order of the texts."""
    from pyspark.sql import functions as F

    def run(function, values):
        df = spark.createDataFrame(list(enumerate(values)), "n int, v string")
        rows = df.select("n", function(F.col("v")).alias("r")).collect()
        return [row.r for row in sorted(rows)]

    return run
