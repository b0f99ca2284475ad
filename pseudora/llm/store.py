"""Intermediate tables of one query in the shared folder, which cut lineage for good."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pseudora.sources.tables import shared_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, with the schema it had."""
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    session = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = session._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
