"""Catalog tables: write, list, and the shared folder for intermediate ones."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PLAIN_FORMATS = ("parquet", "orc", "csv", "json")
_NEXT, _REPLACES = "__next", "replaces"


def _in_schema(table: str) -> str:
    """Schema and name of a table, as catalog commands on the same catalog want them."""
    return ".".join(table.split(".")[-2:])


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def _removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _recovered(spark: SparkSession, table: str) -> None:
    """Finish a change of schema that was interrupted after the old table had gone."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}{_NEXT}"):
        _take_name(spark, table)


def _take_name(spark: SparkSession, table: str) -> None:
    """Give the complete next table its name.

    If it replaces one, a version of that one may be left where the table belongs by a write that
    was interrupted before it could remove it.
    """
    following = f"{table}{_NEXT}"
    if _property(spark, following, _REPLACES) is not None:
        _removed(spark, _location(spark, following).removesuffix(_NEXT))
        spark.sql(f"ALTER TABLE {following} UNSET TBLPROPERTIES ('{_REPLACES}')")
    spark.sql(f"ALTER TABLE {following} RENAME TO {_in_schema(table)}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table by name, also after a write of it that was interrupted at any step."""
    _recovered(spark, table)
    return spark.table(table)


def write_table(df: DataFrame, target_table: str, *, table_format: str = "parquet") -> DataFrame:
    """Replace data and schema of a managed table and return it read back from storage.

    A table of plain files gets a new folder for each version. When its files are complete, one
    change of the table's location makes them the table; until then readers see the old version,
    from then on the new one. Only if the schema changes must the old table be dropped first: then
    the complete new one stands under ``<name>__next`` and takes the name, which the next
    ``write_table`` or ``read_table`` does should this one be interrupted. Formats with a log replace
    tables by themselves. Readers of the result depend on the stored table only, not on the plan
    that made it.
    """
    spark = df.sparkSession
    options = {"overwriteSchema": "true"}
    if table_format not in PLAIN_FORMATS:
        df.write.format(table_format).mode("overwrite").options(**options).saveAsTable(target_table)
        return spark.table(target_table)
    _recovered(spark, target_table)
    following = f"{target_table}{_NEXT}"
    if not spark.catalog.tableExists(target_table):
        df.write.format(table_format).mode("overwrite").saveAsTable(following)
        _take_name(spark, target_table)
        return spark.table(target_table)
    old = _location(spark, target_table)
    current = spark.table(target_table)
    same = current.schema.simpleString() == df.schema.simpleString() and _provider(spark, target_table) == table_format
    if not same:
        df.write.format(table_format).mode("overwrite").saveAsTable(following)
        spark.sql(f"ALTER TABLE {following} SET TBLPROPERTIES ('{_REPLACES}' = '{target_table}')")
        spark.sql(f"DROP TABLE {target_table}")
        _take_name(spark, target_table)
        return spark.table(target_table)
    folder, name = old.rstrip("/").rsplit("/", 1)
    version = f"{folder}/{name.split('__v')[0]}__v{uuid.uuid4().hex}"
    df.write.format(table_format).save(version)
    spark.sql(f"ALTER TABLE {target_table} SET LOCATION '{version}'")
    spark.catalog.refreshTable(target_table)
    _removed(spark, old)
    return spark.table(target_table)


def _provider(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Provider'")
    return described.first()["data_type"].lower()


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).first()
    return None if found is None else found["value"]


def noted(spark: SparkSession, table: str, name: str) -> Mapping[int, int] | None:
    """Key counts that were noted at a table, or None."""
    found = _property(spark, table, name)
    return None if found is None else {int(key): count for key, count in json.loads(found).items()}


def note(spark: SparkSession, table: str, name: str, counts: Mapping[int, int], most: int = 64) -> None:
    """Note the most frequent keys at a table, for joins of later stages to plan by."""
    kept = dict(sorted(counts.items(), key=lambda item: -item[1])[:most])
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{json.dumps(kept)}')")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, with the schema it had; cuts lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_counted(df: DataFrame, name: str, *chars: str) -> tuple[DataFrame, int, int]:
    """``stored``, with the rows written and the characters in the columns named, counted on the way."""
    seen = Observation()
    sizes = [F.coalesce(F.sum(F.length(column)), F.lit(0)) for column in chars]
    written = stored(df.observe(seen, F.count(F.lit(1)).alias("rows"), sum(sizes, F.lit(0)).alias("chars")), name)
    return written, seen.get["rows"], seen.get["chars"]


def schema_inventory(spark: SparkSession, catalog: str) -> DataFrame:
    """Make a catalog the current one and list its schemas."""
    spark.catalog.setCurrentCatalog(catalog)
    return spark.sql("SHOW SCHEMAS")


def table_inventory(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of one schema as (namespace, table_name)."""
    listed = spark.sql(f"SHOW TABLES IN {schema}")
    return listed.where(~F.col("isTemporary")).select(
        "namespace", F.col("tableName").alias("table_name")
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that all nodes see, as named by the cluster in ``spark.checkpoint.dir``.

    A machine-local folder is made only for a session without executors on other machines.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pseudora-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/") + "/" + context.applicationId
