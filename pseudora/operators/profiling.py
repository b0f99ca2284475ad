"""Column profiles of whole tables in one pass.

The table is unpivoted to (column, value) and counted per distinct value. That one shuffle, which
combines on the map side, feeds both the statistics and the sample values: whatever the number of
columns, the source is scanned once and no task ever holds the distinct values of a column.

Long values are shuffled as their first characters, length and a digest, so what moves does not
depend on how long texts are. Only if some of a column's smallest values are long are these few
fetched: by a second scan of such columns, in which each task keeps the smallest of those that begin
like them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    MapType,
    StringType,
    StructType,
    TimestampType,
    VariantType,
)

from pseudora.functions.hashing import quoted
from pseudora.functions.naming import infer_simple_type
from pseudora.operators.bronze import timestamp_column
from pseudora.plans.together import run_together
from pseudora.sources.tables import write_table

SAMPLE_SIZE = 5
SAMPLE_SEPARATOR = " | "
HEAD = 64  # characters of a value that are shuffled as they are
CELLS_PER_TASK = 2_000_000  # values that one task counts, whatever files and row groups the rows come from
_ZERO = "0.0"
_WIDE = (StringType, BinaryType, ArrayType, StructType, MapType, VariantType)


@dataclass(frozen=True)
class SourceTableSpec:
    source_system: str
    table_name: str
    full_table_name: str


def _exact_text(name: str, kind: DataType) -> Column:
    """A text per value: equal for equal values only, whatever their printed form.

    Printed instants hide the offset of repeated hours, printed arrays and maps the bounds of their
    parts, and zeros of either sign are equal.
    """
    value = quoted(name)
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, (ArrayType, StructType, MapType, VariantType)):
        return F.to_json(F.struct(value.alias("v")))
    if isinstance(kind, (FloatType, DoubleType)):
        return F.when(value == 0, F.lit(_ZERO)).otherwise(value.cast("string"))
    if isinstance(kind, BinaryType):
        return F.hex(value)
    return value.cast("string")


def value_counts(df: DataFrame, columns: Sequence[str], cells_per_task: int = CELLS_PER_TASK) -> DataFrame:
    """(place, value, exact, size, value_count): each distinct value of a column, NULL included.

    ``value`` is the printed text. Of a long one it is the first ``HEAD`` characters and a digest,
    and ``size`` its length. ``exact`` differs for differing values that print alike. Rows of large
    tables are dealt by content, shortened so, to tasks that count a bounded number of values.
    """
    # Texts first, what is taken of them after that, so that none is made twice.
    texts, cells = [], []
    for i, name in enumerate(columns):
        kind = df.schema[name].dataType
        plain = isinstance(kind, (StringType, IntegralType, DecimalType, DateType, BooleanType))
        texts.append(quoted(name).cast("string").alias(f"t{i}"))
        if not plain:
            texts.append(_exact_text(name, kind).alias(f"e{i}"))
        text, exact, size = f"t{i}", "CAST(NULL AS STRING)" if plain else f"e{i}", "CAST(NULL AS INT)"
        if isinstance(kind, _WIDE):
            size = f"IF(length({text}) > {HEAD}, length({text}), NULL)"
            if not plain:
                exact = f"IF(length({exact}) > {HEAD}, left(sha2({exact}, 256), 32), {exact})"
            text = f"IF(length({text}) > {HEAD}, concat(left({text}, {HEAD}), left(sha2({text}, 256), 32)), {text})"
        cells.append(f"struct('c{i}' AS place, {text} AS value, {exact} AS exact, {size} AS size) AS v{i}")
    wide = df.select(*texts).selectExpr(*cells)
    tasks = -(-df.count() * len(columns) // cells_per_task)
    if tasks > 1:
        wide = wide.repartition(tasks, F.xxhash64(*wide.columns))
    long_form = wide.select(F.inline(F.array(*wide.columns)))
    return long_form.groupBy("place", "value", "exact", "size").agg(F.count(F.lit(1)).alias("value_count"))


def _column_list(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(f"c{i}").alias("place"), F.lit(name).alias("column_name"))
        for i, name in enumerate(columns)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def column_statistics(counts: DataFrame) -> DataFrame:
    """Row, NULL, distinct and length statistics per column."""
    size = F.coalesce("size", F.length("value"))
    weight = F.col("value_count")
    has_value = F.col("value").isNotNull()
    # The zeros of either sign print differently, yet are one value.
    zeros = F.count(F.when(F.col("exact") == _ZERO, 1))
    return counts.groupBy("place").agg(
        F.sum(weight).alias("row_count"),
        F.sum(F.when(has_value, F.lit(0)).otherwise(weight)).alias("null_count"),
        (F.count("value") - F.greatest(zeros - 1, F.lit(0))).alias("distinct_values"),
        F.min(size).alias("min_length"),
        F.max(size).alias("max_length"),
        F.try_divide(F.sum(size * weight), F.sum(F.when(has_value, weight))).alias("avg_length"),
    )


def smallest_heads(counts: DataFrame) -> DataFrame:
    """(place, samples, long_heads): the smallest distinct heads of each column.

    Among them are the heads of its smallest values. ``samples`` are those of short values, which
    are the values, ``long_heads`` those of long ones. The rank filter is applied before the shuffle
    too, so at most a few heads per column and partition move. NULL ranks last and is skipped when
    the values are collected; were it, or the counts, left out earlier, the optimizer would scan and
    count a second time for this branch instead of reading the shuffled counts of the statistics
    again.
    """
    smallest = Window.partitionBy("place").orderBy(F.col("head").asc_nulls_last())
    is_long = F.col("size").isNotNull()
    return (
        counts.where(F.col("value_count") > 0)
        .withColumn("head", F.left("value", F.lit(HEAD)))
        .withColumn("rank", F.dense_rank().over(smallest))
        .where(F.col("rank") <= SAMPLE_SIZE)
        .groupBy("place")
        .agg(
            F.array_sort(F.collect_set(F.when(~is_long, F.col("head")))).alias("samples"),
            F.array_sort(F.collect_set(F.when(is_long, F.col("head")))).alias("long_heads"),
        )
    )


def _smallest_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest distinct texts of each column in a partition, held as the pass goes on."""
    kept: dict[str, set[bytes]] = {}
    for batch in batches:
        for place, text in zip(batch.column("place"), batch.column("value"), strict=True):
            best = kept.setdefault(place.as_py(), set())
            best.add(text.as_py())
            if len(best) > 4 * SAMPLE_SIZE:
                kept[place.as_py()] = set(sorted(best)[:SAMPLE_SIZE])
    rows = [(place, text) for place, best in kept.items() for text in sorted(best)[:SAMPLE_SIZE]]
    if rows:
        places, texts = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(texts, pa.binary())], names=["place", "value"])


def long_samples(df: DataFrame, columns: Sequence[str], heads: dict[str, list[str]]) -> DataFrame:
    """(place, long_samples): the smallest long values that begin with one of a column's heads."""
    cells = []
    for i, name in enumerate(columns):
        if wanted := heads.get(f"c{i}"):
            text = quoted(name).cast("string")
            fits = (F.length(text) > HEAD) & F.substring(text, 1, HEAD).isin(wanted)
            cells.append(F.struct(F.lit(f"c{i}").alias("place"), F.when(fits, text.cast("binary")).alias("value")))
    texts = df.select(F.inline(F.array(*cells))).where("value IS NOT NULL")
    few = texts.mapInArrow(_smallest_texts, "place string, value binary").distinct()
    smallest = Window.partitionBy("place").orderBy("value")
    few = few.withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= SAMPLE_SIZE)
    return few.groupBy("place").agg(F.collect_list(F.col("value").cast("string")).alias("long_samples"))


def _with_samples(df: DataFrame, columns: Sequence[str], found: DataFrame) -> DataFrame:
    """Statistics with the sample values joined; long ones are fetched where there are any."""
    if any(isinstance(df.schema[name].dataType, _WIDE) for name in columns):
        # At most a row per column, and a few heads in each.
        rows = found.collect()
        found = df.sparkSession.createDataFrame(rows, found.schema)
        heads = {row["place"]: row["long_heads"] for row in rows if row["long_heads"]}
        if heads:
            found = found.join(long_samples(df, columns, heads), "place", "left")
            every = F.array_union("samples", F.coalesce("long_samples", F.array().cast("array<string>")))
            found = found.withColumn("samples", F.slice(F.array_sort(every), 1, SAMPLE_SIZE))
    return found.withColumn("sample_values", F.array_join("samples", SAMPLE_SEPARATOR))


def profile_columns(
    df: DataFrame,
    *,
    source_system: str,
    table_name: str,
    columns: Sequence[str],
    batch_id: str,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One profile row per named column."""
    counts = value_counts(df, columns)
    # Both sides below have one row per column of the table.
    stats = column_statistics(counts).join(smallest_heads(counts), "place", "left")
    stats = _with_samples(df, columns, stats)
    profile = _column_list(df, columns).join(stats, "place", "left")
    distinct = F.col("distinct_values")
    return profile.select(
        F.lit(source_system).alias("source_system"),
        F.lit(table_name).alias("table_name"),
        "column_name",
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
        "null_count",
        F.try_divide("null_count", "row_count").alias("null_rate"),
        F.coalesce(distinct, F.lit(0).cast("bigint")).alias("distinct_count"),
        F.try_divide(distinct, F.col("row_count")).alias("distinct_rate"),
        "min_length",
        "max_length",
        "avg_length",
        F.coalesce("sample_values", F.lit("")).alias("sample_values"),
        infer_simple_type(F.col("column_name")).alias("inferred_type"),
        timestamp_column(run_ts).alias("profiled_at"),
        F.lit(batch_id).alias("batch_id"),
    )


def profile_column(
    *,
    df: DataFrame,
    source_system: str,
    table_name: str,
    column_name: str,
    batch_id: str,
    run_ts: datetime | None = None,
) -> DataFrame:
    return profile_columns(
        df,
        source_system=source_system,
        table_name=table_name,
        columns=[column_name],
        batch_id=batch_id,
        run_ts=run_ts,
    )


def profile_table(
    *, spark: SparkSession, spec: SourceTableSpec, batch_id: str, run_ts: datetime | None = None
) -> DataFrame:
    """Profile of every column of a catalog table, technical columns included."""
    df = spark.table(spec.full_table_name)
    if not df.columns:
        raise ValueError(f"no columns to profile in {spec.full_table_name}")
    return profile_columns(
        df,
        source_system=spec.source_system,
        table_name=spec.table_name,
        columns=df.columns,
        batch_id=batch_id,
        run_ts=run_ts,
    )


def profile_sources(
    *,
    spark: SparkSession,
    specs: Sequence[SourceTableSpec],
    target_table: str,
    batch_id: str,
    run_ts: datetime | None = None,
    table_format: str = "parquet",
) -> DataFrame:
    """Profiles of several tables, written to one and read back."""
    if not specs:
        raise ValueError("no tables to profile")
    profiles = run_together(
        spark,
        [partial(profile_table, spark=spark, spec=spec, batch_id=batch_id, run_ts=run_ts) for spec in specs],
    )
    return write_table(
        reduce(DataFrame.unionByName, profiles), target_table, table_format=table_format
    )
