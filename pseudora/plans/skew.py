"""Left joins whose keys may be badly skewed, and size-checked broadcast lookups.

One customer id, mailbox or data set may hold a third of all rows on either side of a join, and
AQE splits skewed partitions neither on the right side of a left join nor in a chain of joins that
share one shuffle. So keys are spread by construction: a key with more than ``rows_per_task`` rows
is cut into a grid of cells, ``left cells x right cells``. A left row draws its own left cell and
is copied to all right cells, a right row the other way round, so that each pair of rows meets in
exactly one cell. All other keys have a single cell and are copied nowhere.

Heavy keys are found by a mergeable sketch of key hashes, whose size does not depend on the data. It
is evaluated once for both sides, over the key columns alone and without a shuffle of keys; tables
that were measured while they were written (``measured``) are not read for it at all. The sketch
finds every key with more than about ``1 / 5000`` of a side's rows. It steers the spreading only:
keys that share a hash, or a sketch of older data, change no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

ROWS_PER_TASK = 2_000_000
LOOKUP_MAX_ROWS = 200_000
LOOKUP_MAX_CHARS = 32_000_000
SKETCHED_KEYS = 10_000  # tracked by the sketch; its error is about 2 / SKETCHED_KEYS of the rows
HEAVY_MOST = 1_000  # keys that a sketch reports

_LEFT_PARTS, _RIGHT_PARTS = "_left_parts", "_right_parts"
_LEFT_CELL, _RIGHT_CELL = "_left_cell", "_right_cell"
_HIT, _HASH = "_hit", "_key_hash"
_GRID = StructType(
    [StructField(_HASH, LongType()), StructField(_LEFT_PARTS, IntegerType()), StructField(_RIGHT_PARTS, IntegerType())]
)

#: Estimated rows of the most frequent keys, by hash.
KeyCounts = Mapping[int, int]


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])


def key_hash(keys: Sequence[Column]) -> Column:
    """Hash of a key; NULL where a part is missing."""
    return F.when(reduce(Column.__and__, [key.isNotNull() for key in keys]), F.xxhash64(*keys))


def _sketch(hashed: Column) -> Column:
    return F.call_function("approx_top_k", hashed, F.lit(HEAVY_MOST), F.lit(SKETCHED_KEYS))


def _counts(items) -> dict[int, int]:
    return {item["item"]: item["count"] for item in items or () if item["item"] is not None}


def measured(df: DataFrame, keys: Sequence[Column]) -> tuple[DataFrame, Callable[[], KeyCounts]]:
    """``df`` with a sketch of the keys that is filled while it is written, and its reader."""
    seen = Observation()
    observed = df.observe(seen, _sketch(key_hash(keys)).alias("keys"))
    return observed, lambda: _counts(seen.get["keys"])


def count_keys(sides: Sequence[DataFrame]) -> list[KeyCounts]:
    """The most frequent of the hashes, the only column of each side, in one job for all sides."""
    hashes = [side.select(F.lit(k).alias("side"), F.col(side.columns[0]).alias(_HASH)) for k, side in enumerate(sides)]
    found = reduce(DataFrame.unionByName, hashes).groupBy("side").agg(_sketch(F.col(_HASH)).alias("keys"))
    by_side = {row["side"]: _counts(row["keys"]) for row in found.collect()}
    return [by_side.get(k, {}) for k in range(len(sides))]


def heavy_grid(left: KeyCounts, right: KeyCounts, rows_per_task: int) -> dict[int, tuple[int, int]]:
    """Left and right parts of each key that has more than ``rows_per_task`` rows on a side."""

    def parts(counts: KeyCounts, key: int) -> int:
        return max(1, -(-counts.get(key, 0) // rows_per_task))

    grid = {key: (parts(left, key), parts(right, key)) for key in {*left, *right}}
    return {key: cut for key, cut in grid.items() if cut != (1, 1)}


def _with_parts(df: DataFrame, grid: DataFrame, hashed: Column) -> DataFrame:
    return df.withColumn(_HASH, hashed).join(grid, _HASH, "left").drop(_HASH).withColumns(
        {name: F.coalesce(F.col(name), F.lit(1)) for name in (_LEFT_PARTS, _RIGHT_PARTS)}
    )


def _own_cell(parts: Column, spread_by: Column | None) -> Column:
    by = F.monotonically_increasing_id() if spread_by is None else spread_by
    return F.pmod(by, parts).cast("int")


def _every_cell(parts: str) -> Column:
    # The constant array for the common single cell costs next to nothing per row.
    cells = F.sequence(F.lit(0), F.col(parts) - 1)
    return F.explode(F.when(F.col(parts) == 1, F.array(F.lit(0))).otherwise(cells))


def _plain_left_join(
    left: DataFrame, keys: list[str], sides: Sequence[DataFrame], spread_by: Column | None, spread: int
) -> DataFrame:
    """The join where no key is heavy: only rows with a NULL key are dealt to cells."""
    columns = [*left.columns, *[name for side in sides for name in side.columns if name not in keys]]
    own = F.when(keys_present(keys), F.lit(0)).otherwise(_own_cell(F.lit(spread), spread_by))
    result = left.withColumn(_LEFT_CELL, own)
    # Always 0, yet no constant: that would be folded into the join and the cells would be lost.
    only = F.pmod(F.hash(*keys), F.lit(1))
    for side in sides:
        right = side.where(keys_present(keys)).withColumn(_LEFT_CELL, only)
        result = result.join(right, [*keys, _LEFT_CELL], "left")
    return result.select(*columns)


def spread_left_join(
    left: DataFrame,
    keys: Sequence[str],
    *,
    many: DataFrame | None = None,
    unique: Iterable[DataFrame] = (),
    left_spread_by: Column | None = None,
    many_spread_by: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    left_counts: KeyCounts | None = None,
    many_counts: KeyCounts | None = None,
    grid: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``left`` LEFT JOIN ``many`` LEFT JOIN each of ``unique``, all on the same keys.

    ``many`` may repeat keys (the join fans out); each ``unique`` side holds a key at most once.
    All joins use the same columns, so ``left`` is shuffled once. Rows with a NULL key match
    nothing; they are spread evenly instead of meeting in one partition.

    Rows of a heavy key are dealt to cells by their position in the scan, which spreads exact
    copies too. That needs an input that comes straight from storage: only then does a task that
    is run again after a lost executor deal the same cells. Where a side has been shuffled before,
    pass an integer over its content as ``left_spread_by`` or ``many_spread_by`` instead.

    Sides whose key counts are not given are sketched here, in one job. Callers that have counted
    all keys pass a stored ``grid`` (hash, left and right parts) instead. With it, ``partitions`` sets
    the tasks of the join, for sides that are small beside what they yield.
    """
    keys = list(keys)
    columns = [*left.columns]
    # Equal keys of other types must have equal hashes.
    hashed = key_hash([F.col(key).cast(left.schema[key].dataType) for key in keys])
    if grid is None:
        unknown = [
            side.select(hashed.alias(_HASH))
            for side, counts in ((left, left_counts), (many, many_counts))
            if side is not None and counts is None
        ]
        found = iter(count_keys(unknown)) if unknown else iter(())
        of_left = next(found) if left_counts is None else left_counts
        of_many = {} if many is None else next(found) if many_counts is None else many_counts
        cut = heavy_grid(of_left, of_many, rows_per_task)
        # At most twice HEAVY_MOST rows, hence the hint.
        rows = [(key, *parts) for key, parts in sorted(cut.items())]
        grid = F.broadcast(left.sparkSession.createDataFrame(rows, _GRID)) if rows else None
    spread = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if grid is None:
        return _plain_left_join(left, keys, [*([] if many is None else [many]), *unique], left_spread_by, spread)
    cells = [*keys, _LEFT_CELL, _RIGHT_CELL]

    left_parts = F.when(keys_present(keys), F.col(_LEFT_PARTS)).otherwise(spread)
    result = _with_parts(left, grid, hashed).withColumn(
        _LEFT_CELL, _own_cell(left_parts, left_spread_by)
    )
    result = result.withColumn(_RIGHT_CELL, _every_cell(_RIGHT_PARTS)).drop(_LEFT_PARTS)

    def dealt(df: DataFrame) -> DataFrame:
        return df if partitions is None else df.repartition(partitions, *cells)

    result = dealt(result)
    if many is not None:
        right = _with_parts(many.where(keys_present(keys)), grid, hashed)
        right = right.withColumn(
            _RIGHT_CELL, _own_cell(F.col(_RIGHT_PARTS), many_spread_by)
        )
        right = right.withColumn(_LEFT_CELL, _every_cell(_LEFT_PARTS))
        right = right.drop(_LEFT_PARTS, _RIGHT_PARTS).withColumn(_HIT, F.lit(True))
        right = dealt(right)
        columns += [name for name in many.columns if name not in keys]
        # A key cut on the right exists there, so its rows without a partner are copies that
        # found their cell empty, not unmatched rows.
        result = result.join(right, cells, "left").where(
            F.col(_HIT).isNotNull() | (F.col(_RIGHT_PARTS) == 1)
        )

    for side in unique:
        right = _with_parts(side.where(keys_present(keys)), grid, hashed)
        right = right.withColumn(_LEFT_CELL, _every_cell(_LEFT_PARTS))
        right = right.withColumn(_RIGHT_CELL, _every_cell(_RIGHT_PARTS))
        columns += [name for name in side.columns if name not in keys]
        result = result.join(dealt(right.drop(_LEFT_PARTS, _RIGHT_PARTS)), cells, "left")

    return result.select(*columns)


def fits_broadcast(
    df: DataFrame, *, max_rows: int = LOOKUP_MAX_ROWS, max_chars: int = LOOKUP_MAX_CHARS
) -> bool:
    """Measure a side before broadcasting it: one aggregate, one row per partition moves."""
    size = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("chars"),
    ).first()
    return size["rows"] <= max_rows and size["chars"] <= max_chars


def lookup_left_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    left_spread_by: Column | None = None,
    max_rows: int = LOOKUP_MAX_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join with a table that is normally tiny: broadcast if it measures small, else spread.

    Beyond the limit it is a spread join: a lookup row is copied only if its key is heavy on the
    left, and to no more cells than that key's rows fill. ``counted`` holds the left side's keys
    before joins that made it dear to compute; it is sketched in its place.

    Rows are dealt by ``left_spread_by``, an integer that a task run again computes alike; without
    it by a hash of the row's content.
    """
    keys = list(keys)
    if fits_broadcast(lookup, max_rows=max_rows):
        return left.join(F.broadcast(lookup), keys, "left")
    counts = None
    if counted is not None:
        hashed = key_hash([F.col(key).cast(left.schema[key].dataType) for key in keys])
        (counts,) = count_keys([counted.select(hashed.alias(_HASH))])
    by = F.xxhash64(*left.columns) if left_spread_by is None else F.xxhash64(left_spread_by)
    return spread_left_join(
        left,
        keys,
        many=lookup,
        left_spread_by=by,
        many_spread_by=F.xxhash64(*lookup.columns),
        rows_per_task=rows_per_task,
        left_counts=counts,
    )
