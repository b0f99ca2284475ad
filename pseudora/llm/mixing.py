"""Mix sources to target weights with whole token blocks apportioned by highest quotients.

Targets: each source's weight share of the mix, stopped at ``cap`` times the source's size, the
excess reshared by weight. Blocks: every (source, shard) cell cuts its token stream, ``cap``
passes over its documents in a seeded order, into equal blocks. Seats: the Sainte-Laguë rule
gives sources, then the shards of each source, integer numbers of blocks in proportion to their
targets. Selection: each cell takes its quota of blocks, spread evenly from a seeded start.

Cells are cut by a hash of id and text, so a source that holds a third of all rows is worked on by
as many tasks as its words need, whatever ids its rows have; rows that repeat both very often are
dealt by their number in the stored sizes. Only ids, sizes and hashes are shuffled, never texts.

Defined results: a NULL text has size 0 and gives nothing; a NULL source is a source of its own,
ordered last; an empty table gives no rows; repeated rows are mixed each for itself; a source of
size 0 has target 0. Columns of the input other than those named are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pseudora.llm.store import shuffle_width, stored
from pseudora.plans.skew import count_keys

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
BLOCK_TOKENS = 64
SHARD_TOKENS = 2_000_000
HOT_ROWS = 10_000  # rows alike beyond this are dealt by their number
WORD = r"[^\x20\x09-\x0D]+"
_GRID = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add each row's position (from 0) in a total order, without sorting in one task.

    Range partitions are stored with their number, counted, and offset by the counts before them;
    the driver sees one count per partition.
    """
    spark = df.sparkSession
    parts = df.repartitionByRange(shuffle_width(spark), *order)
    parts = stored(parts.withColumn("_part", F.spark_partition_id()), "ranked")
    counts = sorted(map(tuple, parts.groupBy("_part").count().collect()))
    offsets, before = [], 0
    for part, rows in counts:
        offsets.append((part, before))
        before += rows
    offsets = spark.createDataFrame(offsets, "_part int, _before long")
    within = Window.partitionBy("_part").orderBy(*order)
    position = F.row_number().over(within) - 1 + F.col("_before")
    joined = parts.join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, position.cast("long")).drop("_part", "_before")


def with_targets(sources: DataFrame, *, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Add ``weight`` and ``target`` to stored rows (source, source_size, position).

    The water level is found by raising it until no further source stops at its cap; each round
    is one aggregate over the sources, and each but the last stops at least one more source.
    """
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int")
    )
    sources = sources.withColumn("weight", weight)
    most = F.col("source_size") * cap
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = -1.0, None
    while True:
        full = most <= F.col("weight") * level
        got = sources.agg(
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
            F.count(F.when(full, 1)).alias("stopped"),
        ).first()
        if got["stopped"] == stopped or not got["open"]:
            break
        stopped = got["stopped"]
        level = (share * total - got["taken"]) / got["open"]
    target = F.least(most.cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", target)


def apportioned(df: DataFrame, group: list[str], ties: list[str]) -> DataFrame:
    """Sainte-Laguë: turn ``votes`` into integer ``quota`` whose sum in each group is ``seats``.

    Rounding votes/divisor is the highest-quotient rule for the divisor that fills the seats. One
    aggregate tries many divisors at once and narrows the range; the few seats that are left go
    to the highest next quotients, equal ones in the order of ``ties``. Without a ``group`` all rows
    are one, however many, and no task sees them all.
    """

    def met(rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.join(side, group) if group else rows.crossJoin(F.broadcast(side))

    sums = df.groupBy(*group).agg(
        F.sum("votes").alias("_votes"), F.count(F.lit(1)).alias("_rows"), F.max("seats").alias("_seats")
    )
    slack = F.col("_rows") / (2 * F.greatest(F.col("_seats"), F.lit(1)))
    bounds = stored(
        sums.select(
            *group,
            F.when(F.col("_votes") > 0, F.col("_seats") / F.col("_votes")).otherwise(0.0).alias("_unit"),
            F.greatest(F.lit(0.0), 1 - slack).alias("_low"),
            (1 + slack).alias("_high"),
            "_rows",
        ),
        "divisors",
    )
    widest = bounds.agg(F.max("_rows")).first()[0] or 1
    step = (F.col("_high") - F.col("_low")) / _GRID
    fair = F.col("votes") * F.col("_unit")
    for _ in range(max(1, math.ceil(math.log(widest * 2, _GRID)))):
        tried = met(df, bounds).groupBy(*group, "_unit", "_low", "_high")
        at = [F.sum(F.floor(fair * (F.col("_low") + step * k) + 0.5)) for k in range(_GRID + 1)]
        fits = tried.agg(
            F.max("seats").alias("_seats"), *(a.alias(f"_sum{k}") for k, a in enumerate(at))
        )
        last = F.greatest(
            F.lit(0), *(F.when(F.col(f"_sum{k}") <= F.col("_seats"), k) for k in range(_GRID + 1))
        )
        bounds = stored(
            fits.select(
                *group,
                "_unit",
                (F.col("_low") + step * last).alias("_low"),
                (F.col("_low") + step * F.least(last + 1, F.lit(_GRID))).alias("_high"),
            ),
            "divisors",
        )
    base = met(df, bounds.select(*group, "_unit", "_low"))
    base = base.withColumn("_base", F.floor(fair * F.col("_low") + 0.5))
    base = base.withColumn("_quotient", F.col("votes") / (2 * F.col("_base") + 1))
    order = [F.desc("_quotient"), *map(F.asc_nulls_last, ties)]
    if group:
        parts = Window.partitionBy(*group)
        spare, rank = F.col("seats") - F.sum("_base").over(parts), F.row_number().over(parts.orderBy(*order))
        extra = base.withColumns({"_spare": spare, "_rank": rank})
    else:
        placed = ranked(base, order, "_place")
        extra = met(placed, placed.agg((F.max("seats") - F.sum("_base")).alias("_spare")))
        extra = extra.withColumn("_rank", F.col("_place") + 1).drop("_place")
    won = F.when((F.col("_rank") <= F.col("_spare")) & (F.col("votes") > 0), 1).otherwise(0)
    return extra.withColumn("quota", (F.col("_base") + won).cast("long")).drop(
        "_unit", "_low", "_base", "_spare", "_quotient", "_rank"
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights=WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, shard) for every row of ``docs``."""
    alike = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("alike")
    size = word_count(F.col("text")).alias("size")
    sized = docs.select("doc_id", "source", size, alike, F.monotonically_increasing_id().alias("number"))
    sized = stored(sized, "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = ranked(totals, [F.asc_nulls_last("source")], "position")
    sources = stored(
        with_targets(stored(listed, "sources"), weights=weights, share=share, cap=cap), "targets"
    )
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    shards = max(1, -(-words // shard_tokens))

    (often,) = count_keys([sized.select("alike")]) if shards > 1 else ({},)
    hot = [key for key, rows in sorted(often.items()) if rows > HOT_ROWS]
    dealt_by = F.when(F.col("alike").isin(hot), F.xxhash64("alike", "number")).otherwise(F.col("alike"))
    shard = F.pmod(dealt_by, F.lit(shards)).cast("int")
    dealt = sized.join(
        sources.select(F.col("source").alias("_source"), "position", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")),
    )
    dealt = dealt.select("doc_id", "source", "size", "alike", "position", "source_size", "target", shard.alias("shard"))

    cells = stored(
        dealt.groupBy("position", "shard")
        .agg(
            F.sum("size").alias("cell_size"),
            F.max(F.col("target") / (cap * F.greatest(F.col("source_size"), F.lit(1)))).alias("_part"),
        )
        .where("cell_size > 0")
        .withColumn("blocks", F.greatest(F.lit(1), F.round(cap * F.col("cell_size") / block_tokens)).cast("long")),
        "cells",
    )
    whole = cells.groupBy("position").agg(
        F.sum("blocks").alias("blocks"), (F.max("_part") * F.sum("blocks")).alias("votes")
    )
    house = cells.agg(F.round(F.sum(F.col("_part") * F.col("blocks")))).first()[0] or 0
    seats = apportioned(
        stored(whole.withColumn("seats", F.lit(int(house))), "votes"),
        [],
        ["position"],
    )
    seats = seats.select("position", F.least("quota", "blocks").alias("seats"))
    votes = cells.join(seats, "position").withColumn("votes", F.col("blocks").cast("double"))
    quotas = apportioned(stored(votes, "votes"), ["position"], ["shard"]).select(
        "position", "shard", "cell_size", "blocks", F.least("quota", "blocks").alias("quota")
    )

    # Both sides are small rows; a document's place in its cell is a running sum of sizes.
    order = Window.partitionBy("position", "shard").orderBy(
        F.xxhash64(F.lit(seed + 1), F.col("alike")), "doc_id", "alike", "size"
    )
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("_end", F.sum("size").over(run))
    placed = placed.join(stored(quotas, "quotas"), ["position", "shard"], "left")
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "position", "shard"), F.col("blocks"))
    placed = placed.withColumns({"_start": start, "_length": F.col("cell_size") * cap})

    taken = F.lit(0)
    for lap in range(cap):
        upto = f"_end + {lap} * cell_size"
        taken = taken + _taken_before(upto) - _taken_before(f"{upto} - size")
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, taken).otherwise(0).cast("long").alias("taken"),
        "source",
        "shard",
    )


def _taken_before(tokens: str) -> Column:
    """Tokens taken among the first ``tokens`` of a cell.

    Block j of the cell is taken when ``(j + _start) * quota`` passes a multiple of ``blocks``:
    exactly ``quota`` of the blocks, evenly spread. The value never grows faster than its
    argument, so no document gives more than its size per lap.
    """
    at = f"(({tokens}) * blocks div _length)"
    taken = f"((({at} + _start) * quota div blocks) - (_start * quota div blocks))"
    hit = f"(({at} + _start) * quota % blocks >= blocks - quota)"
    return F.expr(
        f"({taken} * _length + if({hit}, ({tokens}) * blocks - {at} * _length, 0)) div blocks"
    )
