"""Scoring of profiled columns against a dictionary of business concepts.

Every score that is kept needs at least one name to contain the other. So instead of comparing all
columns with all concepts, the distinct names on one side meet the rarest piece of each name on the
other in an equi-join; only names that contain one another leave it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pseudora.functions import naming
from pseudora.functions.naming import normalize_identifier
from pseudora.operators.bronze import timestamp_column
from pseudora.plans.skew import ROWS_PER_TASK, KeyCounts, key_hash, spread_left_join
from pseudora.sources.tables import stored, stored_counted

# Match flags with their weight and reported reason, in the order in which both are
# put together; the score that is kept; the bounds of the decisions.
MATCH_RULES = (
    ("canonical_exact_match", 0.65, "CANONICAL_EXACT"),
    ("concept_exact_match", 0.55, "CONCEPT_EXACT"),
    ("canonical_partial_match", 0.25, "CANONICAL_PARTIAL"),
    ("concept_partial_match", 0.15, "CONCEPT_PARTIAL"),
    ("inferred_type_match", 0.20, "INFERRED_TYPE_MATCH"),
)
MIN_SCORE = 0.30
AUTO_ACCEPT_SCORE = 0.75
REVIEW_SCORE = 0.50

# Inferred types that stand for a canonical field of another name.
TYPE_SYNONYMS = (("name", "full_name"), ("date", "date_of_birth"))

#: Pieces by which contained texts are found; a text shorter than ``SHORT`` is its own piece.
GRAM_SIZES = (4, 8, 16)
SHORT = GRAM_SIZES[0]
HELD_SIZES = (*range(SHORT), *GRAM_SIZES)

#: Rows that one name yields in a task of the last join; the shuffle before it does not show them.
PAIRS_PER_TASK = 250_000

PROFILE_COLUMNS = (
    "source_system",
    "table_name",
    "column_name",
    "row_count",
    "null_rate",
    "distinct_count",
    "distinct_rate",
    "inferred_type",
)
CONCEPT_COLUMNS = (
    "concept_id",
    "concept_name",
    "canonical_field_name",
    "pii_category",
    "description",
)
GROUP_KEY = ("source_system", "table_name", "column_name")


def _known(rows: int, rows_per_task: int) -> KeyCounts | None:
    """So few rows hold no heavy key; of more, the join finds them."""
    return {} if rows <= rows_per_task else None


def anchored(
    long: DataFrame, short: DataFrame, long_grams: int, short_rows: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Pairs of texts of which that of ``long`` may contain that of ``short``.

    Pieces of all sizes are counted over ``long``. A contained text is anchored by its piece that
    fewest of these texts hold, so it meets no more of them than that; a text with a piece that none
    holds is contained in none. The rows of a text grow in proportion to its length, and pieces that
    many texts share or are anchored by are cut. ``long_grams`` and ``short_rows`` bound the rows of
    both sides.
    """
    outer, inner = long.columns[0], short.columns[0]
    pieces = F.when(F.length(inner) < SHORT, F.array(F.col(inner))).otherwise(naming.grams(inner, GRAM_SIZES))
    wanted = short.select(inner, F.explode(pieces).alias("gram"))
    held = long.select(outer, F.explode(naming.grams(outer, HELD_SIZES)).alias("gram"))
    often = held.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    rare = wanted.join(often, "gram", "left")
    rarest = F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram")).alias("anchor")
    anchors = rare.groupBy(inner).agg(rarest).where("anchor.often > 0").select(inner, F.col("anchor.gram").alias("gram"))
    of_short, of_long = _known(short_rows, rows_per_task), _known(long_grams, rows_per_task)
    met = spread_left_join(
        anchors if of_short is not None else stored(anchors, "anchors"),
        ["gram"],
        many=held,
        many_spread_by=F.xxhash64(outer),
        left_spread_by=F.xxhash64(inner),
        rows_per_task=rows_per_task,
        left_counts=of_short,
        many_counts=of_long,
    )
    return met.where(F.col(outer).isNotNull()).select(outer, inner)


def containing_pairs(
    names: DataFrame,
    terms: DataFrame,
    *,
    name_size: tuple[int, int],
    term_size: tuple[int, int],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Distinct (name, term) where either contains the other; inputs are distinct and non-NULL.

    The sizes are the rows and characters of both, or more.
    """

    def pieces(size: tuple[int, int]) -> int:
        return len(HELD_SIZES) * (size[0] + size[1])

    there = anchored(names, terms, pieces(name_size), term_size[0], rows_per_task).where("contains(name, term)")
    back = anchored(terms, names, pieces(term_size), name_size[0], rows_per_task).where("contains(term, name)")
    return there.select("name", "term").union(back.select("name", "term")).distinct()


def _contains(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def _type_match(inferred: Column, canonical: Column) -> Column:
    kind = F.lower(F.coalesce(inferred, F.lit("")))
    match = kind == canonical
    for type_name, field in TYPE_SYNONYMS:
        match = match | ((kind == type_name) & (canonical == field))
    return match


def _fan_out(columns: DataFrame, partners: DataFrame, most: int) -> tuple[DataFrame | None, int | None]:
    """Cells of ``most`` pairs for names that make more, and tasks for all pairs; None if these are few."""
    rows = F.count(F.lit(1))
    left, right = F.col("left_rows"), F.col("right_rows")
    sizes = columns.groupBy("name").agg(rows.alias("left_rows"))
    sizes = sizes.join(partners.groupBy("name").agg(rows.alias("right_rows")), "name")
    sizes = stored(sizes.withColumn("pairs", left * right), "sizes")
    pairs = sizes.agg(F.sum("pairs").alias("pairs")).first()["pairs"] or 0
    if pairs <= most:
        return None, None
    # Square cells copy least; a side too short for that is left whole.
    side = max(1, int(most**0.5))
    parts = {
        "_left_parts": F.ceil(left / F.greatest(F.lit(side), F.lit(most) / right)).cast("int"),
        "_right_parts": F.ceil(right / F.greatest(F.lit(side), F.lit(most) / left)).cast("int"),
    }
    # No more names than cells that all pairs fill.
    grid = sizes.where(F.col("pairs") > most).select(key_hash([F.col("name")]).alias("_key_hash"), *[c.alias(n) for n, c in parts.items()])
    return F.broadcast(grid), -(-pairs // most)


def match_flags(
    profiles: DataFrame,
    concepts: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Profile x concept rows with the five match flags, for names that contain one another."""
    columns = profiles.where(~F.col("column_name").startswith("_")).select(
        *PROFILE_COLUMNS, normalize_identifier(F.col("column_name")).alias("name")
    )
    dictionary = concepts.select(
        *CONCEPT_COLUMNS,
        normalize_identifier(F.col("canonical_field_name")).alias("canonical"),
        normalize_identifier(F.col("concept_name")).alias("concept"),
    )
    columns, *column_size = stored_counted(columns, "columns", "name")
    dictionary, *term_size = stored_counted(dictionary, "dictionary", "canonical", "concept")
    spelled = dictionary.select("*", F.posexplode(F.array("canonical", "concept")).alias("place", "term"))
    pairs, n_pairs, _ = stored_counted(
        containing_pairs(
            columns.where("name IS NOT NULL").select("name").distinct(),
            spelled.where("term IS NOT NULL").select("term").distinct(),
            name_size=tuple(column_size),
            term_size=(2 * term_size[0], term_size[1]),
            rows_per_task=rows_per_task,
        ),
        "containing",
    )
    either = spread_left_join(
        pairs,
        ["term"],
        many=spelled,
        left_spread_by=F.xxhash64("name"),
        many_spread_by=F.xxhash64(*CONCEPT_COLUMNS),
        rows_per_task=rows_per_task,
        left_counts=_known(n_pairs, rows_per_task),
        many_counts=_known(2 * term_size[0], rows_per_task),
    )
    # A concept that a name meets by its canonical term needs no second row for the other one.
    once = (F.col("place") == 0) | ~F.coalesce(_contains(F.col("name"), F.col("canonical")), F.lit(False))
    partners, n_partners, _ = stored_counted(either.where(once).select("name", *dictionary.columns), "partners")
    grid, partitions = _fan_out(columns, partners, pairs_per_task)
    name, canonical, concept = F.col("name"), F.col("canonical"), F.col("concept")
    return (
        spread_left_join(
            columns,
            ["name"],
            many=partners.withColumn("met", F.lit(True)),
            many_spread_by=F.xxhash64(*CONCEPT_COLUMNS),
            rows_per_task=rows_per_task,
            left_counts=_known(column_size[0], rows_per_task),
            many_counts=_known(n_partners, rows_per_task),
            grid=grid,
            partitions=partitions,
        )
        .where("met")
        .select(
            *PROFILE_COLUMNS,
            *CONCEPT_COLUMNS,
            (name == canonical).alias("canonical_exact_match"),
            (name == concept).alias("concept_exact_match"),
            _contains(name, canonical).alias("canonical_partial_match"),
            _contains(name, concept).alias("concept_partial_match"),
            _type_match(F.col("inferred_type"), F.lower("canonical_field_name")).alias(
                "inferred_type_match"
            ),
        )
    )


def build_semantic_mapping_candidates(
    profiles: DataFrame, concepts: DataFrame, *, batch_id: str, run_ts: datetime | None = None
) -> DataFrame:
    """Scored candidates of at least ``MIN_SCORE``."""
    score = F.lit(0.0)
    for flag, weight, _ in MATCH_RULES:
        score = score + F.when(F.col(flag), F.lit(weight)).otherwise(F.lit(0.0))
    reasons = [F.when(F.col(flag), F.lit(reason)) for flag, _, reason in MATCH_RULES]
    return (
        match_flags(profiles, concepts)
        .select(
            *PROFILE_COLUMNS,
            *CONCEPT_COLUMNS,
            F.least(F.lit(1.0), score).alias("mapping_score"),
            F.concat_ws(",", *reasons).alias("mapping_reason"),
            timestamp_column(run_ts).alias("created_at"),
            F.lit(batch_id).alias("batch_id"),
        )
        .where(F.col("mapping_score") >= MIN_SCORE)
    )


def build_mapping_decisions(candidates: DataFrame) -> DataFrame:
    """Best candidate of each column, lowest concept id first among equals, with its band.

    Should the dictionary repeat an id, the other concept columns settle the order.
    """
    best_first = Window.partitionBy(*GROUP_KEY).orderBy(
        F.col("mapping_score").desc(), *CONCEPT_COLUMNS
    )
    score = F.col("mapping_score")
    decision = (
        F.when(score >= AUTO_ACCEPT_SCORE, F.lit("AUTO_ACCEPT"))
        .when(score >= REVIEW_SCORE, F.lit("REVIEW_REQUIRED"))
        .otherwise(F.lit("LOW_CONFIDENCE"))
    )
    return (
        candidates.withColumn("position", F.row_number().over(best_first))
        .where(F.col("position") == 1)
        .select(
            *GROUP_KEY,
            *CONCEPT_COLUMNS,
            "mapping_score",
            "mapping_reason",
            decision.alias("decision"),
            "created_at",
            "batch_id",
        )
    )
