"""Joins against a side of unknown size, and order-dependent work on hot groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.session import checkpoint_dir

# A side is broadcast only when it was measured below both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
# Largest per-group limit for which Spark cuts each map task to the limit
# before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
# Rows that one task sums in order.
SLICE_ROWS = 1_000_000
NESTED = ("array", "map", "struct", "variant")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, NULL being equal to NULL; the left side's are kept."""
    keys = right.withColumnsRenamed({name: f"_right_{name}" for name in on})
    condition = F.lit(True)
    for name in on:
        condition = condition & left[name].eqNullSafe(keys[f"_right_{name}"])
    return left.join(keys, condition, how).drop(*[f"_right_{name}" for name in on])


def pin(df: DataFrame) -> DataFrame:
    """Store the rows in the shared checkpoint folder and read them from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, on: Sequence[str], most: int) -> DataFrame:
    """The rows by hash in tasks of about `most` rows, where they lie in fewer tasks than that takes."""
    tasks = -(-df.count() // most)
    return df.repartition(tasks, *on) if tasks > df.rdd.getNumPartitions() else df


def gathered(df: DataFrame, rows: int, most: int) -> DataFrame:
    """The partitions of a shuffle in as few tasks as hold about `most` of its rows each, one for each core at least.

    What is stored between two shuffles is not merged by adaptive execution, and the second
    writes a file for each pair of a task and a partition.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most)))


def is_small(df: DataFrame) -> bool:
    """Measure the rows and their text; True if the whole fits a broadcast."""
    width = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        kind, column = field.dataType.typeName(), F.col(field.name)
        if kind in NESTED:  # by their text, which is never much shorter
            column, kind = F.to_json(F.struct(column)), "string"
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows to a side with few rows per key, whatever the key skew.

    NULL is a key like any other: it equals NULL, as in all joins on keys here.

    The lookup side is measured. A small one is broadcast, so the rows are not
    shuffled at all; a large one is joined on key and salt, so that a key that
    holds a large share of the rows is spread over several tasks. These are
    merged: Spark takes a side that was copied for each salt for about as small
    as before, and would broadcast it, however large it was measured.
    `how` is inner, left, left_semi or left_anti.
    """
    on = list(on)
    if is_small(lookup):
        return null_safe_join(rows, F.broadcast(lookup), on, how)
    # never a random salt: a stage that is run again must deal its rows alike
    atomic = [f.name for f in rows.schema.fields if f.dataType.typeName() not in NESTED and f.name not in on]
    nested = [f.name for f in rows.schema.fields if f.dataType.typeName() in NESTED]
    hashed = [*atomic, *([F.to_json(F.struct(*nested))] if nested and not atomic else [])] or on
    salt = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
    spread = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return null_safe_join(rows.withColumn("_salt", salt), spread.hint("merge"), [*on, "_salt"], how).drop("_salt")


def first_copy(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key in the given order.

    Comparing the rank to 1 lets Spark keep one row per key in each map task
    before the shuffle, so a key with very many copies stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_copy", F.row_number().over(window))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
    )


def _in_order(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc(name) if descending else F.asc(name) for name in order]


def _up_to_here(keys: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    descending: bool = False,
) -> DataFrame:
    """Add inclusive running sums per group without one task per group.

    Rows are counted first. As many as fit a task are summed by a window. Else
    the sums of group and order alone are range-partitioned into slices of a
    measured size and stored; each slice is summed on its own, the sum of the
    slices before it comes from a table of one row per slice and group, and
    the rows, which are never stored, take their sums by group and order. Rows
    that agree in both follow each other in any order.
    """
    group, order = list(group), list(order)
    ordered = _in_order(order, descending)
    slices = -(-df.count() // SLICE_ROWS)
    if slices <= 1:
        window = _up_to_here(group, ordered)
        return df.select("*", *[F.sum(expr.cast("bigint")).over(window).alias(name) for name, expr in totals.items()])
    sliced = pin(
        df.groupBy(*group, *order)
        .agg(*[F.sum(expr.cast("bigint")).alias(f"_in_{name}") for name, expr in totals.items()])
        .repartitionByRange(slices, *group, *ordered)
        .withColumn("_slice", F.spark_partition_id())
    )
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        sliced.groupBy(*group, "_slice")
        .agg(*[F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in totals])
        .select(
            *group, "_slice",
            *[F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_base_{name}") for name in totals],
        )
    )
    within = _up_to_here([*group, "_slice"], ordered)
    local = sliced.select(
        *group, *order, "_slice",
        *[(F.sum(f"_in_{name}").over(within) - F.col(f"_in_{name}")).alias(f"_run_{name}") for name in totals],
    )
    reached = null_safe_join(local, base, [*group, "_slice"]).select(
        *group, *order, *[(F.col(f"_run_{name}") + F.col(f"_base_{name}")).alias(f"_before_{name}") for name in totals]
    )
    ties = _up_to_here([*group, *order], [F.lit(0)])
    return null_safe_join(df, reached, [*group, *order]).select(
        *df.columns,
        *[(F.col(f"_before_{name}") + F.sum(expr.cast("bigint")).over(ties)).alias(name) for name, expr in totals.items()],
    )


def ranked_with_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    measure: Column,
    limit: int = 0,
    descending: bool = False,
) -> DataFrame:
    """Add `_rank` and `_total` (running sum of measure) per group in order.

    With a limit only the first `limit` rows of each group are returned. Small
    limits are applied in each map task, then to each salt of a group, and at
    last to the group, so that what reaches one task is bounded by the salts
    and not by the number of map tasks; otherwise the two-level running sum is
    used.
    """
    if 0 < limit <= GROUP_LIMIT:
        ordered = _in_order(order, descending)
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int"))
        parts = Window.partitionBy(*group, "_salt").orderBy(*ordered)
        cut = salted.withColumn("_rank", F.row_number().over(parts)).filter(F.col("_rank") <= limit).drop("_rank", "_salt")
        return (
            cut.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*ordered)).cast("bigint"))
            .filter(F.col("_rank") <= limit)
            .withColumn("_total", F.sum(measure.cast("bigint")).over(_up_to_here(group, ordered)))
        )
    ranked = running_totals(df, group, order, {"_rank": F.lit(1), "_total": measure}, descending)
    return ranked.filter(F.col("_rank") <= limit) if limit > 0 else ranked
