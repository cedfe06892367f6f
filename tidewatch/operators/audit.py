"""Sequence audits: what arrived, what arrived twice, what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.json_text import computed_once, utf8_text, with_members
from tidewatch.operators.shuffles import first_copy, null_safe_join, pin

POSITION = ("topic", "partition", "offset")

# Sequence numbers per block: bounds what one task sorts, whatever the range.
BLOCK = 1 << 20
# Missing numbers one task may list at a time.
CHUNK = 1 << 15


def sequence_numbers(records: DataFrame, name: str = "demo_seq") -> DataFrame:
    """Position and sequence number of every record that carries one.

    Records that are not JSON or whose member is not a JSON integer are left out.
    """
    decoded = computed_once(records, _text=utf8_text(F.col("value")))
    read = with_members(decoded, F.col("_text"), f"`{name}` bigint")
    seq = F.col("_row")[name]
    return read.filter(seq.isNotNull()).select(*POSITION, seq.alias("seq"))


def _missing_runs(spans: DataFrame, block: int) -> DataFrame:
    """Runs (start, stop) between ordered, disjoint spans (low, high) and before
    the first one.

    Spans are compared with their predecessor inside blocks; each block then
    counts as one span for the level above, so the single ordered pass at the
    top sees one row per block of blocks.
    """
    in_block = Window.partitionBy("_block").orderBy("low")
    blocked = spans.withColumn("_block", F.expr(f"low div {block}"))
    inner = blocked.select(
        F.lag("high").over(in_block).alias("_before"), "low"
    ).filter(F.col("_before").isNotNull())
    outer = blocked.groupBy("_block").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    over_blocks = Window.partitionBy("_upper").orderBy("low")
    upper = outer.withColumn("_upper", F.expr(f"_block div {block}"))
    middle = upper.select(F.lag("high").over(over_blocks).alias("_before"), "low").filter(
        F.col("_before").isNotNull()
    )
    top = upper.groupBy("_upper").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # One row per block * block numbers, so this single-task window stays tiny.
    first = top.select(
        F.lag("high", 1, 0).over(Window.partitionBy(F.lit(0)).orderBy("low")).alias("_before"),
        "low",
    )
    return (
        inner.unionAll(middle)
        .unionAll(first)
        .filter(F.col("low") > F.col("_before") + 1)
        .select((F.col("_before") + 1).alias("start"), (F.col("low") - 1).alias("stop"))
    )


def gap_runs(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """Unbroken runs (start, stop) of numbers from 1 to the highest never seen."""
    seen = (
        sequences.filter(F.col("seq") >= 1)
        .groupBy("seq")
        .agg(F.count("*").alias("_copies"))
        .select(F.col("seq").alias("low"), F.col("seq").alias("high"))
    )
    return _missing_runs(seen, block)


def range_runs(ranges: DataFrame, block: int = BLOCK) -> DataFrame:
    """gap_runs() of disjoint ranges (low, high) of numbers that were seen."""
    spans = ranges.filter(F.col("high") >= 1).select(F.greatest("low", F.lit(1)).alias("low"), "high")
    return _missing_runs(spans, block)


def seq_gaps(sequences: DataFrame) -> DataFrame:
    """Every missing number. Long runs are cut and spread out, level by level,
    before they are listed. One stray number far off makes as many rows as it
    leaves out; gap_runs is the form for such data."""
    return _cut(_cut(_cut(gap_runs(sequences), CHUNK**3), CHUNK**2), CHUNK).select(
        F.explode(F.sequence("start", "stop")).alias("seq")
    )


def _cut(runs: DataFrame, size: int) -> DataFrame:
    """Runs cut at the multiples of a size, dealt out by part."""
    parts = runs.select("start", "stop", F.explode(
        F.sequence(F.expr(f"start div {size}"), F.expr(f"stop div {size}"))
    ).alias("part"))
    return parts.repartition("part").select(
        F.greatest(F.col("start"), F.col("part") * size).alias("start"),
        F.least(F.col("stop"), F.col("part") * size + (size - 1)).alias("stop"),
    )


def first_gaps(sequences: DataFrame, n: int = 10) -> DataFrame:
    """The n lowest missing numbers. Each run holds at least one, so n runs do."""
    return _first_of(gap_runs(sequences), n)


def _first_of(runs: DataFrame, n: int) -> DataFrame:
    runs = runs.orderBy("start").limit(n)
    return (
        runs.select(
            F.explode(
                F.sequence("start", F.least(F.col("stop"), F.col("start") + (n - 1)))
            ).alias("seq")
        )
        .orderBy("seq")
        .limit(n)
    )


def seq_audit(sequences: DataFrame, shown: int = 10) -> DataFrame:
    """One row: received, unique, highest, duplicates, gaps, the first gaps, verdict."""
    per_seq = pin(sequences.groupBy("seq").agg(F.count("*").alias("copies")))  # documents are read once
    totals = per_seq.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("received"),
        F.count("seq").alias("unique_seqs"),
        F.greatest(F.coalesce(F.max("seq"), F.lit(0)), F.lit(0)).alias("highest"),
        F.count_if(F.col("seq") >= 1).alias("_counted"),
    )
    return _verdict(totals, first_gaps(per_seq, shown))


def range_audit(blocks: DataFrame, shown: int = 10) -> DataFrame:
    """seq_audit of blocks of numbers: received, unique_seqs, ranges (array of low, high).

    Gaps follow from the ends of the ranges; numbers are never listed.
    """
    blocks = pin(blocks.select("received", "unique_seqs", "ranges"))
    ranges = blocks.select(F.explode("ranges").alias("r")).select("r.low", "r.high")
    counted = F.greatest(F.col("high") - F.greatest("low", F.lit(1)) + 1, F.lit(0))
    ends = ranges.agg(
        F.greatest(F.coalesce(F.max("high"), F.lit(0)), F.lit(0)).alias("highest"),
        F.coalesce(F.sum(counted), F.lit(0)).alias("_counted"),
        F.lit(True).alias("_one"),
    )
    sums = blocks.agg(
        F.coalesce(F.sum("received"), F.lit(0)).alias("received"),
        F.coalesce(F.sum("unique_seqs"), F.lit(0)).alias("unique_seqs"),
        F.lit(True).alias("_one"),
    )
    return _verdict(sums.join(ends, "_one").drop("_one"), _first_of(range_runs(ranges), shown))


def _verdict(totals: DataFrame, gaps_shown: DataFrame) -> DataFrame:
    shown_gaps = gaps_shown.agg(F.array_sort(F.collect_list("seq")).alias("first_gaps"))
    gaps = F.col("highest") - F.col("_counted")
    one = F.lit(True).alias("_one")
    return totals.select("*", one).join(shown_gaps.select("*", one), "_one").select(
        "received",
        "unique_seqs",
        "highest",
        (F.col("received") - F.col("unique_seqs")).alias("duplicates"),
        gaps.alias("gaps"),
        "first_gaps",
        (gaps > 0).alias("has_gaps"),
    )


def audit_line() -> Column:
    """Text form of a seq_audit row."""
    verdict = F.when(~F.col("has_gaps"), F.lit("NO GAPS")).otherwise(
        F.format_string(
            "!! %d GAP(S): [%s]", "gaps", F.array_join(F.col("first_gaps").cast("array<string>"), ", ")
        )
    )
    return F.format_string(
        "[audit] received=%d unique=%d highest=%d duplicates=%d | %s",
        "received", "unique_seqs", "highest", "duplicates", verdict,
    )


def mark_duplicates(rows: DataFrame, key: str = "seq") -> DataFrame:
    """Add is_duplicate: all but the first position of each key.

    The first positions are found with map-side reduction and joined back on
    the position, which is unique, so copies of one key never meet in one task.
    """
    firsts = first_copy(rows.select(key, *POSITION), [key], POSITION).select(
        *POSITION, F.lit(True).alias("_first")
    )
    return null_safe_join(rows, firsts, POSITION, "left").select(
        *rows.columns, F.col("_first").isNull().alias("is_duplicate")
    )
