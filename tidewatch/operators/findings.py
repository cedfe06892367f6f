"""Queries over the findings table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.json_text import member_int
from tidewatch.functions.labels import joined_or_dash, severity_tag

DESCRIPTION_CHARS = 52


def since(findings: DataFrame, as_of: datetime | str | Column | None = None, hours: int = 1) -> DataFrame:
    """Findings of the last hours before as_of (default: now)."""
    if as_of is None:
        as_of = F.current_timestamp()
    elif not isinstance(as_of, Column):
        as_of = F.lit(str(as_of)).cast("timestamp")
    return findings.filter(F.col("ts") > as_of - F.make_dt_interval(hours=F.lit(hours)))


def top_severe(
    findings: DataFrame,
    as_of: datetime | str | Column | None = None,
    hours: int = 1,
    n: int = 20,
) -> DataFrame:
    """Most severe recent findings; an unknown level sorts first."""
    return (
        since(findings, as_of, hours)
        .orderBy(
            F.desc_nulls_first("rule_level"), F.desc("ts"), F.asc("manager"), F.asc("alert_id")
        )
        .limit(n)
        .select("ts", "rule_level", "agent_name", "rule_description", "mitre_ids", "alert_id")
    )


def technique_rollup(findings: DataFrame) -> DataFrame:
    """Findings and distinct agents per technique, most frequent first."""
    return (
        findings.select(F.explode("mitre_ids").alias("technique"), "agent_name")
        .groupBy("technique")
        .agg(F.count("*").alias("alerts"), F.count_distinct("agent_name").alias("agents"))
        .orderBy(F.desc("alerts"), "technique")
    )


def table_audit(findings: DataFrame, member: str = "demo_seq") -> DataFrame:
    """Rows, distinct sequence numbers, and how many are missing below the highest."""
    per_seq = (
        findings.select(member_int(F.col("raw"), member).alias("seq"))
        .groupBy("seq")
        .agg(F.count("*").alias("copies"))
    )
    return per_seq.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("seq").alias("unique_seqs"),
        (F.max("seq") - F.count("seq")).alias("gaps"),
    )


def findings_counts(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.count("*").alias("rows"),
        F.count_distinct("alert_id").alias("distinct_alerts"),
        F.min("source_offset").alias("min_offset"),
    )


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy(severity_tag(F.col("rule_level")).alias("tag")).agg(
        F.count("*").alias("alerts"), F.max("rule_level").alias("max_level")
    )


def display(findings: DataFrame, seq: Column, is_duplicate: Column) -> DataFrame:
    """One printable line per finding."""
    level = F.coalesce(F.col("rule_level"), F.lit(0))
    line = F.format_string(
        "#%-6s %-4s L%-2s %-8s %-52s %s%s",
        F.coalesce(seq.cast("string"), F.lit("-")),
        severity_tag(level),
        level.cast("string"),
        F.coalesce("agent_name", F.lit("?")),
        F.substring(F.coalesce("rule_description", F.lit("?")), 1, DESCRIPTION_CHARS),
        joined_or_dash(F.col("mitre_ids")),
        F.when(is_duplicate, F.lit("  [duplicate]")).otherwise(F.lit("")),
    )
    return findings.select(
        "source_topic", "source_partition", "source_offset", line.alias("line")
    )


def register_view(findings: DataFrame, name: str = "findings") -> None:
    """Offer the findings to SQL."""
    findings.createOrReplaceTempView(name)
