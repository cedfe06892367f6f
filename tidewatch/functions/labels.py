"""Identity and display expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_id(value: Column) -> Column:
    """Identity of a document that carries none: the hash of its bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(value.cast("binary"), 256))


def stable_uuid(text: Column) -> Column:
    """UUID in version-4 form that is the same on every replay of the same text."""
    digest = F.sha2(text.cast("binary"), 256)
    variant = F.substring(
        F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, 1
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("4"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def severity_tag(level: Column) -> Column:
    """Band of a rule level."""
    # Low 0-4, med 5-7, HIGH 8-11, CRIT 12-16.
    return (
        F.when(level.between(0, 4), "low")
        .when(level.between(5, 7), "med")
        .when(level.between(8, 11), "HIGH")
        .when(level.between(12, 16), "CRIT")
        .otherwise("?")
    )


def joined_or_dash(items: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit("-"))


def queue_key(collected_nanos: Column, event_id: Column) -> Column:
    """Key whose text order is collection order, with the id breaking ties."""
    return F.concat_ws("-", F.lpad(collected_nanos.cast("string"), 20, "0"), event_id)
