"""Timestamp parsing that never guesses a time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The form alerts are written in; every other accepted form needs rewriting.
_USUAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}(Z|[+-]\d{4})$"
_ZONED = (
    r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}(:\d{1,2}([.,]\d+)?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$"
)
_NO_SECONDS = r"^([^:]+:\d{1,2})(Z|[+-].*)$"


def zoned_timestamp(text: Column) -> Column:
    """Timestamp of a text that carries an offset; NULL for naive or bad text."""
    point = F.regexp_replace(text, ",", ".")
    full = F.regexp_replace(point, _NO_SECONDS, "$1:00$2")
    return F.when(text.rlike(_USUAL), text.try_cast("timestamp")).when(
        text.rlike(_ZONED), full.try_cast("timestamp")
    )


def epoch_micros(text: Column) -> Column:
    """Timestamp of a decimal count of microseconds since 1970; NULL if not one."""
    micros = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    return F.timestamp_micros(micros)
