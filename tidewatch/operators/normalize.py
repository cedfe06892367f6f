"""Alert documents to typed rows, and the messages that are not alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.json_text import (
    computed_once,
    has_lone_surrogate,
    is_single_value,
    parse_document,
    replace_nul,
    type_matters,
    typed_list,
    typed_scalar,
    typed_small_int,
    utf8_text,
    with_members,
)
from tidewatch.functions.labels import content_id
from tidewatch.functions.times import zoned_timestamp
from tidewatch.schemas import FINDING

PREVIEW_CHARS = 200

_MEMBERS = (
    "id string, timestamp string, location string, manager struct<name string>, "
    "rule struct<id string, level string, description string, groups array<string>, "
    "mitre struct<id array<string>, tactic array<string>>>, "
    "agent struct<id string, name string, ip string>, decoder struct<name string>, "
    "data struct<srcip string, srcuser string>"
)


def _zoned(text: str, document: str, path: str) -> Column:
    return zoned_timestamp(F.col(text))


# Finding column, where it sits in the document, how it is typed.
_FIELDS = {
    "manager": (".manager.name", typed_scalar),
    "alert_id": (".id", typed_scalar),
    "ts": (".timestamp", _zoned),
    "rule_id": (".rule.id", typed_scalar),
    "rule_level": (".rule.level", typed_small_int),
    "rule_description": (".rule.description", typed_scalar),
    "rule_groups": (".rule.groups", typed_list),
    "mitre_ids": (".rule.mitre.id", typed_list),
    "mitre_tactics": (".rule.mitre.tactic", typed_list),
    "agent_id": (".agent.id", typed_scalar),
    "agent_name": (".agent.name", typed_scalar),
    "agent_ip": (".agent.ip", typed_scalar),
    "decoder": (".decoder.name", typed_scalar),
    "location": (".location", typed_scalar),
    "src_ip": (".data.srcip", typed_scalar),
    "src_user": (".data.srcuser", typed_scalar),
}


def _types_needed() -> Column:
    """Rows whose members' texts alone do not settle the finding columns."""
    lists = [f"_row{path}" for path, to_type in _FIELDS.values() if to_type is typed_list]
    unread = " OR ".join(
        f"({name} IS NULL AND contains(_text, '\"{key}\"'))"
        for name, key in zip(lists, ("groups", "mitre", "mitre"), strict=True)
    )
    texts = [f"_row{_FIELDS[name][0]}" for name in _FIELDS if name not in ("ts", "rule_level")]
    return type_matters(texts) | F.expr(
        f"contains(_text, 'null') OR {unread} OR "
        r"NOT coalesce(_row.rule.level RLIKE r'^\d{1,9}$', true)"
    )


def classify(records: DataFrame, *keep: str) -> DataFrame:
    """Every record with its finding columns, a reject_reason and the columns named to be kept.

    reject_reason is NULL for an alert; otherwise the finding columns carry no
    meaning, `preview` shows how the message began and `rejected_value` keeps it
    whole, so that it can be read again. One strict read gives the
    members as text; only where types matter is the document parsed with them.
    """
    text = F.col("_text")
    decoded = computed_once(records, _text=replace_nul(utf8_text(F.col("value"))))
    read = with_members(decoded, text, _MEMBERS)
    judged = computed_once(
        read,
        _doc=F.when(
            F.col("_row").isNull() | _types_needed(), parse_document(text)
        ),
    )
    judged = computed_once(
        judged,
        reject_reason=F.when(F.col("value").isNull(), "null_value")
        .when(text.isNull(), "invalid_utf8")
        .when(
            F.col("_row").isNull(),
            F.when(is_single_value(F.col("_doc"), text), "not_object").otherwise("not_json"),
        )
        .when(has_lone_surrogate(text), "unencodable"),
    )
    typed = {
        name: to_type(f"_row{path}", "_doc", path)
        for name, (path, to_type) in _FIELDS.items()
    }
    typed["manager"] = F.coalesce(typed["manager"], F.lit(""))
    typed["alert_id"] = F.coalesce(typed["alert_id"], content_id(F.col("value")))
    return judged.select(
        *[column.alias(name) for name, column in typed.items()],
        F.col("_text").alias("raw"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.current_timestamp().alias("ingested_at"),
        "reject_reason",
        F.when(
            F.col("reject_reason").isNotNull(),
            F.substring(F.make_valid_utf8(F.col("value").cast("string")), 1, PREVIEW_CHARS),
        ).alias("preview"),
        F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("rejected_value"),
        *keep,
    )


def alerts_of(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull()).select(*FINDING.fieldNames())


def rejects_of(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNotNull()).select(
        "source_topic", "source_partition", "source_offset", "reject_reason", "preview",
        "rejected_value",
    )


def normalize_alerts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split records into findings (all copies) and rejects."""
    classified = classify(records)
    return alerts_of(classified), rejects_of(classified)


def check_lines(lines: DataFrame) -> DataFrame:
    """Mark each source line blank, malformed or valid before it is forwarded."""
    trimmed = F.regexp_replace(
        F.make_valid_utf8(F.col("value").cast("string")), r"^[ \t\r\n\x0b\x0c]+|[ \t\r\n\x0b\x0c]+$", ""
    )
    decoded = computed_once(lines, _text=utf8_text(F.col("value")))
    parsed = computed_once(decoded, _doc=parse_document(F.col("_text")))
    judged = computed_once(
        parsed,
        status=F.when(F.length(trimmed) == 0, "blank")
        .when(is_single_value(F.col("_doc"), F.col("_text")), "valid")
        .otherwise("malformed"),
    )
    return judged.select(
        *lines.columns,
        "status",
        F.when(
            F.col("status") == "malformed",
            F.substring(F.make_valid_utf8(F.col("value").cast("string")), 1, PREVIEW_CHARS),
        ).alias("preview"),
    )
