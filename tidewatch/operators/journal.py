"""Authentication entries of an exported system journal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.json_text import computed_once, parse_document, string_member, with_members
from tidewatch.functions.labels import stable_uuid
from tidewatch.functions.times import epoch_micros

SOURCE = "auth.journald"

# Syslog facilities auth and authpriv.
AUTH_FACILITIES = ("4", "10")

# Journal field -> payload key.
PAYLOAD_FIELDS = {
    "MESSAGE": "message",
    "PRIORITY": "priority",
    "SYSLOG_FACILITY": "syslog_facility",
    "SYSLOG_IDENTIFIER": "syslog_identifier",
    "_COMM": "comm",
    "_EXE": "exe",
    "_PID": "pid",
    "_UID": "uid",
    "_SYSTEMD_UNIT": "systemd_unit",
    "_HOSTNAME": "source_hostname",
    "_TRANSPORT": "transport",
    "_BOOT_ID": "boot_id",
}


def _payload() -> Column:
    entries = F.array(*[
        F.struct(F.lit(key).alias("key"), F.col(f"_field_{field}").alias("value"))
        for field, key in PAYLOAD_FIELDS.items()
    ])
    return F.map_from_entries(F.filter(entries, lambda entry: entry["value"] != ""))


def classify_entries(lines: DataFrame) -> DataFrame:
    """Journal lines with their cursor, time, payload and a reject_reason.

    Fields count as strings unless one of their names stands before something
    else than a quote, or a name may be written with escapes; only such lines are
    parsed with their types.
    """
    text = F.make_valid_utf8(F.col("value").cast("string"))
    present = computed_once(lines, _text=text).filter(
        F.length(F.trim(F.regexp_replace("_text", r"[\t\r\n]", " "))) > 0
    )
    names = ["__CURSOR", "__REALTIME_TIMESTAMP", *PAYLOAD_FIELDS]
    read = with_members(present, F.col("_text"), ", ".join(f"`{name}` string" for name in names))
    open_type = F.col("_text").rlike(rf'"({"|".join(names)})"\s*:\s*[^"\s]|\\u')
    parsed = computed_once(
        read, _doc=F.when(F.col("_row").isNotNull() & open_type, parse_document(F.col("_text")))
    )
    fields = computed_once(
        parsed, **{f"_field_{name}": string_member(f"_row.{name}", "_doc", f".{name}") for name in names}
    )
    event_time = epoch_micros(F.col("_field___REALTIME_TIMESTAMP"))
    cursor = F.col("_field___CURSOR")
    timed = computed_once(fields, timestamp=event_time, payload=_payload())
    judged = computed_once(
        timed,
        reject_reason=F.when(F.col("_row").isNull(), "not_json")
        .when(F.coalesce(cursor, F.lit("")) == "", "missing_cursor")
        .when(F.col("timestamp").isNull(), "bad_timestamp"),
    )
    return judged.select(
        *lines.columns, "reject_reason", cursor.alias("cursor"), "timestamp", "payload"
    )


def journal_events(
    lines: DataFrame,
    host: str | Column = "unknown",
    facilities: tuple[str, ...] | None = AUTH_FACILITIES,
    collected_at: Column | None = None,
    random_ids: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of journal lines.

    Ids are derived from the cursor, so that reading a line again yields the
    same event; random_ids gives every reading its own id instead.
    """
    classified = classify_entries(lines)
    valid = classified.filter(F.col("reject_reason").isNull())
    if facilities is not None:
        valid = valid.filter(F.element_at("payload", "syslog_facility").isin(*facilities))
    host = F.lit(host) if isinstance(host, str) else host
    events = valid.select(
        (F.uuid() if random_ids else stable_uuid(F.col("cursor"))).alias("id"),
        F.lit(SOURCE).alias("source"),
        "timestamp",
        (F.current_timestamp() if collected_at is None else collected_at).alias("collected_at"),
        host.alias("host"),
        "payload",
        "cursor",
    )
    rejects = classified.filter(F.col("reject_reason").isNotNull()).select(
        *lines.columns, "reject_reason"
    )
    return events, rejects
