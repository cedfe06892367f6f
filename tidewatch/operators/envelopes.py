"""Batches of events as envelopes: packing, unpacking, revoked senders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.json_text import computed_once
from tidewatch.operators.shuffles import first_copy, lookup_join, running_totals
from tidewatch.schemas import ENVELOPE

SCHEMA_VERSION = 1
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def drop_revoked(envelopes: DataFrame, revoked: DataFrame, identity: str = "agent_id") -> DataFrame:
    """Envelopes whose sender is not on the deny list; an entry without a name denies nobody."""
    denied = revoked.filter(F.col("agent_id").isNotNull()).select(F.col("agent_id").alias(identity)).distinct()
    return lookup_join(envelopes, denied, [identity], "left_anti")


def parse_envelopes(bodies: DataFrame, body: str = "value") -> DataFrame:
    """Bodies with the envelope's members beside them and a reject_reason."""
    text = F.col(body).cast("string")
    parsed = computed_once(
        bodies, _envelope=F.from_json(text, ENVELOPE, {"mode": "PERMISSIVE"})
    )
    return parsed.select(
        *bodies.columns,
        F.when(F.col("_envelope.events").isNull(), "bad_body").alias("reject_reason"),
        "_envelope.*",
    )


def unpack_envelopes(
    bodies: DataFrame, revoked: DataFrame | None = None, identity: str = "agent_id"
) -> DataFrame:
    """One row per event of every accepted envelope. identity names the column
    that says who sent it; by default the sender the envelope itself states."""
    accepted = parse_envelopes(bodies).filter(F.col("reject_reason").isNull())
    if revoked is not None:
        accepted = drop_revoked(accepted, revoked, identity)
    return accepted.select(
        F.col(identity).alias("agent_id"), "sent_at", F.explode("events").alias("event")
    ).select("agent_id", "sent_at", "event.*")


def unique_events(events: DataFrame, order: list[Column | str] | None = None) -> DataFrame:
    """One row per event id, whatever was re-sent. Also works on a stream, where
    the first arrival wins."""
    if events.isStreaming:
        return events.dropDuplicates(["id"])
    return first_copy(events, ["id"], order or ["sent_at", "agent_id"])


def pack_envelopes(
    events: DataFrame, batch_size: int = 256, sent_at: Column | None = None, agent: str = "host"
) -> DataFrame:
    """Envelopes of at most batch_size events per agent, oldest first.

    Numbering is done slice by slice and only a batch is collected, so an agent
    with very many events is spread like any other.
    """
    placed = running_totals(events, [agent], ["collected_at", "id"], {"_place": F.lit(1)})
    event = F.struct(
        "_place", F.struct("id", "source", "timestamp", "collected_at", "host", "payload").alias("event")
    )
    batches = (
        placed.withColumn("batch_no", F.expr(f"(_place - 1) div {batch_size}"))
        .groupBy(F.col(agent).alias("agent_id"), "batch_no")
        .agg(
            F.array_sort(
                F.collect_list(event),
                lambda a, b: F.signum(a["_place"] - b["_place"]).cast("int"),
            ).alias("_events")
        )
    )
    return batches.select(
        "agent_id",
        "batch_no",
        (F.current_timestamp() if sent_at is None else sent_at).alias("sent_at"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("_events.event").alias("events"),
    )


def envelope_json(envelopes: DataFrame) -> DataFrame:
    """Envelopes as one compact JSON text each."""
    return envelopes.select(
        F.to_json(
            F.struct("agent_id", "sent_at", "schema_version", "events"),
            {"timestampFormat": TIME_FORMAT},
        ).alias("value")
    )
