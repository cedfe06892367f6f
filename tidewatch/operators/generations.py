"""Which parts of rotated log generations are still owed after a stop.

A manifest row describes one file of a source (see schemas.MANIFEST). file_id
identifies the file whatever it is called now; `resumable` says whether the
source's checkpointed offset can be a line boundary of that file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.operators.shuffles import lookup_join, pin, running_totals

# Suffixes of compressed generations.
COMPRESSED = (".gz", ".bz2", ".xz", ".zst", ".zip")
_COMPRESSED_PATTERN = r"\.(gz|bz2|xz|zst|zip)$"


def at_line_boundary(offset: Column, size: Column, byte_before: Column) -> Column:
    """Whether a checkpoint may resume at offset: the start, the end, or just
    after a newline. byte_before is the byte at offset - 1."""
    return F.coalesce(
        (offset <= size)
        & ((offset == 0) | (offset == size) | (byte_before == F.lit(b"\n"))),
        F.lit(False),
    )


def rotated_candidates(manifest: DataFrame) -> DataFrame:
    """Rotated files that can be read: not the live file, not compressed, on the
    watched folder's device, each path once."""
    return (
        manifest.filter(
            ~F.col("is_live")
            & ~F.col("path").rlike(_COMPRESSED_PATTERN)
            & (F.col("device") == F.col("home_device"))
        ).dropDuplicates(["source", "path"])
    )


def owed_generations(
    manifest: DataFrame, checkpoint: DataFrame, start_from: str = "end"
) -> tuple[DataFrame, DataFrame]:
    """(owed, lost) per source.

    owed: source, path, file_id, start_offset, phase, mtime, size. Read in order
    of (phase, mtime, file_id): the checkpointed file from its offset, then every
    generation rotated after it, then the live file. Without a checkpoint only
    the live file is read, from start_from.
    lost: source, file_id, lost_after_offset, reason, for checkpoints whose file
    is no longer there; the live file is then owed from its start.
    """
    saved = checkpoint.select(
        "source", F.col("file_id").alias("saved_id"), F.col("offset").alias("saved_offset")
    )
    live = manifest.filter("is_live")
    rotated = rotated_candidates(manifest)
    in_live = saved.join(
        live.select("source", F.col("file_id").alias("live_id"), F.col("resumable").alias("live_ok")),
        "source",
        "left",
    )
    here = F.coalesce((F.col("live_id") == F.col("saved_id")) & F.col("live_ok"), F.lit(False))
    holder = (
        rotated.filter("resumable")
        .select("source", F.col("file_id").alias("saved_id"), F.col("mtime").alias("saved_mtime"))
        .groupBy("source", "saved_id")
        .agg(F.min("saved_mtime").alias("saved_mtime"))
    )
    state = pin(
        in_live.join(holder, ["source", "saved_id"], "left").select(
            "source",
            "saved_id",
            "saved_offset",
            "live_id",
            F.when(~here, F.col("saved_mtime")).alias("saved_mtime"),
            here.alias("in_live"),
        )
    )

    from_live = lookup_join(live, state, ["source"], "left").select(
        "source",
        "path",
        "file_id",
        F.when(F.col("in_live"), F.col("saved_offset"))
        .when(F.col("saved_id").isNotNull() | F.lit(start_from == "beginning"), F.lit(0))
        .otherwise(F.col("size"))
        .alias("start_offset"),
        F.lit(3).alias("phase"),
        "mtime",
        "size",
    )
    moved = state.filter(F.col("saved_mtime").isNotNull())
    behind = lookup_join(rotated, moved, ["source"])
    drained = (F.col("file_id") == F.col("saved_id")) & F.col("resumable")
    later = (
        (F.col("mtime") > F.col("saved_mtime"))
        & (F.col("file_id") != F.col("saved_id"))
        & ~F.coalesce(F.col("file_id") == F.col("live_id"), F.lit(False))
    )
    from_rotated = behind.filter(drained | later).select(
        "source",
        "path",
        "file_id",
        F.when(drained, F.col("saved_offset")).otherwise(F.lit(0)).alias("start_offset"),
        F.when(drained, 1).otherwise(2).alias("phase"),
        "mtime",
        "size",
    )
    owed = from_rotated.dropDuplicates(["source", "file_id"]).unionByName(from_live)

    gone = state.filter(~F.col("in_live") & F.col("saved_mtime").isNull())
    lost = gone.select(
        "source",
        F.col("saved_id").alias("file_id"),
        F.col("saved_offset").alias("lost_after_offset"),
        F.when(F.col("live_id").isNull(), "no_live_file")
        .when(F.col("live_id") == F.col("saved_id"), "not_a_line_boundary")
        .otherwise("generation_missing")
        .alias("reason"),
    )
    return owed, lost


def drain_order(owed: DataFrame) -> DataFrame:
    """Number the owed files of each source in the order they are read."""
    return running_totals(
        owed, ["source"], ["phase", "mtime", "file_id"], {"position": F.lit(1)}
    )


def line_offsets(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """Byte offset just after each line of a file (source, file_id), newline included."""
    return running_totals(
        lines,
        ["source", "file_id"],
        [order],
        {"end_offset": F.octet_length("value") + 1},
    )
