"""Findings laid out for analysts: clustered files, and tables that say which files a question needs.

Compaction takes the batches of a ledger that can no longer change and writes
their findings once more, clustered by day, severity band, agent and time. A
row for each file holds the ends of its times, levels and agents; an inverted
table leads from a technique to its files. Segments of one size are merged
into one of the next. What is not compacted yet is read from the ledger, so
that a reader sees every finding once, whatever is ingested meanwhile.

Layout below the ledger's path:

    layout/data/<segment>/        findings
    layout/files/<segment>/       file, rows, low_ts, high_ts, low_level, high_level, low_agent, high_agent
    layout/techniques/<segment>/  technique, file; by technique
    layout/live/<segment>.json    the batches a segment holds, and the segments it replaces
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.labels import severity_tag
from tidewatch.schemas import FINDING
from tidewatch.sinks import ledger as lg
from tidewatch.sinks.parts import GRACE, PartLog

#: Findings of a file, about.
FILE_ROWS = 500_000
#: Segments of one level that are merged into one of the next.
FAN_IN = 8

_FILES = (
    "file string, rows bigint, low_ts timestamp, high_ts timestamp, low_level smallint, high_level smallint, "
    "low_agent string, high_agent string"
)
_TECHNIQUES = "technique string, file string"


class Layout:
    """The clustered findings beside a ledger. One job at a time compacts; readers and ingest go on meanwhile."""

    def __init__(self, spark: SparkSession, path: str, file_rows: int = FILE_ROWS, fan_in: int = FAN_IN):
        self.spark, self.path, self.root = spark, path, f"{path.rstrip('/')}/layout"
        self.log = PartLog(spark, self.root, ("data", "files", "techniques"))
        self.file_rows, self.fan_in = file_rows, fan_in

    # writing ---------------------------------------------------------------

    def _taken(self, segments: list[dict]) -> dict[str, int]:
        """For each run, the batch below which all are in the segments."""
        upto: dict[str, int] = {}
        for s in segments:
            for run, end in s["upto"].items():
                upto[run] = max(end, upto.get(run, 0))
        return upto

    def _write(self, findings: DataFrame, level: int, upto: dict[str, int], replaces: list[str]) -> dict | None:
        rows = findings.count()
        name = f"{level}-{uuid.uuid4().hex}"
        files = max(1, -(-rows // self.file_rows))
        cluster = [F.to_date("ts"), severity_tag(F.col("rule_level")), F.col("agent_name"), F.col("ts")]
        dealt = findings.repartitionByRange(files, *cluster) if files > 1 else findings.repartition(1)
        data = f"{self.root}/data/{name}"
        dealt.sortWithinPartitions(*cluster).write.mode("overwrite").parquet(data)
        stored = self.spark.read.schema(FINDING).parquet(data).withColumn("file", F.col("_metadata.file_path"))
        ends = [f(c).alias(f"{end}_{n}") for c, n in (("ts", "ts"), ("rule_level", "level"), ("agent_name", "agent"))
                for f, end in ((F.min, "low"), (F.max, "high"))]
        told = stored.groupBy("file").agg(F.count("*").alias("rows"), *ends)
        told.repartition(1).write.mode("overwrite").parquet(f"{self.root}/files/{name}")
        techniques = stored.select(F.explode("mitre_ids").alias("technique"), "file").distinct()
        techniques.repartitionByRange("technique").sortWithinPartitions("technique").write.mode("overwrite").parquet(
            f"{self.root}/techniques/{name}"
        )
        segment = {"name": name, "level": level, "rows": rows, "upto": upto, "replaces": replaces}
        self.log.add(segment)
        return segment

    def compact(self) -> int:
        """Take in the batches that cannot be replayed any more, all but the last of each run; returns the findings taken."""
        taken = self._taken(self.log.live())
        ledger = lg.read_ledger(self.spark, self.path)
        last = {r["run"]: r["last"] for r in ledger.groupBy("run").agg(F.max("batch_id").alias("last")).collect()}
        upto = {run: end for run, end in last.items() if end > taken.get(run, 0)}
        if not upto:
            return 0
        fresh = F.lit(False)
        for run, end in upto.items():
            fresh = fresh | ((F.col("run") == run) & (F.col("batch_id") >= taken.get(run, 0)) & (F.col("batch_id") < end))
        segment = self._write(lg.findings(ledger.filter(fresh)), 0, upto, [])
        self._merge()
        return segment["rows"]

    def _merge(self) -> None:
        while True:
            levels: dict[int, list[dict]] = {}
            for s in self.log.live():
                levels.setdefault(s["level"], []).append(s)
            full = next((own for _, own in sorted(levels.items()) if len(own) >= self.fan_in), None)
            if full is None:
                return
            rows = self.spark.read.schema(FINDING).parquet(*[f"{self.root}/data/{s['name']}" for s in full])
            self._write(rows, full[0]["level"] + 1, self._taken(full), [s["name"] for s in full])

    def sweep(self, grace: float = GRACE) -> int:
        return self.log.sweep(grace)

    # reading ---------------------------------------------------------------

    def _tables(self, folder: str, schema: str, segments: list[dict]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{folder}/{s['name']}" for s in segments])

    def files_for(self, segments: list[dict], keep: Column, technique: str | None) -> list[str]:
        """The files that may hold wanted findings. Their names reach the driver, as those of every scan do."""
        files = self._tables("files", _FILES, segments).filter(keep)
        if technique is not None:
            named = self._tables("techniques", _TECHNIQUES, segments).filter(F.col("technique") == technique)
            files = files.join(named, "file", "left_semi")
        return [r["file"] for r in files.select("file").collect()]

    def read(
        self,
        since: datetime | str | None = None,
        until: datetime | str | None = None,
        least_level: int | None = None,
        agent: str | None = None,
        technique: str | None = None,
    ) -> DataFrame:
        """Findings with since < ts <= until, a level from least_level on, of an agent, with a technique.

        Without conditions it is all findings. Files are chosen by what is told
        of them; the conditions are then applied to the rows.
        """
        wanted, keep = F.lit(True), F.lit(True)
        if since is not None:
            at = F.lit(since).cast("timestamp")
            wanted, keep = wanted & (F.col("ts") > at), keep & (F.col("high_ts") > at)
        if until is not None:
            at = F.lit(until).cast("timestamp")
            wanted, keep = wanted & (F.col("ts") <= at), keep & (F.col("low_ts") <= at)
        if least_level is not None:
            wanted = wanted & (F.col("rule_level") >= least_level)
            keep = keep & (F.col("high_level") >= least_level)
        if agent is not None:
            wanted = wanted & (F.col("agent_name") == agent)
            keep = keep & (F.col("low_agent") <= agent) & (F.col("high_agent") >= agent)
        if technique is not None:
            wanted = wanted & F.array_contains("mitre_ids", technique)
        segments = self.log.live()
        taken = self._taken(segments)
        tail = lg.read_ledger(self.spark, self.path)
        for run, end in taken.items():
            tail = tail.filter((F.col("run") != run) | (F.col("batch_id") >= end))
        found = lg.findings(tail)
        if segments:
            if any(x is not None for x in (since, until, least_level, agent, technique)):
                files = self.files_for(segments, keep, technique)
            else:
                files = [f"{self.root}/data/{s['name']}" for s in segments]
            if files:
                found = found.unionByName(self.spark.read.schema(FINDING).parquet(*files))
        return found.filter(wanted)
