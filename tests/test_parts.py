from pyspark.sql import functions as F

from tidewatch.plans import queries


class _Drained:
    def awaitTermination(self):
        return True


def test_files_of_the_streamed_parts_hold_about_as_many_records(spark, tmp_path, monkeypatch):
    """Re-deliveries and junk are few; files of their own would leave the tasks that read them without work."""
    events = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("ts"),
        (F.col("id") % 90).alias("user_id"), F.lit("click").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    events.write.parquet(f"{tmp_path}/tables/events.parquet")
    monkeypatch.setattr(queries, "FILE_RECORDS", 250, raising=False)
    monkeypatch.setattr(queries, "_scratch", lambda spark, name: f"{tmp_path}/{name}")
    queries._ledger_through_stream(spark, f"{tmp_path}/tables", lambda stream, target, state: _Drained())
    files = spark.read.parquet(f"{tmp_path}/records").groupBy(F.col("_metadata.file_path")).count()
    sizes = sorted(r["count"] for r in files.collect())
    assert sum(sizes) == queries.d.records(spark, f"{tmp_path}/tables").count()
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[0]
