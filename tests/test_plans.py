"""The physical plans the scale of the jobs depends on."""

import re

from pyspark.sql import functions as F

from tidewatch.operators import findings as fq
from tidewatch.operators.normalize import alerts_of, classify
from tidewatch.operators.shuffles import first_copy, lookup_join, ranked_with_total
from tidewatch.plans import derived as d
from tidewatch.schemas import LEDGER
from tidewatch.sinks import ledger as lg


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_first_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    alerts = alerts_of(classify(d.records(spark, sf_dir)))
    text = plan(first_copy(alerts, lg.KEYS, lg.POSITION))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange hashpartitioning(manager") < text.index("Partial")


def test_a_group_is_cut_in_tasks_then_by_salt_then_whole(spark):
    rows = spark.createDataFrame([("all", i, 1, "x") for i in range(50)], "source string, queue_key long, size long, body string")
    text = re.sub(r"#\d+L?", "", plan(ranked_with_total(rows, ["source"], ["queue_key"], F.col("size"), 10, descending=True)))
    salted, whole = "Exchange hashpartitioning(source, _salt", "Exchange hashpartitioning(source"
    assert text.count("WindowGroupLimit") == 4  # before and after both shuffles
    assert text.index(whole) < text.index(salted) < text.rindex("WindowGroupLimit")  # the root stands first


def test_documents_are_read_once(spark, sf_dir):
    alerts = alerts_of(classify(d.records(spark, sf_dir)))
    assert plan(alerts).count("from_json(") == 1


def test_small_lookup_is_broadcast_without_shuffling_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    text = plan(lookup_join(rows, spark.range(5).select(F.col("id").alias("k")), ["k"], "left_anti"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_history_reads_only_keys_of_earlier_batches(spark, tmp_path):
    spark.createDataFrame([], LEDGER).drop("run", "batch_id").write.parquet(f"{tmp_path}/ledger/run=r/batch_id=1")
    history = lg.read_ledger(spark, str(tmp_path), below=7).filter("disposition = 'inserted'")
    text = plan(history.select(*lg.KEYS))
    assert "ReadSchema: struct<manager:string,alert_id:string,disposition:string>" in text
    assert "EqualTo(disposition,inserted)" in text
    assert "(batch_id" in text.split("PartitionFilters")[1].split("]")[0]


def test_top_severe_is_a_top_k(spark, tmp_path):
    spark.createDataFrame([], LEDGER).drop("run", "batch_id").write.parquet(f"{tmp_path}/ledger/run=r/batch_id=1")
    rows = lg.findings(lg.read_ledger(spark, str(tmp_path)))
    text = plan(fq.top_severe(rows, "2025-03-04 06:00:00"))
    assert "TakeOrderedAndProject" in text
    assert "GreaterThan(ts," in text and "raw" not in text.split("ReadSchema")[1]
