"""A table of which every batch changes some rows and readers want the last state of each.

A batch writes the rows it changed into a folder of its own, so that its work
goes with the batch and a replay replaces what it wrote. Every so many batches
the last states are put together into a base. What a base has taken in is
removed one merge later, so that readers that began before still find it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Batches between two merges.
MERGE_EVERY = 16


class LatestTable:
    """Rows named by `keys` below a folder; one streaming query writes them.

    schema: columns of the rows, the keys included, as DDL.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, merge_every: int = MERGE_EVERY):
        self.spark, self.path, self.keys, self.merge_every = spark, path.rstrip("/"), list(keys), merge_every
        self.schema = f"{schema}, batch_id long"

    def _hadoop(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _numbers(self, folder: str, complete: bool = True) -> list[int]:
        """Numbers of the finished subfolders, which are called <something>=<number>."""
        fs, path = self._hadoop(folder)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        found = [(n, int(n.partition("=")[2])) for n in names if n.partition("=")[2].isdigit()]
        return sorted(k for n, k in found if not complete or fs.exists(self._hadoop(f"{folder}/{n}/_SUCCESS")[1]))

    def _states(self, below: int | None = None) -> DataFrame:
        """The last base and what came after it; with a number, only batches before that one."""
        bases = [n for n in self._numbers("base") if below is None or n <= below]
        since = bases[-1] if bases else 0
        names = [f"changes/batch_id={n}" for n in self._numbers("changes") if n >= since and (below is None or n < below)]
        names += [f"base/upto={since}"] if bases else []
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])

    def _latest(self, states: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*states.columns), "batch_id").alias("last")
        return states.groupBy(*self.keys).agg(last).select("last.*")

    def read(self) -> DataFrame:
        """The last state of every row."""
        return self._latest(self._states()).drop("batch_id")

    def last(self) -> int:
        """The number of the last batch that was written, 0 before the first."""
        return max([0, *self._numbers("changes"), *self._numbers("base")])

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows that a batch changed. A batch that is written again replaces them."""
        numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        if batch_id and batch_id % self.merge_every == 0:
            self._merge(batch_id)

    def _merge(self, upto: int) -> None:
        before = [n for n in self._numbers("base", complete=False) if n < upto]
        self._latest(self._states(upto)).write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
        if not before:
            return
        for n in self._numbers("changes", complete=False):
            if n < before[-1]:
                self._remove(f"changes/batch_id={n}")
        for n in before[:-1]:
            self._remove(f"base/upto={n}")

    def _remove(self, name: str) -> None:
        fs, path = self._hadoop(name)
        fs.delete(path, True)


