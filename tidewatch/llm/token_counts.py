"""Token counts of documents, kept in a cache of digests so that each content is encoded once for each tokenizer.

The cache is a folder of Parquet files under `version=<digest of tokenizer and
library>/batch=<a new name>`; its rows are the digest of a normalised content
and its count. A run joins the digests of its documents with the stored ones,
encodes one text of each digest that is missing, and appends these counts.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import python_ready, slices, stored, texts_of

#: Tokens above which a document is marked.
LIMIT = 512
#: Texts that the tokenizer gets at once.
TEXTS_AT_ONCE = 256
CACHE = "digest binary, n_tokens long"


def _file_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def tokenizer_version(path: str) -> str:
    """A digest of all that a count depends on besides the text: the file's content, the library and its version."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    release = __import__(library).__version__
    return hashlib.sha256(f"{library} {release} {_file_digest(path)}".encode()).hexdigest()


class Counter:
    """Counts tokens with the library that a file belongs to, and knows which texts it cannot tell apart."""

    def __init__(self, path: str):
        self.pieces = self.words = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.words = Tokenizer.from_file(path)
        self.words.no_truncation()
        self.words.no_padding()
        self.added = [t.content for t in self.words.get_added_tokens_decoder().values()]

    @property
    def normalises(self) -> bool:
        return self.pieces is not None or self.words.normalizer is not None

    def normalised(self, text: str) -> str:
        """What the tokenizer makes of a text before it cuts it; texts that agree in it have equal counts.

        Added tokens are found in the text as it is, so a text that could hold
        one, before or after, stands for itself.
        """
        if self.pieces is not None:
            return self.pieces.normalize(text)
        if self.words.normalizer is None:
            return text
        plain = self.words.normalizer.normalize_str(text)
        return "\0" + text if any(a in text or a in plain for a in self.added) else plain

    def counts(self, texts: list[str]) -> list[int]:
        if self.pieces is not None:
            return [len(ids) for ids in self.pieces.encode(texts, num_threads=1)]
        return [len(e.ids) for e in self.words.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One for each worker, which keeps it from task to task."""
    return Counter(path)


def with_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text and digest, the SHA-256 of the normalised text.

    A tokenizer without a normaliser takes texts as they are, and their
    digests need no Python.
    """
    rows = texts_of(docs)
    if not counter(path).normalises:
        return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = counter(path)
        for frame in slices(batches):
            yield frame.assign(
                digest=[hashlib.sha256(made.normalised(t).encode("utf-8", "surrogatepass")).digest() for t in frame["text"]]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, text string, digest binary")


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """digest and n_tokens of one tokenizer version, a row for each digest.

    Runs beside each other may both have stored a digest; its counts are equal.
    """
    folder = f"{cache.rstrip('/')}/version={version}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], CACHE)
    rows = spark.read.schema(f"{CACHE}, batch string").parquet(folder)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _append(counts: DataFrame, cache: str, version: str) -> None:
    """A folder for each run: a run that fails leaves no rows, and none can harm another's."""
    counts.write.parquet(f"{cache.rstrip('/')}/version={version}/batch={uuid.uuid4().hex}")


def encode(texts: DataFrame, path: str) -> DataFrame:
    """digest and n_tokens of texts, a row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = counter(path)
        for frame in slices(batches):
            counts: list[int] = []
            for begin in range(0, len(frame), TEXTS_AT_ONCE):
                counts += made.counts(frame["text"].iloc[begin : begin + TEXTS_AT_ONCE].tolist())
            yield pd.DataFrame({"digest": frame["digest"].to_numpy(), "n_tokens": counts})

    return texts.select("digest", "text").mapInPandas(run, CACHE)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache: str, limit: int = LIMIT, version: Callable[[str], str] = tokenizer_version
) -> DataFrame:
    """A row for each document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) and was_cached.

    Counts are those of the library without begin, end or other special tokens
    added; strings of special tokens inside a text are taken as the library
    does by itself. Null texts are empty and have no tokens. Repeated rows and
    rows without an id each give their own row and share one count. Other
    columns are not read. An empty table gives no rows and adds nothing.

    cache: a folder that driver and executors share. Every count is read from
    it, new ones after they were appended. tokenizer_path must be readable on
    every machine; another file content or library version is another cache.
    """
    spark = docs.sparkSession
    python_ready(spark)
    named = version(tokenizer_path)
    rows = with_digests(docs, tokenizer_path)
    keys = stored(
        rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests"
    )
    known = cached(spark, cache, named)
    missing = stored(keys.select("digest").distinct().join(known, "digest", "left_anti"), "misses")
    # copies are dropped before texts are shuffled, so that a text with very many rows is sent once by a task
    texts = rows.groupBy("digest").agg(F.first("text").alias("text"))
    if not missing.isEmpty():
        _append(encode(texts.join(missing, "digest", "left_semi"), tokenizer_path), cache, named)
    counts = cached(spark, cache, named)
    fresh = missing.select("digest", F.lit(False).alias("_cached"))
    return (
        keys.join(counts.join(fresh, "digest", "left"), "digest", "left")
        .select(
            "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
            F.coalesce("_cached", F.lit(True)).alias("was_cached"),
        )
    )


def compact(spark: SparkSession, cache: str, tokenizer_path: str, files: int = 1) -> str:
    """Write the cache of a tokenizer once more, as one batch of few files under another folder, and return that."""
    named = tokenizer_version(tokenizer_path)
    target = f"{cache.rstrip('/')}-{uuid.uuid4().hex}"
    cached(spark, cache, named).repartition(files, "digest").write.parquet(f"{target}/version={named}/batch=compact")
    return target
