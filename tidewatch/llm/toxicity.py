"""Toxicity scores from the nearest labelled examples, by exact TF-IDF cosine over a block-max index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import crc_rest, python_ready, stored, texts_of
from tidewatch.operators.shuffles import is_small, lookup_join

#: Of five parts of the ids, the first is held out.
FOLDS = 5
#: Labelled texts kept as examples, toxic and other, at most. A bounded sample by hash.
EXAMPLES = 3000
#: Least lean of a term, so that terms spread alike over both labels keep a small weight and none is dropped.
LEAST_LEAN = 1e-6
NEAREST, BLOCK = 32, 64
#: Most frequent terms of the examples by which they are divided into blocks of texts that are alike.
DIVIDING = 512
#: Weight of the rate among all labelled texts, in units of a neighbour of similarity 1.
PRIOR_WEIGHT = 0.5
EVIDENCE = 3
#: Bits that a labelled id has in the filter of ids, those of one of Spark's bitmaps, and the most bitmaps (64 MB).
ID_BITS, BITMAP_BITS, BITMAPS = 16, 32768, 16384

TERM = re.compile(r"[^\W\d_]+")


def with_likely_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is among the ids, and a few others, found by a bitmap of the ids' hashes. Nothing is shuffled."""
    maps = min(BITMAPS, max(1, -(-ids.count() * ID_BITS // BITMAP_BITS)))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(maps * BITMAP_BITS))
    at = ids.select(F.floor(place / BITMAP_BITS).alias("_map"), (place % BITMAP_BITS).alias("_bit"))
    bitmaps = at.groupBy("_map").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits"))
    byte = F.expr("conv(hex(substring(_bits, int(_bit div 8) + 1, 1)), 16, 10)").cast("int")
    placed = rows.withColumns({"_map": F.floor(place / BITMAP_BITS), "_bit": place % BITMAP_BITS})
    met = placed.join(F.broadcast(bitmaps), "_map").filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1)
    return met.select(*rows.columns)


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the rows to learn from, copies of a text counted once by their mean label.

    Where the labels are too many to be broadcast, texts whose id can have none
    are left out before the others are shuffled.
    """
    marks = labels.filter((crc_rest("doc_id", FOLDS) != 0) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("double").alias("toxic")
    )
    texts = texts_of(docs).filter(crc_rest("doc_id", FOLDS) != 0)
    rows = lookup_join(texts if is_small(marks) else with_likely_ids(texts, marks), marks, ["doc_id"])
    return rows.groupBy(F.xxhash64("text").alias("text_hash")).agg(
        F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.avg("toxic").alias("toxic")
    ).withColumn("toxic", F.round("toxic").cast("int"))


def terms_of(column: str = "text"):
    return F.array_distinct(F.regexp_extract_all(F.lower(column), F.lit("\\p{L}+"), 0))


def counted_terms(docs: DataFrame, rows: DataFrame, examples: DataFrame, n_texts: int, n_toxic: int) -> DataFrame:
    """term, n (documents that have it) and lean of every term of the examples.

    n is counted over all documents, for the inverse document frequency. lean
    is the G statistic of the term against the label, either way, over all
    labelled texts; it only weighs terms. The terms of the examples are bounded
    as these are, and others are not shuffled.
    """
    wanted = examples.select(F.explode(terms_of()).alias("term")).distinct()
    zero, one = F.lit(0), F.lit(1)
    every = texts_of(docs).select(F.explode(terms_of()).alias("term"), one.alias("n"), zero.alias("m"), zero.alias("k"))
    labelled = rows.select(F.explode(terms_of()).alias("term"), zero.alias("n"), one.alias("m"), F.col("toxic").alias("k"))
    counts = every.unionAll(labelled).join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("n", "m", "k")]
    )

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    m, k = F.col("m").cast("double"), F.col("k").cast("double")
    share = n_toxic / n_texts
    inside = part(k, m * share) + part(m - k, m * (1 - share))
    outside = part(n_toxic - k, (n_texts - m) * share) + part(
        (n_texts - n_toxic) - (m - k), (n_texts - m) * (1 - share)
    )
    return counts.select("term", "n", F.greatest(2 * (inside + outside), F.lit(LEAST_LEAN)).alias("lean"))


def ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of several ranges one after another, and the ranges' lengths."""
    n = end - begin
    numbers = np.repeat(begin - (np.cumsum(n) - n), n)
    numbers += np.arange(len(numbers))
    return numbers, n


def alike(rows: np.ndarray, size: int) -> np.ndarray:
    """The numbers of the rows in an order in which each run of size holds rows that are alike.

    They are halved, at a multiple of the size, along the direction in which they differ most.
    """
    parts, order = [np.arange(len(rows))], []
    while parts:
        own = parts.pop()
        if len(own) <= size:
            order.append(own)
            continue
        apart = rows[own] - rows[own].mean(axis=0)
        way = apart[np.argmax((apart * apart).sum(axis=1))].copy()
        for _ in range(8):
            way = apart.T @ (apart @ way)
            way /= max(float(np.linalg.norm(way)), 1e-12)
        own = own[np.argsort(apart @ way, kind="stable")]
        half = -(-len(own) // size) // 2 * size
        parts += [own[half:], own[:half]]
    return np.concatenate(order) if order else np.zeros(0, dtype=np.int64)


class ExampleIndex:
    """Postings of the examples' vectors, in blocks whose greatest weights bound what a block can score."""

    def __init__(self, terms: list[tuple[str, int]], n_docs: int, examples: list[tuple[int, str, int]],
                 scale: tuple[float, float], rate_without: float, leans: list[float] | np.ndarray | None = None):
        self.number = {t: i for i, (t, _) in enumerate(terms)}
        self.idf = np.array([np.log((n_docs + 1) / (n + 0.5)) for _, n in terms])
        self.idf *= 1.0 if leans is None else np.array(leans)
        # vectors one after another in two buffers, so that the driver does not hold thousands of small arrays
        terms_held, weights_held, vectors, end = bytearray(), bytearray(), [], 0
        for doc_id, text, toxic in examples:
            at, weight = self.vector(text)
            if len(at):
                terms_held += at.tobytes()
                weights_held += weight.tobytes()
                vectors.append((int(at[np.argmax(weight)]), doc_id, toxic, end, len(at)))
                end += len(at)
        vectors.sort(key=lambda v: v[:2])  # equal cosines go by this order
        begin, length = (np.array([v[i] for v in vectors], dtype=np.int64) for i in (3, 4))
        held, _ = ranges(begin, begin + length)
        term = np.frombuffer(terms_held, dtype=np.int64)[held]
        weight = np.frombuffer(weights_held, dtype=np.float64)[held]
        del terms_held, weights_held, held
        example = np.repeat(np.arange(len(vectors)), length)
        self.rank = self._in_blocks(term, example, weight, len(vectors))
        vectors = [vectors[i] for i in self.rank]
        place = np.empty_like(self.rank)
        place[self.rank] = np.arange(len(vectors))
        example = place[example]
        self.doc_id = np.array([v[1] for v in vectors], dtype=np.int64)
        self.toxic = np.array([v[2] for v in vectors], dtype=np.int64)
        self.vote = np.where(self.toxic == 1, scale[1], scale[0])
        self.rate_without = rate_without
        self.n_blocks = max(1, -(-len(vectors) // BLOCK))
        term *= max(1, len(vectors))
        term += example  # an example has a term once, so that these numbers differ
        del example
        order = np.argsort(term)
        self.weight, term = weight[order], term[order]
        del weight, order
        term, self.example = np.divmod(term, max(1, len(vectors)))
        # a cell is a term in a block; only cells with postings are held
        cell = term * self.n_blocks + self.example // BLOCK
        del term
        heads = np.nonzero(np.diff(cell, prepend=-1))[0]
        self.starts = np.append(heads, len(cell))
        self.block = (cell[heads] % self.n_blocks).astype(np.int32)
        self.bound = np.maximum.reduceat(self.weight, heads) if len(heads) else np.zeros(0)
        self.cells = np.searchsorted(cell[heads] // self.n_blocks, np.arange(len(terms) + 1))

    def _in_blocks(self, term: np.ndarray, example: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """The examples in an order by which those of a block are alike, which tightens the bounds."""
        if n <= BLOCK:
            return np.arange(n)
        often = np.bincount(term, minlength=len(self.idf))
        column = np.full(len(self.idf), -1)
        common = np.argsort(-often, kind="stable")[:DIVIDING]
        column[common] = np.arange(len(common))
        held = column[term] >= 0
        rows = np.zeros((n, len(common)), dtype=np.float32)
        rows[example[held], column[term[held]]] = weight[held]
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        return alike(rows, BLOCK)

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = Counter(TERM.findall(text.lower()))
        at = np.fromiter(map(self.number.get, found, repeat(-1)), dtype=np.int64, count=len(found))
        times = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        order = np.argsort(at)
        order = order[np.searchsorted(at[order], 0) :]
        at, times = at[order], times[order]
        weight = (1 + np.log(times)) * self.idf[at]
        return at, weight / np.sqrt((weight**2).sum()) if len(at) else weight

    def _scores(self, cells: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the cells, each with the text's weight of its term: exact cosines of the examples in whole blocks."""
        if not len(cells):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        # cells beside each other with one weight are one run of postings
        last = np.flatnonzero(np.append((np.diff(cells) != 1) | (weight[1:] != weight[:-1]), True))
        head = np.append(0, last[:-1] + 1)
        posting, n = ranges(self.starts[cells[head]], self.starts[cells[last] + 1])
        part = self.weight.take(posting)
        part *= np.repeat(weight[head], n)
        sums = np.bincount(self.example.take(posting), weights=part, minlength=1)
        found = np.flatnonzero(sums)
        return found, sums[found]

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the highest cosine, equal ones by their number.

        The blocks of the highest bounds are scored first; then only those
        blocks that could still hold one of the k.
        """
        cells, n = ranges(self.cells[at], self.cells[at + 1])
        weight, block = np.repeat(weight, n), self.block[cells]
        bounds = np.bincount(block, weights=weight * self.bound[cells], minlength=self.n_blocks)
        first = np.zeros(self.n_blocks, dtype=bool)
        first[np.argsort(-bounds, kind="stable")[: 2 + k // BLOCK]] = True
        here = first[block]
        found, scores = self._scores(cells[here], weight[here])
        least = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        here = ((bounds >= least - 1e-9) & (bounds > 0) & ~first)[block]
        if here.any():
            more, more_scores = self._scores(cells[here], weight[here])
            found, scores = np.concatenate([found, more]), np.concatenate([scores, more_scores])
        if len(found) > k:  # equal ones of the last score stay
            kept = scores >= np.partition(scores, -k)[-k]
            found, scores = found[kept], scores[kept]
        best = np.lexsort((self.rank[found], -scores))[:k]
        return found[best], scores[best]

    def judge(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The score and the nearest examples (doc_id, toxic, similarity)."""
        at, weight = self.vector(text)
        if not len(at) or not len(self.doc_id):
            return self.rate_without, []
        found, scores = self.nearest(at, weight)
        votes = scores**2 * self.vote[found]
        score = (votes @ self.toxic[found] + PRIOR_WEIGHT * self.rate_without) / (votes.sum() + PRIOR_WEIGHT)
        shown = zip(found[:EVIDENCE].tolist(), scores[:EVIDENCE].tolist(), strict=True)
        return float(min(max(score, 0.0), 1.0)), [(int(self.doc_id[i]), int(self.toxic[i]), s) for i, s in shown]


def learn(docs: DataFrame, labels: DataFrame) -> ExampleIndex:
    """The index of examples, at most 2 * EXAMPLES texts with all their terms; terms are counted over whole tables."""
    rows = stored(labelled_texts(docs, labels), "labelled")
    n_texts, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic or n_toxic == n_texts:
        return ExampleIndex([], n_texts, [], (1.0, 1.0), float(bool(n_toxic)) if n_texts else 0.0)
    place = F.pmod(F.xxhash64(F.lit(17), "text_hash"), F.lit(2**20))
    totals = n_texts - n_toxic, n_toxic
    parts = [int(min(1.0, 0.9 * EXAMPLES / total) * 2**20) for total in totals]  # so that more than EXAMPLES do not occur
    own = rows.filter(place < F.when(F.col("toxic") == 1, parts[1]).otherwise(parts[0]))
    # in columns, as rows of Python take several times the memory
    examples = sorted(zip(*(c.to_pylist() for c in own.select("doc_id", "text", "toxic").toArrow().columns), strict=True))
    taken = Counter(toxic for *_, toxic in examples)
    scale = [total / max(1, taken[label]) for label, total in enumerate(totals)]
    mean = (scale[0] + scale[1]) / 2
    counts = counted_terms(docs, rows, own, n_texts, n_toxic).toArrow().sort_by("term")
    terms, leans = list(zip(*(counts[c].to_pylist() for c in ("term", "n")), strict=True)), counts["lean"].to_numpy()
    del counts
    return ExampleIndex(
        terms, docs.count(), examples, (scale[0] / mean, scale[1] / mean), n_toxic / n_texts, leans,
    )


SCORES = "score double, predicted int, evidence array<struct<doc_id:long,toxic:int,similarity:double>>"


def score(docs: DataFrame, labels: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns named in more, held_out, score, predicted and evidence of each document.

    Vectors hold every term of the examples, by frequency, inverse document
    frequency and lean. The vote of a neighbour is its squared cosine, times
    what its label's sample stands for; a text that shares no term with any
    example, null and empty ones included, gets the toxic rate of all labelled
    texts. Labels of rows with
    crc32(doc_id) mod 5 = 0 are not read, nor those of rows without an id.
    Ties go by example. Repeated rows are scored alike. Without labels of both
    kinds the score is the one label seen (0 without any). An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    python_ready(spark)
    index = spark.sparkContext.broadcast(learn(docs, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = index.value
        for frame in batches:
            found = [own.judge(t) for t in frame.pop("text")]
            frame["score"] = np.array([f[0] for f in found], dtype=np.float64)
            frame["predicted"] = (frame["score"] >= 0.5).astype(np.int32)
            frame["evidence"] = [
                [{"doc_id": d, "toxic": t, "similarity": s} for d, t, s in f[1]] for f in found
            ]
            yield frame

    rows = texts_of(docs, *more).withColumn("held_out", crc_rest("doc_id", FOLDS) == 0)
    rows = rows.select("doc_id", *more, "held_out", "text")
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema.fields]
    return rows.mapInPandas(run, ", ".join([*columns, SCORES]))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows and columns of the documents whose score stays below one half; see score()."""
    spark = docs.sparkSession
    python_ready(spark)
    index = spark.sparkContext.broadcast(learn(docs, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = index.value
        for frame in batches:
            yield frame[[own.judge(t or "")[0] < 0.5 for t in frame["text"]]]

    return docs.mapInPandas(run, docs.schema)
