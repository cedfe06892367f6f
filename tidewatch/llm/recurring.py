"""Sequences that start more than once in a corpus: how both removers of repeated text find theirs.

A window is a fixed number of consecutive tokens (words or bytes) of one
document. Each window has an anchor: the leftmost of its short grams with the
least hash. Equal windows have equal anchors, at the same place in them, so
only windows whose anchor occurs again need to be compared, and only with
those of the same anchor. Consecutive windows with one anchor are a run.

Runs whose anchor recurs are sent to the shard of their anchor with the text
they cover. A shard finds the windows that start twice in it. An anchor with
very many runs is spread over several shards by document; the different
windows of these shards are then compared by their hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import KEYS, keyed, mixed, python_ready, slices, stored, tasks_of

#: Tokens hashed at once, which bounds a task's memory whatever a document's length.
UNIT = 1 << 19
PLACE_BITS = np.uint64(24)
PLACE_MASK = np.uint64((1 << 24) - 1)
STEP = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    n = 2 * UNIT
    up, down = np.full(n, STEP, dtype=np.uint64), np.full(n, pow(STEP, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def prefix_sums(tokens: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens * powers()[0][: len(tokens)], out=sums[1:])
    return sums


def gram_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive tokens; tokens are 64-bit hashes themselves."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_sums(tokens)
    return mixed((sums[k:] - sums[:-k]) * powers()[1][:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    blocks = -(-n // width)
    grid = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    grid[:n] = values
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Runs:
    """Runs of windows with one anchor in some documents: arrays doc, start, n, anchor, times."""

    def __init__(self, docs: list[np.ndarray], lift: Callable[[np.ndarray], np.ndarray], window: int, k: int):
        self.window, self.k, found, unit, size = window, k, [], [], 0
        for number, tokens in enumerate(docs):
            for begin in range(0, max(1, len(tokens) - window + 1), UNIT):
                part = tokens[begin : begin + UNIT + window - 1]
                if len(part) < window:
                    continue
                if size + len(part) > UNIT and unit:
                    found.append(self._unit(unit, lift))
                    unit, size = [], 0
                unit.append((number, begin, part))
                size += len(part)
        if unit:
            found.append(self._unit(unit, lift))
        both = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        self.doc, self.start, self.n, self.anchor, self.times = both

    def _unit(self, unit: list[tuple[int, int, np.ndarray]], lift: Callable) -> tuple[np.ndarray, ...]:
        lengths = np.array([len(p) for _, _, p in unit])
        offsets = np.cumsum(lengths) - lengths
        grams = gram_hashes(lift(np.concatenate([p for _, _, p in unit])), self.k)
        packed = (grams & ~PLACE_MASK) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_least(packed, self.window - self.k + 1) & PLACE_MASK).astype(np.int64)
        valid = np.zeros(len(at), dtype=bool)
        for o, n in zip(offsets, lengths, strict=True):
            valid[o : o + n - self.window + 1] = True
        starts = np.nonzero(valid)[0]
        anchors = grams[at[starts]]
        fresh = np.ones(len(starts), dtype=bool)  # neighbours with one anchor are one run, be it at two places
        fresh[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
        moved = np.ones(len(starts), dtype=np.int64)
        moved[1:] = at[starts[1:]] != at[starts[:-1]]
        heads = np.nonzero(fresh)[0]
        n = np.diff(np.append(heads, len(starts)))
        which = np.searchsorted(offsets, starts[heads], side="right") - 1
        numbers, begins = np.array([u[0] for u in unit]), np.array([u[1] for u in unit])
        return (
            numbers[which], starts[heads] - offsets[which] + begins[which], n,
            anchors[heads], np.add.reduceat(moved, heads) if len(heads) else heads,
        )


class Tokens:
    """How a kind of text is cut: tokens of texts, their hashes, and how a run's tokens are sent to its shard."""

    window: int
    k: int

    def read(self, texts: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def lift(self, tokens: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def send(self, tokens: np.ndarray) -> bytes:
        raise NotImplementedError

    def sent(self, content: bytes) -> np.ndarray:
        raise NotImplementedError

    def repeated(self, contents: list[np.ndarray], times: np.ndarray) -> list[np.ndarray]:
        """For each content, which of its windows start twice or more in all of them; times: how often each occurs."""
        raise NotImplementedError

    def window_hashes(self, content: np.ndarray) -> np.ndarray:
        """64-bit hashes of the windows of what was sent."""
        out, step = [], UNIT
        for begin in range(0, len(content) - self.window + 1, step):
            part = content[begin : begin + step + self.window - 1].astype(np.uint64)
            out.append(gram_hashes(mixed(part + np.uint64(STEP)), self.window))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)

    def runs(self, docs: list[np.ndarray]) -> Runs:
        return Runs(docs, self.lift, self.window, self.k)


RUN_ROWS = "key_id long, key_text int, start int, anchor long, times int"
SEGMENT_ROWS = "key_id long, key_text int, start int, anchor long, n int, split boolean, shard int, content binary"
SPAN_ROWS = "key_id long, key_text int, start int, until int"
FOUND_ROWS = f"{SPAN_ROWS}, part int, open binary"
OPEN = np.dtype([("key_id", "<i8"), ("key_text", "<i4"), ("start", "<i4"), ("hash", "<u8")])

#: Runs of one anchor in a shard, and runs in a shard, about.
RUNS_OF_ANCHOR, RUNS_OF_SHARD = 2000, 3000


def runs_of(docs: DataFrame, tokens: Tokens) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(batches):
            found = tokens.runs(tokens.read(frame["text"].tolist()))
            yield pd.DataFrame({
                "key_id": frame["key_id"].to_numpy()[found.doc],
                "key_text": frame["key_text"].to_numpy()[found.doc],
                "start": found.start.astype(np.int32),
                "anchor": found.anchor.view(np.int64),
                "times": found.times.astype(np.int32),
            })

    return docs.select(*KEYS, "text").mapInPandas(run, RUN_ROWS)


def segments_of(docs: DataFrame, flagged: DataFrame, tokens: Tokens, shards: int) -> DataFrame:
    """The runs that were found to have a recurring anchor, with their tokens and shard."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(batches, 500_000):
            texts = tokens.read(frame["text"].tolist())
            found = tokens.runs(texts)
            ends = np.searchsorted(found.doc, np.arange(len(frame) + 1))
            columns = {c: [] for c in ("i", "start", "anchor", "n", "splits", "content")}
            for i, marks in enumerate(frame["marks"]):
                splits = {m["start"]: m["splits"] for m in marks}
                for r in range(ends[i], ends[i + 1]):
                    start = int(found.start[r])
                    if start in splits:
                        n = int(found.n[r])
                        columns["i"].append(i)
                        columns["start"].append(start)
                        columns["n"].append(n)
                        columns["anchor"].append(found.anchor[r])
                        columns["splits"].append(splits[start])
                        columns["content"].append(tokens.send(texts[i][start : start + n + tokens.window - 1]))
            i = np.array(columns["i"], dtype=np.int64)
            ids, anchors = frame["key_id"].to_numpy()[i], np.array(columns["anchor"], dtype=np.uint64)
            splits = np.array(columns["splits"], dtype=np.uint64)
            own = mixed(ids.view(np.uint64) + np.uint64(STEP)) % np.maximum(splits, np.uint64(1))
            yield pd.DataFrame({
                "key_id": ids,
                "key_text": frame["key_text"].to_numpy()[i],
                "start": np.array(columns["start"], dtype=np.int32),
                "anchor": anchors.view(np.int64),
                "n": np.array(columns["n"], dtype=np.int32),
                "split": splits > 1,
                "shard": (mixed(anchors + own * np.uint64(STEP)) % np.uint64(shards)).astype(np.int32),
                "content": columns["content"],
            })

    return docs.select(*KEYS, "text").join(flagged, KEYS).mapInPandas(run, SEGMENT_ROWS)


def found_in_shards(segments: DataFrame, tokens: Tokens, parts: int) -> DataFrame:
    """Stretches [start, until) of recurring windows' tokens.

    Of split anchors, each different window also comes once from each of its
    shards, packed by parts of the range of its hash: it may start elsewhere.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        numbers: dict[bytes, int] = {}
        which = np.array([numbers.setdefault(c, len(numbers)) for c in frame["content"]], dtype=np.int64)
        contents = [tokens.sent(c) for c in numbers]
        marks = tokens.repeated(contents, np.bincount(which, minlength=len(contents)))
        base, split = frame["start"].to_numpy(), frame["split"].to_numpy()
        ids, texts = frame["key_id"].to_numpy(), frame["key_text"].to_numpy()
        bounds, told, starts, untils, owners, left = [], set(), [], [], [], []
        for mark in marks:
            edges = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
            bounds.append((np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0] + tokens.window - 1))
        for row, c in enumerate(which):
            a, b = bounds[c]
            starts.append(a + base[row])
            untils.append(b + base[row])
            owners.append(np.full(len(a), row))
            if split[row] and c not in told:
                told.add(c)
                own = tokens.window_hashes(contents[c])
                one = np.empty(len(own), dtype=OPEN)
                one["key_id"], one["key_text"], one["hash"] = ids[row], texts[row], own
                one["start"] = base[row] + np.arange(len(own))
                left.append(one)
        owner = np.concatenate(owners)
        out = pd.DataFrame({
            "key_id": ids[owner], "key_text": texts[owner], "start": np.concatenate(starts).astype(np.int32),
            "until": np.concatenate(untils).astype(np.int32), "part": np.int32(-1), "open": None,
        })
        if left:
            every = np.concatenate(left)
            every = every[np.unique(every["hash"], return_index=True)[1]]
            own = (every["hash"] % np.uint64(parts)).astype(np.int64)
            every = every[np.argsort(own, kind="stable")]
            found, n = np.unique(own, return_counts=True)
            stops = np.cumsum(n)
            packed = pd.DataFrame({
                "key_id": 0, "key_text": np.int32(0), "start": np.int32(0), "until": np.int32(0),
                "part": found.astype(np.int32), "open": [every[b - k : b].tobytes() for b, k in zip(stops, n, strict=True)],
            })
            out = pd.concat([out, packed]) if len(out) else packed
        return out

    return segments.groupBy("shard").applyInPandas(run, FOUND_ROWS)


def closed(found: DataFrame, tokens: Tokens) -> DataFrame:
    """The windows of split anchors that start in more than one shard."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([np.frombuffer(b, dtype=OPEN) for b in frame["open"]])
        _, back, n = np.unique(every["hash"], return_inverse=True, return_counts=True)
        every = every[n[back] > 1]
        return pd.DataFrame({
            "key_id": every["key_id"], "key_text": every["key_text"], "start": every["start"],
            "until": every["start"] + np.int32(tokens.window),
        })

    return found.filter("part >= 0").groupBy("part").applyInPandas(run, SPAN_ROWS)


def repeats(docs: DataFrame, tokens: Tokens, keep_runs: bool) -> DataFrame:
    """key_id, key_text and spans (array of start, until) of each document with tokens in recurring windows.

    keep_runs: store the runs between their two uses instead of computing
    them twice, which is quicker and takes more disk.
    """
    spark = docs.sparkSession
    python_ready(spark)
    rows = keyed(docs)
    runs = runs_of(rows, tokens)
    if keep_runs:
        runs = stored(runs, "runs")
    counts = runs.groupBy("anchor").agg(F.sum("times").alias("n_runs")).filter("n_runs > 1")
    splits = F.when(F.col("n_runs") > RUNS_OF_ANCHOR, F.ceil(F.col("n_runs") / RUNS_OF_ANCHOR)).otherwise(1)
    marks = stored(
        runs.join(counts, "anchor")
        .groupBy(*KEYS)
        .agg(F.collect_set(F.struct("start", splits.cast("int").alias("splits"))).alias("marks")),
        "marks",
    )
    total = marks.agg(F.sum(F.size("marks"))).first()[0] or 0
    shards = max(4 * tasks_of(spark), int(total) // RUNS_OF_SHARD)
    found = stored(found_in_shards(segments_of(rows, marks, tokens, shards), tokens, shards), "found")
    spans = found.filter("part < 0").select("key_id", "key_text", "start", "until").unionByName(closed(found, tokens))
    return spans.groupBy(*KEYS).agg(F.collect_set(F.struct("start", "until")).alias("spans"))


def covered(spans: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches that the spans cover, touching ones joined."""
    if spans is None or not len(spans):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, [s["start"] for s in spans], 1)
    np.add.at(edges, [s["until"] for s in spans], -1)
    inside = np.concatenate([[0], np.cumsum(edges[:-1]) > 0, [0]]).astype(np.int8)
    steps = np.diff(inside)
    return np.nonzero(steps == 1)[0], np.nonzero(steps == -1)[0]
