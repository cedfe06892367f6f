"""Packing of tokenized documents into training sequences, best fit first, longest piece first.

Which pieces share a sequence depends on their lengths alone. So the lengths
are counted over the whole corpus, the packing is worked out once on these
counts (one number for each length up to the capacity), and each piece finds
its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import python_ready, stored, texts_of

CAPACITY = 1024
END_ID = 2
#: Words whose ids a worker remembers, and the longest such word in characters.
REMEMBERED, LONGEST = 500_000, 60
#: Words that the tokenizer gets as one text.
WORDS_AT_ONCE = 256

BLANK_AFTER_SPACE = re.compile(r" (?:\s|\Z)")

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank_in_part long"
)


class OpenSequences:
    """A segment tree over remaining capacities that finds the tightest one with an open sequence."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.width)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.width
        while node:
            self.open[node] += n
            node >>= 1

    def put(self, room: int, first: int, n: int) -> None:
        """n sequences from number first on have so much room."""
        if n:
            self.runs[room].append((first, n))
            self._add(room, n)

    def take(self, room: int) -> tuple[int, int]:
        first, n = self.runs[room].pop()
        self._add(room, -n)
        return first, n

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least this size that some sequence has."""
        node = least + self.width
        if self.open[node]:
            return least
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.width:
                    node *= 2
                    if not self.open[node]:
                        node += 1
                return node - self.width
            node >>= 1
        return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over all pieces, given how many there are of each length.

    Rows (length, first rank, end rank, pieces per sequence, first sequence,
    offset). Pieces of one length that meet sequences with the same room are
    placed together: the tightest sequence stays the tightest while it has
    room for another piece, so each takes as many as fit.
    """
    open_ones, plan, sequences = OpenSequences(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            room = open_ones.tightest(length)
            left = total - rank
            if room is None:
                room = capacity
                first, n = sequences, -(-left // (room // length))
                sequences += n
            else:
                first, n = open_ones.take(room)
            each = room // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, rank + full * each, each, first, capacity - room))
                open_ones.put(room - each * length, first, full)
                rank += full * each
            if full < n:
                rest = min(total - rank, each)
                if rest:
                    plan.append((length, rank, rank + rest, each, first + full, capacity - room))
                    open_ones.put(room - rest * length, first + full, 1)
                    rank += rest
                open_ones.put(room, first + full + bool(rest), n - full - bool(rest))
    return plan


class WordIds:
    """Token ids of texts as little-endian 32-bit numbers.

    No token crosses from one word to the space before the next, so a text
    is cut there and the ids of frequent words are remembered. A text with
    other blanks before or after a space, or with the text of a special
    token, goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.n_bytes[number] = len(token)  # a character for each byte
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _ids_of_words(self, words: list[str]) -> dict[str, bytes]:
        """Words that begin with a space are encoded many at a time and told apart by their bytes."""
        first = [w for w in words if w[:1] != " "]
        out = dict(zip(first, self._ids(first), strict=True)) if first else {}
        words = [w for w in words if w[:1] == " "]
        groups = [words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        for group, ids in zip(groups, self._ids(["".join(g) for g in groups]) if groups else [], strict=True):
            ends = np.cumsum(self.n_bytes[np.frombuffer(ids, dtype="<u4")])
            wanted = np.cumsum([len(w.encode()) for w in group])
            cuts = np.searchsorted(ends, wanted) + 1
            if (ends[np.minimum(cuts, len(ends)) - 1] != wanted).any():  # a token across words: not with these cuts
                out.update(zip(group, self._ids(group), strict=True))
                continue
            stops = (4 * cuts).tolist()
            out.update((w, ids[i:j]) for w, i, j in zip(group, [0, *stops], stops, strict=False))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        known, found, missing, whole = self.known, [], set(), []
        for i, text in enumerate(texts):
            if not text or BLANK_AFTER_SPACE.search(text) or "\0" in text or any(s in text for s in self.special):
                found.append((None, None))
                if text:
                    whole.append(i)
                continue
            words = text.replace(" ", "\0 ").split("\0")
            ids = list(map(known.get, words))
            if None in ids:
                missing.update([w for w, b in zip(words, ids, strict=True) if b is None])
                found.append((words, ids))
            else:
                found.append((None, ids))
        fresh = self._ids_of_words(list(missing)) if missing else {}
        rest = dict(zip(whole, self._ids([texts[i] for i in whole]), strict=True)) if whole else {}
        out = []
        for i, (words, ids) in enumerate(found):
            if ids is None:
                out.append(rest.get(i, b""))
                continue
            if words is not None:
                ids = [fresh[w] if b is None else b for w, b in zip(words, ids, strict=True)]
            out.append(b"".join(ids))
        if len(known) < REMEMBERED:
            known.update((w, b) for w, b in fresh.items() if len(w) <= LONGEST)
        return out


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for each worker, which keeps it from task to task."""
    return WordIds(path)


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """Piece, start, length and checksum; only the first piece may be shorter than the capacity."""
    n = len(ids) // 4
    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
    for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        yield piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of each document, with its rank among the pieces of its length in its task."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = word_ids(tokenizer_path)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for frame in batches:
            rows = []
            for begin in range(0, len(frame), 256):
                own = frame.iloc[begin : begin + 256]
                for doc_id, ids in zip(own["doc_id"], words.encode(own["text"].tolist()), strict=True):
                    for piece, start, length, crc in pieces_of(ids + end, capacity):
                        rows.append((doc_id, piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
            if rows:
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    rows = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The place of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece that holds only the end token. Repeated
    rows are packed as often as they occur. Ties between pieces of one length
    go by task and place in it. Other columns are not read; an empty table
    gives no rows.

    Only the counts of lengths reach the driver: one number for each length
    up to the capacity. The plan made of them is sent to the tasks; it has at
    most about two runs of sequences for each length and each open room, both
    bounded by the capacity.
    """
    spark = docs.sparkSession
    python_ready(spark)
    pieces = stored(tokenize_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = np.array(plan_packing(counts, capacity) or [(0,) * 6], dtype=np.int64)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    sent = spark.sparkContext.broadcast(plan[order])
    most = int(plan[:, 2].max()) + 1

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sent.value
        firsts = rows[:, 0] * most + rows[:, 1]
        for frame in batches:
            rank = (frame.pop("base") + frame.pop("rank_in_part")).to_numpy()
            length = frame["length"].to_numpy()
            at = rows[np.searchsorted(firsts, length * most + rank, side="right") - 1]
            within = rank - at[:, 1]
            frame["sequence_id"] = at[:, 4] + within // at[:, 3]
            frame["offset"] = at[:, 5] + within % at[:, 3] * length
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    ranked = pieces.join(bases, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "base", "rank_in_part"
    )
    return ranked.mapInPandas(
        locate, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
