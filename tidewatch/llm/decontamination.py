"""Benchmark passages in documents, up to a share of edited words.

Windows of the documents and the benchmark items are mapped by random walks
that turn edits into few differing places, and looked up by sampled places;
what is found is then verified by the exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import mixed, python_ready, slices, texts_of
from tidewatch.llm.recurring import STEP
from tidewatch.llm.repeated_phrases import word_hashes

SIMILARITY = 0.8
#: Items with fewer words are no reason to drop a document; matches() finds them all the same.
LEAST_WORDS = 5
#: Walks, places sampled of each, and how far into a walk (about twice the words).
WALKS, PLACES, REACH = 32, 2, 36
#: Items, and their characters, that are sent to the tasks at once.
ITEMS_AT_ONCE, CHARS_AT_ONCE = 5000, 4_000_000

#: Bytes between words: ASCII characters that are no letters or digits.
BETWEEN = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
#: Bits of a first test for words that no item has.
SIEVE = 20


def words_of(text: str) -> np.ndarray:
    """Hashes of the words in lower case: runs of letters and digits, with all characters beyond ASCII."""
    return word_hashes(text.lower().encode("utf-8", "surrogatepass"), BETWEEN)


def sampled_places(walks: int = WALKS, places: int = PLACES, reach: int = REACH, seed: int = 5) -> np.ndarray:
    """Sorted places for each walk; every part of the reach is sampled."""
    rng = np.random.default_rng(seed)
    return np.sort(np.array([rng.choice(reach, places, replace=False) for _ in range(walks)]), axis=1)


def walk_keys(grid: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of the sampled places of each walk over each row of word numbers.

    At each step a walk shows the word it stands on and moves on if a bit
    hashed from the step and the word says so. Two rows that differ by few
    edits are soon back on the same words.
    """
    n, width = grid.shape
    padded = np.concatenate([grid, np.zeros((n, 1), dtype=grid.dtype)], axis=1)
    rows, keys = np.arange(n), np.zeros((n, len(places)), dtype=np.uint64)
    for walk, wanted in enumerate(places):
        at, key = np.zeros(n, dtype=np.int64), np.full(n, walk + 1, dtype=np.uint64)
        for step in range(int(wanted[-1]) + 1):
            shown = padded[rows, at].astype(np.uint64)
            if step in wanted:
                key = mixed(key * np.uint64(STEP) + shown)
            bits = mixed(shown + np.uint64((walk * 1009 + step + 1) * STEP % 2**64)) >> np.uint64(63)
            at = np.minimum(at + bits.astype(np.int64), width)
        keys[:, walk] = key
    return keys


def best_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to any stretch of the region, with the stretch's start and end."""
    n = len(region)
    cost, start = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for word in item:
        new, from_ = cost + 1, start.copy()  # the item's word is left out
        across = cost[:-1] + (region != word)
        better = across < new[1:]
        new[1:][better], from_[1:][better] = across[better], start[:-1][better]
        # words of the region that the item lacks: the least of new[j] - j so far, plus j
        level = new - steps
        least = np.minimum.accumulate(level)
        origin = np.maximum.accumulate(np.where(level == least, steps, 0))
        cost, start = least + steps, from_[origin]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


class Items:
    """Some benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, least_words: int = LEAST_WORDS):
        self.ids, hashes = [], []
        for item_id, text in items:
            own = words_of(text)
            if len(own) >= max(1, least_words):
                self.ids.append(item_id)
                hashes.append(own)
        self.known = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *hashes]))
        self.sieve = np.zeros(1 << SIEVE, dtype=bool)
        self.sieve[(self.known >> np.uint64(64 - SIEVE)).astype(np.int64)] = True
        self.words = [self.numbers(own) for own in hashes]
        self.edits = [int((1 - similarity) * len(w) + 1e-9) for w in self.words]
        self.places = sampled_places()
        self.lengths = sorted({len(w) for w in self.words})
        self.least = {len(w): len(w) - e for w, e in zip(self.words, self.edits, strict=True)}
        # a copied stretch may be taken to begin with a word that it shares with the item; at most
        # as many words as may be edited lie before it, so the item is entered from each of its first words
        heads, grid, owner = [], [], []
        for i, (words, edits) in enumerate(zip(self.words, self.edits, strict=True)):
            for skip in range(edits + 1):
                tail = words[skip : skip + REACH]
                heads.append((len(words), int(words[skip])))
                grid.append(np.pad(tail, (0, REACH - len(tail))))
                owner.append(i)
        self.width = len(self.known) + 1
        at = {n: i for i, n in enumerate(self.lengths)}
        self.heads = np.zeros((-(-len(self.lengths) // 64), self.width), dtype=np.uint64)
        for n, word in heads:
            self.heads[at[n] // 64, word] |= np.uint64(1 << at[n] % 64)
        #: Words of each item, as item * width + word, with their number; and the most of each word in an item of a length.
        none = np.zeros(0, dtype=np.int64)
        self.held, self.times = np.unique(
            np.concatenate([none, *[i * self.width + w for i, w in enumerate(self.words)]]), return_counts=True
        )
        by_length = np.array([at[len(w)] for w in self.words], dtype=np.int64)[self.held // self.width] * self.width + self.held % self.width
        self.held_by_length, back = np.unique(by_length, return_inverse=True)
        self.times_by_length = np.zeros(len(self.held_by_length), dtype=np.int64)
        np.maximum.at(self.times_by_length, back, self.times)
        if grid:
            keys = self._with_length(walk_keys(np.array(grid), self.places), np.array([h[0] for h in heads])).ravel()
            owners = np.repeat(np.array(owner), len(self.places))
            order = np.lexsort((owners, keys))
            self.keys, self.owner = keys[order], owners[order]

    @staticmethod
    def _with_length(keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return mixed(keys + lengths.astype(np.uint64)[:, None])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 1 on, 0 for words that no item has."""
        out = np.zeros(len(hashes), dtype=np.int64)
        some = np.nonzero(self.sieve[(hashes >> np.uint64(64 - SIEVE)).astype(np.int64)])[0]
        if len(some):
            near = np.minimum(np.searchsorted(self.known, hashes[some]), len(self.known) - 1)
            out[some] = np.where(self.known[near] == hashes[some], near + 1, 0)
        return out

    def windows(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the windows that can match an item.

        A stretch within the allowed edits shares all other words with its
        item. So its window begins with one of the item's first words and has
        at least that many words that occur in items of its length, none more
        often than in one of them.
        """
        found, known = [], np.concatenate([[0], np.cumsum(ids > 0)])
        for which, n in enumerate(self.lengths):
            if which % 64 == 0:
                masks = self.heads[which // 64][ids]
                places = np.nonzero(masks)[0]
                masks, limits = masks[places], ends[np.searchsorted(ends, places, side="right")]
            mine = (masks >> np.uint64(which % 64)) & np.uint64(1) > 0
            own, stops = places[mine], np.minimum(places[mine] + n, limits[mine])
            enough = known[stops] - known[own] >= self.least[n]
            own, stops = own[enough], stops[enough]
            shared = self._shared(ids, own, stops, np.full(len(own), which), self.held_by_length, self.times_by_length)
            own = own[shared >= self.least[n]]
            found.append((own, np.full(len(own), n)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _shared(
        self, ids: np.ndarray, starts: np.ndarray, stops: np.ndarray, group: np.ndarray, held: np.ndarray, times: np.ndarray
    ) -> np.ndarray:
        """Words of each window that its group has, each as often as the group has it at most."""
        n = stops - starts
        row = np.repeat(np.arange(len(starts)), n)
        at = starts[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        keys = group[row] * self.width + ids[at]
        near = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        there = held[near] == keys
        both, seen = np.unique(row[there] * len(held) + near[there], return_counts=True)
        return np.bincount(
            both // len(held), weights=np.minimum(seen, times[both % len(held)]), minlength=len(starts)
        )

    def search(self, ids: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(document's place in ends, item's place, distance, start, end) of the best match of each pair."""
        starts, lengths = self.windows(ids, ends)
        if not len(starts):
            return []
        stops = ends[np.searchsorted(ends, starts, side="right")]
        pairs = []
        for a in range(0, len(starts), 20_000):
            s, n, stop = starts[a : a + 20_000], lengths[a : a + 20_000], stops[a : a + 20_000]
            at = s[:, None] + np.arange(REACH)
            inside = (at < stop[:, None]) & (np.arange(REACH) < n[:, None])
            grid = np.where(inside, ids[np.minimum(at, len(ids) - 1)], 0)
            keys = self._with_length(walk_keys(grid, self.places), n)
            low, high = (np.searchsorted(self.keys, keys.ravel(), side=x) for x in ("left", "right"))
            hits = np.nonzero(high > low)[0]
            many = high[hits] - low[hits]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            item = self.owner[np.repeat(low[hits], many) + within]
            window = np.repeat(hits // keys.shape[1], many)
            both = np.unique(window * len(self.words) + item)
            window, item = both // len(self.words), both % len(self.words)
            least = np.array([len(w) - e for w, e in zip(self.words, self.edits, strict=True)])[item]
            until = np.minimum(stop[window], s[window] + np.array([len(w) for w in self.words])[item])
            enough = self._shared(ids, s[window], until, item, self.held, self.times) >= least
            pairs.append(np.stack([s[window], item], axis=1)[enough])
        found = np.unique(np.concatenate(pairs), axis=0)
        docs = np.searchsorted(ends, found[:, 0], side="right")
        order = np.lexsort((found[:, 0], found[:, 1], docs))
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        group: list[int] = []
        rows = [(int(d), int(i), int(s)) for d, i, s in zip(docs[order], found[order, 1], found[order, 0], strict=True)]
        for here, after in zip(rows, [*rows[1:], None], strict=True):
            group.append(here[2])
            near = after is not None and after[:2] == here[:2] and after[2] - here[2] <= len(self.words[here[1]])
            if not near:  # starts close to each other are verified together
                key = here[:2]
                match = self._verified(ids, ends, *key, group)
                if match and (key not in out or match[0] < out[key][0]):
                    out[key] = match
                group = []
        return [(*key, *match) for key, match in out.items()]

    def _verified(self, ids: np.ndarray, ends: np.ndarray, doc: int, item: int, starts: list[int]) -> tuple[int, int, int] | None:
        words, edits = self.words[item], self.edits[item]
        for start in starts:
            if start + len(words) <= ends[doc] and (ids[start : start + len(words)] == words).all():
                return 0, start, start + len(words)
        begin = max(starts[0] - edits, int(ends[doc - 1]) if doc else 0)
        end = min(starts[-1] + len(words) + edits, int(ends[doc]))
        distance, a, b = best_match(words, ids[begin:end])
        return (distance, begin + a, begin + b) if distance <= edits else None


def item_blocks(benchmark: DataFrame, similarity: float, least_words: int) -> Iterator:
    """The items in broadcasts of a bounded number and size."""
    spark = benchmark.sparkSession
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // ITEMS_AT_ONCE), -(-chars // CHARS_AT_ONCE))
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found = sorted({(r["item_id"], r["text"]) for r in own}, key=str)
        yield spark.sparkContext.broadcast(Items(found, similarity, least_words))


def search_texts(items: Items, texts: list[str]) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """The matches of some texts, and where each text ends in their words together."""
    lists = [words_of(t) for t in texts]
    ends = np.cumsum([len(w) for w in lists])
    if not items.words or not len(ends) or not ends[-1]:
        return [], ends
    return items.search(items.numbers(np.concatenate(lists)), ends), ends


MATCHES = "doc_id long, item_id long, n_edits int, similarity double, start_word int, n_words int"


def matches(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, least_words: int = 1
) -> DataFrame:
    """A row for each document and item that it holds: edits, similarity, and the place of its best match.

    Words are runs of letters and digits, and characters beyond ASCII, in lower case. A document holds an
    item if some stretch of its words is at an edit distance, in words, of at
    most (1 - similarity) times the item's words. Equal matches go to the
    first place. Items of a few words allow no edit and are found word for
    word. Null or empty texts, items without words and those below least_words
    match nothing; repeated rows give repeated matches. An empty table gives no rows.

    All items are looked up in all texts, in blocks of a bounded number and
    size, one pass over the documents for each block.
    """
    python_ready(docs.sparkSession)
    rows = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for sent in item_blocks(benchmark, similarity, least_words):

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            block = sent.value
            for frame in slices(batches, 4_000_000):
                found, ends = search_texts(block, frame["text"].tolist())
                if found:
                    doc, item, edits, start, end = (np.array(x) for x in zip(*found, strict=True))
                    yield pd.DataFrame({
                        "doc_id": frame["doc_id"].to_numpy()[doc],
                        "item_id": np.array([block.ids[i] for i in item]),
                        "n_edits": edits.astype(np.int32),
                        "similarity": 1 - edits / np.array([len(block.words[i]) for i in item]),
                        "start_word": (start - np.where(doc > 0, ends[doc - 1], 0)).astype(np.int32),
                        "n_words": (end - start).astype(np.int32),
                    })

        part = rows.mapInPandas(run, MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS
) -> DataFrame:
    """The rows and columns of the documents that hold no item; see matches().

    A sentence of the language may hold an item of a few words by chance, so
    these are left out unless least_words says otherwise.
    """
    python_ready(docs.sparkSession)
    for sent in item_blocks(benchmark, similarity, least_words):

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for frame in batches:
                clean = np.ones(len(frame), dtype=bool)
                for begin in range(0, len(frame), 1024):
                    texts = [t or "" for t in frame["text"].iloc[begin : begin + 1024]]
                    clean[[begin + f[0] for f in search_texts(sent.value, texts)[0]]] = False
                yield frame[clean]

        docs = docs.mapInPandas(run, docs.schema)
    return docs
