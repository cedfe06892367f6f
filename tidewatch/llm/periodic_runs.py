"""Runs of words that repeat with a period, found by the branching-tandem test on enhanced suffix arrays.

A task puts the words of some documents into one text of numbers, where no
number occurs in two documents. The suffixes are sorted by doubled prefixes;
the longest common prefixes of neighbours give the LCP intervals. For each of
them the suffixes of all children but the largest are tested: with the depth
d of the interval, a square of period d begins at i if the inverse suffix
array puts i + d into the same interval. Each run ends with such a square that
cannot be moved on by a word, so that moving the squares back to where their
period began gives the runs. All of it is done on arrays; no tree is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import python_ready, slices, texts_of

#: The length in words from which a stretch counts as a run.
LEAST = 12
#: Tests, or compared words, that are held at once.
AT_ONCE = 1 << 20


def least_depth(least: int) -> int:
    """The depth below which LCP intervals need no test, a power of two.

    A run of a smaller period q also ends with a square of a multiple of q
    that is no less than this depth and fits into the least length.
    """
    return 1 << ((least // 4 + 1).bit_length() - 1)


def matching(text: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 1) -> np.ndarray:
    """How many words agree from each pair of positions on, going up or down.

    The text begins and ends with numbers that occur once, so each comparison
    ends inside. Pairs that still agree are compared in doubled stretches.
    """
    out, live, width = np.zeros(len(a), dtype=np.int64), np.arange(len(a)), 4
    last = len(text) - 1
    while len(live):
        ahead = step * np.arange(width)
        rest = []
        for part in np.array_split(live, -(-len(live) * width // AT_ONCE)):
            x = (a[part] + step * out[part])[:, None] + ahead
            y = (b[part] + step * out[part])[:, None] + ahead
            differ = text[np.clip(x, 0, last)] != text[np.clip(y, 0, last)]
            n = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            out[part] += n
            rest.append(part[n == width])
        live, width = np.concatenate(rest), 2 * width
    return out


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and for each place in it whether a new key begins."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return order, fresh


def repeated_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that share at least their first `depth` words with another, in order, and where such groups begin.

    Sorting by doubled prefixes goes on for those alone whose order is open.
    """
    n, rank, length = len(text), text, 1
    while True:
        order, fresh = _ranks(rank)
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = first
        if length == depth:
            break
        rank = rank * n
        rank[:-length] += rank[length:] // n
        length *= 2
    alone = fresh & np.append(fresh[1:], True)
    found, heads = order[~alone], fresh[~alone]
    live = found
    while len(live):
        before = rank[live]
        order, fresh = _ranks(before * n + rank[live + length])
        live, before = live[order], before[order]
        at = np.arange(len(live))
        group = np.ones(len(live), dtype=bool)
        group[1:] = before[1:] != before[:-1]
        rank[live] = before + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        live = live[~(fresh & np.append(fresh[1:], True))]
        length *= 2
    return found[np.argsort(rank[found])], heads


def common_prefixes(text: np.ndarray, order: np.ndarray, heads: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in order; 0 at the heads of groups.

    Where the words before both are equal, the value is one less than that of
    the position before, so only the others are compared.
    """
    before = np.full(len(text), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    before[order[heads]] = -1
    at = np.sort(order)
    other = before[at]
    follows = (other > 0) & (at > 0)
    follows[follows] = text[at[follows] - 1] == text[other[follows] - 1]
    begins = ~follows
    own = np.zeros(len(at), dtype=np.int64)
    compared = np.nonzero(begins & (other >= 0))[0]
    own[compared] = matching(text, at[compared], other[compared])
    nearest = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
    values = own[nearest] - (at - at[nearest])
    shared = np.empty(len(order), dtype=np.int64)
    shared[place[at]] = values
    return shared


def _nearest_less(values: np.ndarray) -> np.ndarray:
    """The place of the last smaller value before each; the first value is the least."""
    left = np.maximum(np.arange(len(values)) - 1, 0)
    live = np.arange(1, len(values))
    while len(live):
        live = live[(left[live] > 0) & (values[left[live]] >= values[live])]
        left[live] = left[left[live]]
    return left


def squares(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends and periods of the squares that cannot be moved on by a word, by end, then period."""
    none = np.zeros(0, dtype=np.int64)
    order, heads = repeated_suffixes(text, depth)
    m = len(order)
    if not m:
        return none, none
    place = np.full(len(text), -1, dtype=np.int64)
    place[order] = np.arange(m)
    shared = common_prefixes(text, order, heads, place)
    walled = np.concatenate([[-1], shared, [-1]])
    left = _nearest_less(walled)[1:-1] - 1
    right = m - _nearest_less(walled[::-1])[::-1][1:-1]
    cut = np.nonzero(shared >= depth)[0]
    cut = cut[np.argsort(left[cut] * (m + 1) + right[cut], kind="stable")]
    low, high = left[cut], right[cut]
    fresh = np.ones(len(cut), dtype=bool)
    fresh[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    number = np.cumsum(fresh) - 1
    firsts = np.nonzero(fresh)[0]
    lasts = np.append(firsts[1:], len(cut)) - 1
    # the children of an interval lie between its cuts
    starts = np.concatenate([np.where(fresh, low, np.append(0, cut[:-1])), cut[lasts]])
    stops = np.concatenate([cut, high[firsts]])
    parents = np.concatenate([number, np.arange(len(firsts))])
    by_size = np.lexsort((starts - stops, parents))
    smaller = np.ones(len(starts), dtype=bool)
    smaller[by_size[np.append(True, np.diff(parents[by_size]) != 0)]] = False
    starts, stops, parents = starts[smaller], stops[smaller], parents[smaller]
    depths, lows, highs = shared[cut[firsts]], low[firsts], high[firsts]
    ends = np.cumsum(stops - starts)
    found = [none]
    width = len(text) + 1
    for begin in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
        nth = np.arange(begin, min(begin + AT_ONCE, int(ends[-1])))
        child = np.searchsorted(ends, nth, side="right")
        i = order[stops[child] - ends[child] + nth]
        parent = parents[child]
        d, lo, hi = depths[parent], lows[parent], highs[parent]
        after = place[i + d]
        good = (after >= lo) & (after < hi) & (text[i + d] != text[np.minimum(i + 2 * d, len(text) - 1)])
        found.append((i[good] + 2 * d[good]) * width + d[good])
        back = i - d
        prior = place[np.maximum(back, 0)]
        good = (back >= 0) & (prior >= lo) & (prior < hi) & (text[i] != text[i + d])
        found.append((i[good] + d[good]) * width + d[good])
    keys = np.unique(np.concatenate(found))
    return keys // width, keys % width


def runs_of(text: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs of a text whose first and last numbers occur once."""
    depth = least_depth(least)
    end, period = squares(text, depth)
    runs = []
    while len(end):
        first = np.ones(len(end), dtype=bool)
        first[1:] = end[1:] != end[:-1]
        e, p = end[first], period[first]
        q = p.copy()
        for small in range(depth - 1, 0, -1):  # multiples of periods below the least depth
            rows = np.nonzero((p < 2 * depth) & (p % small == 0))[0]
            ahead = np.arange(2 * depth)
            x = np.minimum((e - 2 * p)[rows, None] + ahead, len(text) - 1)
            differ = (text[x] != text[np.minimum(x + small, len(text) - 1)]) & (ahead < p[rows, None])
            q[rows[~differ.any(axis=1)]] = small
        s = e - 2 * p - matching(text, e - 2 * p - 1, e - 2 * p - 1 + q, -1)
        runs.append((s, e, q))
        # what remains at an end are squares of other periods, not of multiples inside the run
        group = np.cumsum(first) - 1
        stays = (period % q[group] != 0) | (s[group] > end - 2 * period)
        end, period = end[stays], period[stays]
    s, e, q = (np.concatenate(x) for x in zip(*runs, strict=True)) if runs else (np.zeros(0, dtype=np.int64),) * 3
    long = e - s >= np.maximum(least, 2 * q)
    s, e, q = s[long], e[long], q[long]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def joined(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One text of numbers, and where each document begins in it. A number of its own lies between any two."""
    lengths = np.array([len(words) + 1 for words in documents], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths + 1
    text = np.empty(int(lengths.sum()) + 1, dtype=np.int64)
    used = len(documents) + 1
    text[0] = 0
    text[starts + lengths - 1] = np.arange(1, used)
    for words, at in zip(documents, starts, strict=True):
        numbers = dict.fromkeys(words)
        numbers.update(zip(numbers, range(used, used + len(numbers)), strict=True))
        text[at : at + len(words)] = list(map(numbers.__getitem__, words))
        used += len(numbers)
    return text, starts


ROWS = "n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """A row for each document: doc_id, n_words, runs and collapsed, the text with each run cut to its first period.

    A run is a stretch of words with a smallest period q (words q apart are
    identical) of at least `least` and 2q words that no neighbour extends. runs
    is an array of start (number of the word from 0), length and period, by
    start, then period. Kept words are joined by one space. Null, empty and
    blank texts have no words and no runs. Repeated rows and rows without an
    id each give their own row; other columns are not read. Texts of any length
    are read whole. An empty table gives no rows.

    Documents do not depend on each other: nothing is shuffled.
    """
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(batches):
            documents = [t.encode("utf-8", "surrogatepass").split() for t in frame["text"]]
            text, offsets = joined(documents)
            s, e, q = runs_of(text, least)
            of = np.searchsorted(offsets, s, side="right") - 1
            drops = np.zeros(len(text) + 1, dtype=np.int64)
            np.add.at(drops, s + q, 1)
            np.subtract.at(drops, e, 1)
            dropped = np.cumsum(drops) > 0
            rows = []
            cuts = np.searchsorted(of, np.arange(len(documents) + 1))
            for words, at, a, b in zip(documents, offsets, cuts[:-1], cuts[1:], strict=True):
                kept = words
                if a < b:
                    kept = [w for w, gone in zip(words, dropped[at : at + len(words)], strict=True) if not gone]
                rows.append((len(words), s[a:b] - at, e[a:b] - s[a:b], q[a:b], b" ".join(kept).decode("utf-8", "replace")))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")], index=frame.index)
            out.insert(0, "doc_id", frame["doc_id"])
            yield out

    rows = texts_of(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInPandas(run, f"doc_id {kind}, {ROWS}")
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select("doc_id", "n_words", runs.alias("runs"), "collapsed")
