"""Removal of byte strings that recur anywhere in the corpus, found with suffix arrays of its shards.

The suffix arrays are made by induced sorting, a bucket of one letter at a
time: numpy moves all suffixes of a bucket at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidewatch.llm.common import KEYS, keyed, mixed
from tidewatch.llm.recurring import STEP, Tokens, covered, repeats

#: Bytes in a window, and in the grams that serve as anchors.
WINDOW, GRAM = 400, 32

_of_byte = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(STEP))


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last letter is the least and occurs once."""
    n = len(text)
    differs = np.ones(n, dtype=bool)
    differs[:-1] = text[:-1] != text[1:]
    smaller = np.zeros(n, dtype=bool)
    smaller[:-1] = text[:-1] < text[1:]
    smaller[-1] = True
    at = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # equal letters are of the type of the last of them
    return smaller[nearest]


def _deal(found: np.ndarray, text: np.ndarray, order: np.ndarray, ends: np.ndarray, step: int) -> None:
    """Append suffixes, in their order, to the buckets of their letters; ends move by step."""
    letters = text[found]
    by_letter = np.argsort(letters, kind="stable")
    found, letters = found[by_letter], letters[by_letter]
    heads = np.ones(len(letters), dtype=bool)
    heads[1:] = letters[1:] != letters[:-1]
    firsts = np.nonzero(heads)[0]
    counts = np.diff(np.append(firsts, len(letters)))
    within = np.arange(len(letters)) - np.repeat(firsts, counts)
    order[ends[letters] + step * within] = found
    ends[letters[firsts]] += step * counts


def induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost smaller ones in order.

    A suffix that is larger than the next follows from it: going up through
    the buckets, the suffix before each is appended to its own bucket. Then
    the smaller ones are filled in going down.
    """
    stops = np.cumsum(sizes)
    starts = stops - sizes
    order = np.full(len(text), -1, dtype=np.int64)
    letters = text[leftmost]
    cuts = np.searchsorted(letters, np.arange(len(sizes) + 1))
    fronts, used = starts.copy(), np.nonzero(sizes)[0]

    def before(suffixes: np.ndarray, kind: bool) -> np.ndarray:
        found = suffixes[suffixes > 0] - 1
        return found[smaller[found] == kind]

    for c in used:
        done = starts[c]
        while done < fronts[c]:
            wave = order[done : fronts[c]]
            done = fronts[c]
            found = before(wave, False)
            if len(found):
                _deal(found, text, order, fronts, 1)
        if cuts[c] < cuts[c + 1]:
            found = before(leftmost[cuts[c] : cuts[c + 1]], False)
            if len(found):
                _deal(found, text, order, fronts, 1)
    backs = stops - 1
    for c in used[::-1]:
        done = stops[c] - 1
        while done > backs[c]:
            wave = order[backs[c] + 1 : done + 1][::-1]
            done = backs[c]
            found = before(wave, True)
            if len(found):
                _deal(found, text, order, backs, -1)
        wave = order[starts[c] : fronts[c]][::-1]
        found = before(wave, True)
        if len(found):
            _deal(found, text, order, backs, -1)
    if order[0] < 0:
        order[0] = len(text) - 1
    return order


def by_doubling(text: np.ndarray) -> np.ndarray:
    """Suffixes of a short text over many letters, sorted by prefixes of doubled length."""
    n, ranks, length = len(text), np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        keys = ranks * (n + 1)
        keys[: max(0, n - length)] += ranks[length:] + 1
        order = np.argsort(keys)
        ordered = keys[order]
        fresh = np.zeros(n, dtype=np.int64)
        fresh[1:] = ordered[1:] != ordered[:-1]
        ranks = np.empty(n, dtype=np.int64)
        ranks[order] = np.cumsum(fresh)
        length *= 2
        if ranks[order[-1]] == n - 1 or length > 2 * n:
            return order


#: Buckets are gone through one by one, which pays while they are few against the suffixes.
MOST_LETTERS = 1024


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order; the text must end with its least letter, which occurs once."""
    n, letters = len(text), int(text.max()) + 1
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    if letters > MOST_LETTERS:
        return by_doubling(text)
    text = text.astype(np.uint16)
    sizes = np.bincount(text, minlength=letters)
    smaller = classify(text)
    is_left = np.zeros(n, dtype=bool)
    is_left[1:] = smaller[1:] & ~smaller[:-1]
    places = np.nonzero(is_left)[0]
    if len(places) > 1:
        # sorting by induction from unsorted ones sorts the leftmost smaller substrings
        rough = induce(text, smaller, places[np.argsort(text[places], kind="stable")], sizes)
        rough = rough[is_left[rough]]
        names = _names(text, places, rough)
        if names.max() + 1 < len(places):
            places = places[suffix_array(names)]
        else:
            places = rough
    return induce(text, smaller, places, sizes)


def _names(text: np.ndarray, places: np.ndarray, rough: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost smaller substrings, equal for equal ones, in the order of the text."""
    nth = np.zeros(len(text), dtype=np.int64)
    nth[places] = np.arange(len(places))
    lengths = np.diff(np.append(places, len(text) - 1)) + 1
    ranks = nth[rough]
    a, b = rough[:-1], rough[1:]
    own = lengths[ranks]
    same = own[:-1] == own[1:]
    pairs, step = np.nonzero(same)[0], 0
    while len(pairs):
        pairs = pairs[own[pairs] > step]
        differ = text[a[pairs] + step] != text[b[pairs] + step]
        same[pairs[differ]] = False
        pairs = pairs[~differ]
        step += 1
    name = np.zeros(len(places), dtype=np.int64)
    name[ranks[1:]] = np.cumsum(~same)
    return name


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the letters that its suffix shares with the one before it in order.

    If the letters before both are equal, the value is one less than that of
    the position before. So only the others are compared; their values add up
    to little, and the comparisons go on in doubled steps.
    """
    n = len(text)
    previous = np.full(n, -1, dtype=np.int64)
    previous[order[1:]] = order[:-1]
    at = np.arange(n)
    first = (previous < 1) | (at == 0)
    inner = ~first
    first[inner] = text[at[inner] - 1] != text[previous[inner] - 1]
    heads = np.nonzero(first)[0]
    values = _common(text, heads, previous[heads])
    nearest = np.maximum.accumulate(np.where(first, np.cumsum(first) - 1, 0))
    return np.maximum(values[nearest] - (at - heads[nearest]), 0)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters shared from each pair of positions on, eight at a time."""
    n = len(text)
    wide = np.concatenate([text, np.zeros(16, dtype=text.dtype)]).astype(np.uint64)
    packed = wide[: n + 8].copy()
    for shift in range(1, 7):  # 9 bits hold a letter
        packed |= wide[shift : n + 8 + shift] << np.uint64(9 * shift)
    out = np.zeros(len(a), dtype=np.int64)
    live = np.nonzero(b >= 0)[0]
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        apart = packed[x] ^ packed[y]
        low = (apart & (~apart + np.uint64(1))).astype(np.float64)
        step = np.where(apart == 0, 7, np.log2(np.maximum(low, 1)).astype(np.int64) // 9)
        out[live] += step
        live = live[apart == 0]
    return np.minimum(out, n - np.maximum(a, b))


class Bytes(Tokens):
    """Bytes, sent to the shards as they are."""

    def __init__(self, window: int = WINDOW, k: int = GRAM):
        self.window, self.k = window, min(k, window)

    def read(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8) for t in texts]

    def lift(self, tokens: np.ndarray) -> np.ndarray:
        return _of_byte[tokens]

    def send(self, tokens: np.ndarray) -> bytes:
        return tokens.tobytes()

    def sent(self, content: bytes) -> np.ndarray:
        return np.frombuffer(content, dtype=np.uint8)

    def repeated(self, contents: list[np.ndarray], times: np.ndarray) -> list[np.ndarray]:
        """One suffix array over all contents, each ended by a letter below all bytes."""
        lengths = np.array([len(c) + 1 for c in contents])
        text = np.ones(int(lengths.sum()) + 1, dtype=np.int64)
        text[-1] = 0
        stops = np.cumsum(lengths)
        starts = stops - lengths
        for c, s in zip(contents, starts, strict=True):
            text[s : s + len(c)] = c.astype(np.int64) + 2
        order = suffix_array(text)
        shared = permuted_prefixes(text, order)
        to_end = np.repeat(stops - 1, lengths) - np.arange(len(text) - 1)  # no match goes on past its content
        long = np.minimum(shared[:-1], to_end) >= self.window
        again = np.zeros(len(text), dtype=bool)
        again[:-1] = long
        ranked = again[order]
        again[order[:-1]] |= ranked[1:]
        return [
            np.ones(n - self.window, dtype=bool) if t > 1 else again[s : s + n - self.window]
            for s, n, t in zip(starts, lengths, times, strict=True)
        ]


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """key_id, key_text and spans (byte offsets) of the documents with recurring strings."""
    return repeats(docs, Bytes(window), keep_runs=True)


CUT_ROWS = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def cut(data: bytes, spans: list) -> tuple[int, int, int, str, bytes | None]:
    starts, ends = covered(spans, len(data))
    if not len(starts):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest(), None
    bounds = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
    return len(data), int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(), kept


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, with_bytes: bool = True, with_text: bool = False
) -> DataFrame:
    """A row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_bytes.

    Each byte in a string of so many bytes that also starts elsewhere is
    removed, in every copy. A cut may fall inside a character, so what is kept
    are bytes. A null text is empty; shorter texts than the window stay whole.
    Repeated rows are copies of each other. Texts of any length are read
    whole. An empty table gives no rows. kept_bytes is null where nothing was
    removed, and left out without with_bytes. with_text adds text, what is kept
    as text, in which a character that was cut reads as U+FFFD.
    """
    spans = repeated_spans(docs, window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            texts = frame.pop("text").tolist()
            data = [t.encode("utf-8", "surrogatepass") for t in texts]
            found = [cut(d, s) for d, s in zip(data, frame.pop("spans"), strict=True)]
            for i, c in enumerate(("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes")):
                frame[c] = [f[i] for f in found]
            if not with_bytes:
                del frame["kept_bytes"]
            if with_text:
                frame["text"] = [
                    t if f[4] is None else f[4].decode("utf-8", "replace") for t, f in zip(texts, found, strict=True)
                ]
            yield frame

    rows = keyed(docs).join(spans, KEYS, "left").select("doc_id", "text", "spans")
    wanted = (CUT_ROWS if with_bytes else CUT_ROWS.rpartition(",")[0]) + (", text string" if with_text else "")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, {wanted}")
