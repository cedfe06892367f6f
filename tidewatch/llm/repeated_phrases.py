"""Removal of passages that recur anywhere in the corpus, located with Aho-Corasick automata."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidewatch.llm.common import BLANKS, KEYS, WORD, key_columns, keyed, mixed
from tidewatch.llm.recurring import STEP, Tokens, covered, prefix_sums, powers, repeats

#: Words in a window, and in the grams that serve as anchors.
WINDOW, GRAM = 35, 6
#: Words of a window that the automata hold.
HEAD = 10
BYTES_AT_ONCE = 1 << 19

WORD_OF = re.compile(WORD)

_blank = np.zeros(256, dtype=bool)
_blank[[ord(c) for c in BLANKS]] = True
_of_byte = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(STEP))


def word_hashes(text: bytes, between: np.ndarray = _blank) -> np.ndarray:
    """A 64-bit hash of each word of a text in UTF-8; between: which bytes lie between words."""
    out, begin = [], 0
    while begin < len(text):
        end = begin + BYTES_AT_ONCE
        if end < len(text):  # cut where a word ends; a word longer than the unit is taken whole
            rest = np.nonzero(between[np.frombuffer(text[end : end + 4096], dtype=np.uint8)])[0]
            end = end + int(rest[0]) if len(rest) else len(text)
        part = np.frombuffer(text[begin:end], dtype=np.uint8)
        begin = end
        blank = np.ones(len(part) + 2, dtype=bool)
        blank[1:-1] = between[part]
        starts = np.nonzero(blank[:-1] & ~blank[1:])[0]
        ends = np.nonzero(~blank[:-1] & blank[1:])[0]
        if len(part) > len(powers()[0]):
            words = text[end - len(part) : end].translate(bytes(32 if b else i for i, b in enumerate(between))).split()
            out.append(np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in words], dtype=np.uint64))
            continue
        sums = prefix_sums(_of_byte[part])
        out.append(mixed((sums[ends] - sums[starts]) * powers()[1][starts] + (ends - starts).astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


class Words(Tokens):
    """Words, sent to the shards as 32-bit codes."""

    def __init__(self, window: int = WINDOW, k: int = GRAM):
        self.window, self.k = window, min(k, window)

    def read(self, texts: list[str]) -> list[np.ndarray]:
        return [word_hashes(t.encode("utf-8", "surrogatepass")) for t in texts]

    def lift(self, tokens: np.ndarray) -> np.ndarray:
        return tokens

    def send(self, tokens: np.ndarray) -> bytes:
        return (tokens >> np.uint64(32)).astype("<u4").tobytes()

    def sent(self, content: bytes) -> np.ndarray:
        return np.frombuffer(content, dtype="<u4")

    def repeated(self, contents: list[np.ndarray], times: np.ndarray) -> list[np.ndarray]:
        """Confirm the recurring windows by their counts, then locate them all with one automaton.

        The automaton reads a letter for each word, made from 20 bits of its
        code, and holds the first words of each confirmed window. Where it
        stops, the whole window is compared by its 64-bit hash.
        """
        hashes = [self.window_hashes(c) for c in contents]
        every = np.concatenate(hashes)
        confirmed, first, back, n = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
        lengths = np.array([len(h) for h in hashes])
        owner = np.repeat(np.arange(len(contents)), lengths)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        n = np.bincount(back, weights=times[owner], minlength=len(n))
        letters = [(0x10000 + (c >> np.uint32(12))).astype("<u4").tobytes().decode("utf-32-le") for c in contents]
        automaton, head = ahocorasick.Automaton(), min(HEAD, self.window)
        alike: dict[int, list[int]] = {}  # further windows that begin like one in the automaton
        recurring = np.nonzero(n > 1)[0]
        for number, c, p in zip(recurring.tolist(), owner[first[recurring]].tolist(), place[first[recurring]].tolist(), strict=True):
            pattern = letters[c][p : p + head]
            if pattern in automaton:
                alike.setdefault(automaton.get(pattern), []).append(number)
            else:
                automaton.add_word(pattern, number)
        marks = [np.zeros(k, dtype=bool) for k in lengths]
        if len(automaton):
            automaton.make_automaton()
            for c, text in enumerate(letters):
                found = list(automaton.iter(text, 0, int(lengths[c]) + head - 1))
                if found:
                    at, number = np.array(found, dtype=np.int64).T
                    at -= head - 1
                    same = hashes[c][at] == confirmed[number]
                    marks[c][at[same]] = True
                    for p, one in zip(at[~same].tolist(), number[~same].tolist(), strict=True):
                        marks[c][p] |= any(hashes[c][p] == confirmed[other] for other in alike.get(one, ()))
        return marks


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """key_id, key_text and spans (word numbers) of the documents with recurring passages."""
    return repeats(docs, Words(window), keep_runs=False)


CUT_ROWS = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def cut(text: str, spans: list, with_text: bool = True) -> tuple[int, int, str, str | None]:
    """Words, words removed, the hash of the kept ones, and the text without the removed ones (None: as it was).

    What stays of the text keeps its own blanks; where words were taken out
    the two ends meet in one space.
    """
    words = text.encode("utf-8", "surrogatepass").split()  # splits bytes at the blanks named in WORD
    starts, ends = covered(spans, len(words))
    if not len(starts):
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), None
    bounds = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(words)]
    keep = [w for a, b in zip(bounds[::2], bounds[1::2], strict=True) for w in words[a:b]]
    digest, kept_text = hashlib.sha256(b" ".join(keep)).hexdigest(), None
    if with_text:
        at = [m.span() for m in WORD_OF.finditer(text)]
        kept_text = " ".join(text[at[a][0] : at[b - 1][1]] for a, b in zip(bounds[::2], bounds[1::2], strict=True) if b > a)
    return len(words), int((ends - starts).sum()), digest, kept_text


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True, more: tuple[str, ...] = ()) -> DataFrame:
    """A row for each document: doc_id, the columns named in more, n_words, n_removed, kept_sha256 and kept_text.

    Each word in a window of so many words whose sequence also starts
    elsewhere is removed, in every copy. A null text has no words; documents
    shorter than a window keep all. Repeated rows are copies of each other.
    Texts of any length are read whole, in units of bounded size. An empty
    table gives no rows. kept_text is null where nothing was removed, and
    left out without with_text.
    """
    spans = repeated_spans(docs, window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = [cut(t, s, with_text) for t, s in zip(frame.pop("text"), frame.pop("spans"), strict=True)]
            frame["n_words"], frame["n_removed"], frame["kept_sha256"], frame["kept_text"] = zip(*found, strict=True)
            if not with_text:
                del frame["kept_text"]
            yield frame

    rows = keyed(docs, *more).join(spans, KEYS, "left").select("doc_id", *more, "text", "spans")
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select("doc_id", *more).schema.fields]
    wanted = CUT_ROWS if with_text else CUT_ROWS.rpartition(",")[0]
    return rows.mapInPandas(run, ", ".join([*columns, wanted]))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The input's rows and columns with the recurring passages taken out of text; see remove_repeats().

    Texts without any, null ones included, stay as they are. A column n_chars
    is set to the length of what is left.
    """
    spans = repeated_spans(docs, window)
    names = docs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            kept = [
                t if s is None else cut(t, s)[3] for t, s in zip(frame["text"], frame.pop("_llm_spans"), strict=True)
            ]
            if "n_chars" in frame:
                frame["n_chars"] = [n if k is t else len(k) for n, k, t in zip(frame["n_chars"], kept, frame["text"], strict=True)]
            frame["text"] = kept
            yield frame[names]

    marked = docs.select("*", *[c.alias(f"_llm_{k}") for k, c in zip(KEYS, key_columns(), strict=True)])
    joined = marked.join(spans.toDF("_llm_key_id", "_llm_key_text", "_llm_spans"), ["_llm_key_id", "_llm_key_text"], "left")
    return joined.select(*names, "_llm_spans").mapInPandas(run, docs.schema)
