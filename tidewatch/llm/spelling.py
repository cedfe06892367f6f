"""Groups of spelling variants: words one edit apart, found by pivotal grams.

The bigrams of a word are ordered from rare to frequent over all words. Its
prefix are its three rarest (with those that tie with the third), and among
them dynamic programming chooses two that do not overlap and are rarest
together: the pivots. One edit spoils one pivot at most, so of two words that
are one edit apart, the one whose prefix ends first has a pivot that the other
holds in its prefix, at the same place or one off.

The edit lies before the pivots, between them, after them, or in one of them.
In each case all other parts of the word are left as they are. So the index
has a key for each case, made of the parts that stay, and the other words look
up what their prefix grams leave of them. Matches are verified exactly.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import python_ready, slices, stored, texts_of

#: Code points of the shortest words, and how often a word occurs at least.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form occurs at least this many times as often as its variant.
TIMES = 2
#: Grams in a prefix: the length of a gram times the edits allowed, and one more.
PREFIX = 3
#: Different words that a task holds before it sends their counts on.
WORDS_HELD = 500_000

KEYS = "word string, n long, last int, key string"


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, spoiled: int = 0) -> DataFrame:
    """word and n of all words of the texts, runs of ASCII and Latin-1 letters with A-Z in lower case.

    With spoiled, a run loses a letter in every document for which that number
    divides the crc32 of `<doc_id>:<run>` (a way to plant misspellings); rows
    without an id lose none. Null texts have no words.
    """
    python_ready(docs.sparkSession)
    letters = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for frame in slices(batches):
            ids = frame["doc_id"].tolist() if spoiled else [None] * len(frame)
            for doc_id, text in zip(ids, frame["text"], strict=True):
                own = Counter(letters.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if doc_id is None or doc_id != doc_id:
                    held.update(own)
                    continue
                start = zlib.crc32(f"{int(doc_id)}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % spoiled == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] += n
            if len(held) > WORDS_HELD:
                yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    found = texts_of(docs).mapInPandas(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """The place of each bigram from rare to frequent, and its number of occurrences.

    There are at most as many as pairs of letters, whatever the number of words.
    """
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.filter(F.length("word") > 1).select("word", F.explode(at).alias("at"))
    counted = grams.select(F.expr("substring(word, at, 2)").alias("gram")).groupBy("gram").count().collect()
    return {r["gram"]: (place, r["count"]) for place, r in enumerate(sorted(counted, key=lambda r: (r["count"], r["gram"])))}


def prefix_of(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], int]:
    """Positions of the rarest grams of a word, with all that tie with the last of them, and the place of the last."""
    grams = sorted((order[word[i : i + 2]][0], i) for i in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    return sorted(i for place, i in grams if place <= last), last


def pivots_of(word: str, positions: list[int], order: dict[str, tuple[int, int]], many: int = 2) -> list[int]:
    """Positions of so many prefix grams that do not overlap and are rarest together.

    best[k][j] is the least number of occurrences of k grams among the first j.
    """
    rare = [order[word[i : i + 2]][1] for i in positions]
    free = [sum(p + 2 <= i for p in positions) for i in positions]  # those that end before this one
    best = [[0] * (len(positions) + 1)]
    for k in range(1, many + 1):
        row = [float("inf")]
        for j, cost in enumerate(rare):
            row.append(min(row[-1], best[k - 1][free[j]] + cost))
        best.append(row)
    chosen, j = [], len(positions)
    for k in range(many, 0, -1):
        while best[k][j] == best[k][j - 1]:
            j -= 1
        chosen.append(positions[j - 1])
        j = free[j - 1]
    return chosen[::-1]


def pivot_keys(word: str, pivots: list[int]) -> list[str]:
    """What is left of a word if the edit lies before, after, between or in one of its pivots."""
    p, q = pivots
    return [
        "A" + word[p:],
        "C" + word[: q + 2],
        f"M{word[: p + 2]} {word[q:]}",
        f"H{word[:p]} {word[p + 2 :]}",
        f"H{word[:q]} {word[q + 2 :]}",
    ]


def prefix_keys(word: str, positions: list[int]) -> list[str]:
    """What an edited word can have left of another, given that the grams at these positions are not edited."""
    keys = ["A" + word[i:] for i in positions] + ["C" + word[: i + 2] for i in positions]
    keys += [f"M{word[: i + 2]} {word[j:]}" for i in positions for j in positions if i + 2 <= j]
    first, last = positions[0], positions[-1]
    for begin in range(len(word)):
        for end in range(begin + 1, min(begin + 3, len(word)) + 1):  # an edited gram has one to three letters
            if end <= last or begin >= first + 2:
                keys.append(f"H{word[:begin]} {word[end:]}")
    return keys


def _keys(words: DataFrame, order: dict[str, tuple[int, int]], index: bool) -> DataFrame:
    sent = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = sent.value
        for frame in batches:
            for begin in range(0, len(frame), 2000):
                part = frame.iloc[begin : begin + 2000]
                lasts, keys = [], []
                for word in part["word"]:
                    positions, last = prefix_of(word, grams)
                    lasts.append(last)
                    keys.append(
                        pivot_keys(word, pivots_of(word, positions, grams)) if index else prefix_keys(word, positions)
                    )
                many = [len(k) for k in keys]
                yield pd.DataFrame({
                    "word": np.repeat(part["word"].to_numpy(), many),
                    "n": np.repeat(part["n"].to_numpy(), many),
                    "last": np.repeat(lasts, many),
                    "key": [k for own in keys for k in own],
                })

    return words.mapInPandas(run, KEYS).withColumn("key", F.xxhash64("key"))


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near and near_n of all pairs of words one edit apart, in both directions.

    words: different words of at least five code points, and n. The keys are
    merged: Spark takes them for little more than the words' compressed file,
    although a word has five in the index and very many more to look up, and
    would send them all through the driver.
    """
    order = gram_order(words)
    pivots, prefixes = (_keys(words, order, index) for index in (True, False))
    left = pivots.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    right = prefixes.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    met = left.join(right.hint("merge"), "key").filter(
        (F.col("a_last") <= F.col("b_last"))
        & (F.abs(F.length("a") - F.length("b")) <= 1)
        & (F.col("a") != F.col("b"))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    both = met.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )).alias("pair")).select("pair.*")
    return both.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the last of the forms that follow from word, form.

    A form occurs at least twice as often as its word, so there are no rings
    and few steps; each round doubles the steps that are taken together.
    """
    taken = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = taken.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(
            taken.join(onward.hint("merge"), "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            ), "roots",
        )
        taken = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return taken


def variants(words: DataFrame) -> DataFrame:
    """A row for each word: word, form, root, n, n_near and form_n.

    words: word and n, each word once, of at least five code points. Two words
    are near if one code point is inserted, deleted or replaced. The form is
    the near word of largest n, the first in code-point order among equals, if
    it occurs at least twice as often as the word, else null; root follows the
    forms to the last and is the word itself where there is none. An empty
    table gives no rows.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.join(best.hint("merge"), "word", "left")
    taken = -F.col("best.less") >= TIMES * F.col("n")
    found = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
        ), "forms",
    )
    ended = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ended.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, spoiled: int = 0) -> DataFrame:
    """variants() of the words of all texts that have at least five letters and occur three times.

    Null and empty texts have no words; repeated rows count as often as they
    occur; other columns are not read; an empty table gives no rows. Texts of
    any length are read whole.
    """
    return variants(word_counts(docs, spoiled=spoiled))
