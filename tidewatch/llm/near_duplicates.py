"""Near-duplicate documents: DartMinHash signatures, banded joins, exact similarity and components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import KEYS, key_columns, keyed, mixed, python_ready, slices, stored
from tidewatch.llm.components import components
from tidewatch.llm.recurring import STEP, gram_hashes
from tidewatch.llm.repeated_phrases import word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8^5)^22 = 0.9998.
BANDS, ROWS = 22, 5
#: Pairs whose one-bit signatures differ in more places are not compared: at
#: similarity 0.8 about 11 of the 110 differ, and more than 27 in 1 of 10^6.
MOST_BITS = 27
SEED = np.uint64(0xD1B54A32D192ED03)
#: Bits that say which of so many parts of the hashes hold an odd number of shingles. Two sets
#: differ in at least as many shingles as they do in these bits, so no similar pair is lost by them.
ODD_BITS = 1024


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of so many consecutive words and how often each occurs; a shorter text is one shingle."""
    words = word_hashes(text.encode("utf-8", "surrogatepass"))
    return np.unique(gram_hashes(words, min(size, max(1, len(words)))), return_counts=True)


def dart_signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """k samples of each document: equal in a coordinate with the probability of the weighted similarity.

    The area of an element is its weight wide and endless in height, in cells
    one unit wide. Darts fall there at hashed places, one for each unit of
    area on average, so two documents see the same darts where their areas
    overlap. Each dart has a hashed coordinate; the lowest dart of each
    coordinate is kept. About k (ln k + 2) of the lowest darts fill all
    coordinates; where some stay empty, the height is doubled. Returns hashes
    of darts, a row for each document; each document must have some weight.
    """
    out = np.zeros((n_docs, k), dtype=np.uint64)
    total = np.bincount(owner, weights=weights, minlength=n_docs)
    height = k * (np.log(k) + 2) / np.maximum(total, 1e-300)
    todo = np.arange(n_docs)
    while len(todo):
        number = np.full(n_docs, -1, dtype=np.int64)
        number[todo] = np.arange(len(todo))
        mine = number[owner] >= 0
        cells = np.ceil(weights[mine]).astype(np.int64)
        which = np.repeat(np.nonzero(mine)[0], cells)
        cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
        base = mixed(elements[which] + cell.astype(np.uint64) * SEED)
        room, top, doc = weights[which] - cell, height[owner[which]], number[owner[which]]
        at, turn, slots, ranks, darts = np.zeros(len(which)), 0, [], [], []
        while len(base):
            turn += 1
            own = mixed(base + np.uint64(turn * STEP % 2**64))
            at = at - np.log(((own >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            low = at <= top
            base, room, top, doc, at, own = base[low], room[low], top[low], doc[low], at[low], own[low]
            place = mixed(own ^ SEED)
            inside = (place >> np.uint64(40)).astype(np.float64) * 2.0**-24 < room
            slots.append(doc[inside] * k + ((place[inside] & np.uint64(0xFFFFFF)) % np.uint64(k)).astype(np.int64))
            ranks.append(at[inside] / top[inside])
            darts.append(own[inside])
        slot, rank, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
        order = np.argsort((slot.astype(np.uint64) << np.uint64(32)) | (rank * (2**32 - 1)).astype(np.uint64))
        slot = slot[order]
        first = np.ones(len(slot), dtype=bool)
        first[1:] = slot[1:] != slot[:-1]
        full = np.bincount(slot[first] // k, minlength=len(todo)) == k
        found = np.zeros(len(todo) * k, dtype=np.uint64)
        found[slot[first]] = dart[order][first]
        out[todo[full]] = found.reshape(-1, k)[full]
        todo = todo[~full]
        height[todo] *= 2
    return out


SIGNED = "key_id long, key_text int, node binary, n_shingles int, bits_a long, bits_b long, odd array<long>, bands array<long>"


def signed(docs: DataFrame, counted: bool = False, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The node (a digest of the shingles) and signature of each document; one without words has no bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(batches, 1_000_000):
            sets = [shingles(t) for t in frame["text"]]
            n = np.array([len(s) for s, _ in sets])
            live = np.nonzero(n)[0]
            nodes = [
                hashlib.blake2b(s.tobytes() + (c.tobytes() if counted else b""), digest_size=16).digest()
                if len(s) else hashlib.blake2b(f"no words {key}".encode(), digest_size=16).digest()
                for (s, c), key in zip(sets, frame["key_id"], strict=True)
            ]
            odd = np.zeros((len(frame), ODD_BITS), dtype=np.uint8)
            for i, (s, c) in enumerate(sets):
                each = s if not counted else np.repeat(s, c) + np.concatenate([np.arange(k, dtype=np.uint64) for k in c]) * SEED if len(s) else s
                odd[i] = np.bincount((mixed(each) >> np.uint64(54)).astype(np.int64), minlength=ODD_BITS) & 1
            odd = np.packbits(odd, axis=1).view(np.int64)
            if counted:
                n = np.array([int(c.sum()) for _, c in sets])
            keys, bits = np.zeros((len(frame), bands), dtype=np.int64), np.zeros((len(frame), 2), dtype=np.int64)
            if len(live):
                counts = np.concatenate([sets[i][1] for i in live]).astype(np.float64)
                found = dart_signatures(
                    np.concatenate([sets[i][0] for i in live]), counts if counted else np.ones(len(counts)),
                    np.repeat(np.arange(len(live)), [len(sets[i][0]) for i in live]), len(live), bands * rows,
                )
                grid = found.reshape(len(live), bands, rows)
                own = np.broadcast_to(np.arange(bands, dtype=np.uint64) * SEED, (len(live), bands))
                for r in range(rows):
                    own = mixed(own + grid[:, :, r])
                keys[live] = own.view(np.int64)
                single = ((found >> np.uint64(7)) & np.uint64(1)).astype(np.uint64)
                for half, part in enumerate((single[:, :64], single[:, 64:128])):
                    shifts = np.arange(part.shape[1], dtype=np.uint64)
                    bits[live, half] = (part << shifts).sum(axis=1, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({
                "key_id": frame["key_id"], "key_text": frame["key_text"], "node": nodes, "n_shingles": n.astype(np.int32),
                "bits_a": bits[:, 0], "bits_b": bits[:, 1], "odd": list(odd), "bands": [x if m else x[:0] for x, m in zip(keys, n, strict=True)],
            })

    return docs.select(*KEYS, "text").mapInPandas(run, SIGNED)


def may_be_similar(a: str, b: str, least: float) -> Column:
    """By size and by the one-bit signatures."""
    sizes = F.least(f"{a}.n_shingles", f"{b}.n_shingles") >= least * F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    apart = [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in ("bits_a", "bits_b")]
    return sizes & (apart[0] + apart[1] <= MOST_BITS)


def differ_little(a: str, b: str, least: float) -> Column:
    """Whether the odd bits differ in no more places than similar sets of these sizes have different shingles."""
    apart = sum(
        (F.bit_count(F.col(f"{a}.odd")[i].bitwiseXOR(F.col(f"{b}.odd")[i])) for i in range(ODD_BITS // 64)), F.lit(0)
    )
    return apart <= (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")) * ((1 - least) / (1 + least)) + 1e-6


def similar_pairs(pairs: DataFrame, texts: DataFrame, least: float, counted: bool) -> DataFrame:
    """Those of the pairs (a, b) whose exact similarity reaches the least one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            keep = []
            for one, other in zip(frame["text_a"], frame["text_b"], strict=True):
                (x, n), (y, m) = shingles(one), shingles(other)
                _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                shared, total = (np.minimum(n[i], m[j]).sum(), n.sum() + m.sum()) if counted else (len(i), len(x) + len(y))
                keep.append(shared >= least * (total - shared) * (1 - 1e-12))
            yield frame.loc[keep, ["a", "b"]]

    sides = [texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b").mapInPandas(
        run, "a binary, b binary"
    )


def classes(docs: DataFrame, least: float = SIMILARITY, counted: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables: key_id, key_text and node of each document, and the component of each node that has links.

    Documents with the same shingles are one node. In each bucket of a band
    the node that meets the most others is compared with the rest; what is
    then still in different components is compared with each other, as far as
    sizes and signatures allow. So no group of copies is expanded into pairs,
    and no pair of unequal texts that shares a band is left out.
    """
    spark = docs.sparkSession
    python_ready(spark)
    rows = keyed(docs)
    signs = stored(signed(rows, counted), "signs")
    nodes = signs.groupBy("node").agg(
        F.min(F.struct(*KEYS)).alias("first"),
        *[F.first(c).alias(c) for c in ("n_shingles", "bits_a", "bits_b", "odd", "bands")],
    )
    own = ["node", "n_shingles", "bits_a", "bits_b"]
    spread = nodes.select(*own, "first", F.explode("bands").alias("band"))
    full = spread.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    met = stored(spread.join(full, "band"), "met")
    degrees = met.groupBy("node").agg(F.sum("n").alias("degree"), F.first("first").alias("first"))
    ranked = met.join(degrees.select("node", "degree"), "node")
    leaders = ranked.groupBy("band").agg(
        F.max(F.struct("degree", "node", "n_shingles", "bits_a", "bits_b")).alias("top")
    ).select("band", "top.*").drop("degree")
    m, lead = met.alias("m"), leaders.alias("l")
    led = m.join(lead, "band").filter((F.col("m.node") != F.col("l.node")) & may_be_similar("m", "l", least))
    compared = stored(led.select(
        F.least("m.node", "l.node").alias("a"), F.greatest("m.node", "l.node").alias("b")
    ).distinct(), "compared")
    texts = stored(
        rows.select(*KEYS, "text").join(degrees.select("node", "first.*"), KEYS).select("node", "text").dropDuplicates(["node"]),
        "texts",
    )
    edges = stored(similar_pairs(compared, texts, least, counted), "edges")
    joined = components(edges)
    placed = met.select("band", *own).join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed_bands = placed.groupBy("band").agg(
        (F.min("component") != F.max("component")).alias("several")
    ).filter("several").select("band")
    open_ones = stored(placed.join(mixed_bands, "band").join(nodes.select("node", "odd"), "node"), "open")
    x, y = open_ones.alias("x"), open_ones.alias("y")
    across = (
        (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.component") != F.col("y.component")) & may_be_similar("x", "y", least) & differ_little("x", "y", least)
    )
    more = x.join(y, across).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    rest = stored(more.join(compared, ["a", "b"], "left_anti"), "compared")
    further = stored(similar_pairs(rest, texts, least, counted), "edges")
    if not further.isEmpty():  # joins components, as few links between their least nodes
        own = joined.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
        other = joined.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
        between = further.join(own, "a", "left").join(other, "b", "left").select(
            F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")
        )
        last = components(between).toDF("component", "last")
        joined = joined.join(last, "component", "left").select(
            "node", F.coalesce("last", "component").alias("component")
        ).unionByName(last.toDF("node", "component"))
    return signs.select(*KEYS, "node"), joined


def near_duplicate_classes(docs: DataFrame, least: float = SIMILARITY, counted: bool = False) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and class_size of each document.

    Similarity is that of the sets of five-word shingles, or with counted of
    their multisets. Classes are components of the links between documents of
    at least this similarity. A document without words, null text included,
    is a class of its own. Repeated rows are in one class. Rows without an id
    are placed like others, but name no class. Other columns are not read; an
    empty table gives no rows.
    """
    signs, joined = classes(docs, least, counted)
    placed = keyed(docs).select("doc_id", *KEYS).join(signs.distinct(), KEYS).join(joined, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("class")
    )
    sizes = placed.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(sizes, "class").select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The input's rows and columns, one row for each class: that with the least doc_id."""
    signs, joined = classes(docs, least)
    names = docs.columns
    marked = docs.select(
        F.struct("*").alias("row"), "doc_id", *[c.alias(k) for k, c in zip(KEYS, key_columns(), strict=True)]
    )
    placed = marked.join(signs.distinct(), KEYS).join(joined, "node", "left").withColumn(
        "class", F.coalesce("component", "node")
    )
    order = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last(), "key_text")
    first = placed.withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    return first.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
