import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import plain
from samples import odd_rows
from tidewatch.llm import packing, sharding


def test_packing_places_every_piece(odd_docs, tokenizer_path):
    rows = sorted(packing.pack(odd_docs, tokenizer_path).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    at = {}
    for r in rows:
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= packing.CAPACITY
    assert len(at) == plain.best_fit([r["length"] for r in rows], packing.CAPACITY)
    tokenizer, expected = Tokenizer.from_file(tokenizer_path), Counter()
    for doc_id, text, *_ in odd_rows():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        first = len(ids) % 1024 if len(ids) > 1024 else len(ids)
        cuts = [0, *range(first or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected


def test_nothing_to_pack(no_docs, tokenizer_path):
    assert packing.pack(no_docs, tokenizer_path).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_plan_opens_as_many_as_one_by_one(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, 500)
    plan = packing.plan_packing(dict(Counter(lengths.tolist())), 100)
    loads = Counter()
    for length, low, high, each, first, offset in plan:
        for rank in range(high - low):
            sequence = first + rank // each
            assert loads[sequence] == offset + rank % each * length
            loads[sequence] += length
    assert sum(loads.values()) == lengths.sum() and max(loads.values()) <= 100
    assert len(loads) == plain.best_fit(lengths.tolist(), 100)


def test_remembered_words_equal_the_tokenizer(tokenizer_path):
    words, tokenizer = packing.WordIds(tokenizer_path), Tokenizer.from_file(tokenizer_path)
    texts = [
        "a  b", " a", "a ", "a\n b", "a \nb", "it's  we'll", " x  y", "x\0y z", "<|endoftext|> a", "été 12,5 !!", "a\tb c",
        "", "x 　y", "  ", "\n\n a\n\n", "a\u0085 b", "\x1c a \x1c",
    ]
    for _ in range(2):
        got = [np.frombuffer(b, dtype="<u4").tolist() for b in words.encode(texts)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_shards_share_the_table_evenly_and_move_little():
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    sizes = np.bincount(table, minlength=7)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    stayed = (table == fewer)[table < 6].mean()
    assert stayed > 0.8
    orders = {n: [(a + k * b) % 1009 for k in range(1009)] for n in names for a, b in [sharding.preference(n, 1009)]}
    plain_table, at = [None] * 1009, dict.fromkeys(names, 0)
    while None in plain_table:
        for i, n in enumerate(names):
            while at[n] < 1009 and plain_table[orders[n][at[n]]] is not None:
                at[n] += 1
            if at[n] < 1009:
                plain_table[orders[n][at[n]]] = i
    assert table.tolist() == plain_table
    for wrong in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 1000)


def test_every_row_is_placed(odd_docs, no_docs, tmp_path):
    names = ["a", "b", "c"]
    placed = sharding.place(odd_docs, "doc_id", names)
    rows = placed.collect()
    assert len(rows) == len(odd_rows())
    table = sharding.lookup_table(names)
    assert all(r["shard"] == names[table[r["slot"]]] == names[r["shard_no"]] for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] == 3}) == 1
    assert len({r["slot"] for r in rows if r["doc_id"] is None}) == 1
    assert sum(r["n_rows"] for r in sharding.loads(placed).collect()) == len(rows)
    sharding.write_shards(placed, str(tmp_path / "out"))
    assert odd_docs.sparkSession.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert sharding.place(no_docs, "doc_id", names).collect() == []
