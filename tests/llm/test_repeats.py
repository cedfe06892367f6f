import numpy as np
import pytest

import plain
from samples import odd_rows, prose
from tidewatch.llm import recurring, repeated_phrases, suffix_arrays


def keyed_rows(rows, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rows)


@pytest.fixture(params=[2000, 2])
def runs_of_anchor(request, monkeypatch):
    """With few runs to a shard most anchors are split, and windows are counted over shards."""
    monkeypatch.setattr(recurring, "RUNS_OF_ANCHOR", request.param)


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def test_phrases_equal_a_plain_count(odd_docs, runs_of_anchor):
    rows = odd_rows()
    words = [tuple(plain.WORD.findall(r[1] or "")) for r in rows]
    expected = [(r[0], *plain.phrases(r[1], m)) for r, m in zip(rows, plain.removed(words, 35), strict=True)]
    found = repeated_phrases.remove_repeats(odd_docs)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found.collect()]
    assert order(got) == order(expected)
    assert sum(e[2] for e in expected) > 300


def test_strings_equal_a_plain_count(odd_docs, runs_of_anchor):
    rows = odd_rows()
    expected = [
        (r[0], *plain.strings(r[1], m))
        for r, m in zip(rows, plain.removed([(r[1] or "").encode() for r in rows], 400), strict=True)
    ]
    found = suffix_arrays.remove_repeats(odd_docs)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()]
    assert order(got) == order(expected)


def test_kept_strings_are_given_as_text(odd_docs):
    rows = odd_rows()
    marks = plain.removed([(r[1] or "").encode() for r in rows], 400)
    expected = [
        (r[0], bytes(b for b, m in zip((r[1] or "").encode(), own, strict=True) if not m).decode("utf-8", "replace"))
        for r, own in zip(rows, marks, strict=True)
    ]
    found = suffix_arrays.remove_repeats(odd_docs, with_bytes=False, with_text=True)
    assert order((r["doc_id"], r["text"]) for r in found.collect()) == order(expected)
    assert any(m for own in marks for m in own)


def test_texts_without_repeats_stay_and_others_lose_them(spark, odd_docs):
    shared = prose("shared", 80)
    kept = repeated_phrases.without_repeats(odd_docs)
    assert kept.schema == odd_docs.schema
    texts = {r["doc_id"]: r for r in kept.collect()}
    assert texts[1]["text"] == prose(1, 60) and texts[1]["n_chars"] == len(prose(1, 60))
    assert texts[14]["text"] == "" and texts[4]["text"] is None and texts[6]["text"] == " \t\n "
    assert all(shared not in (r["text"] or "") for r in texts.values())


def test_no_documents(no_docs):
    assert repeated_phrases.remove_repeats(no_docs).collect() == []
    assert suffix_arrays.remove_repeats(no_docs).collect() == []
    assert repeated_phrases.without_repeats(no_docs).collect() == []


def test_suffix_arrays_and_prefixes(monkeypatch):
    rng = np.random.default_rng(4)
    for letters in (1024, 4):
        monkeypatch.setattr(suffix_arrays, "MOST_LETTERS", letters)
        for _ in range(60):
            text = np.concatenate([rng.integers(1, rng.integers(2, 8), rng.integers(1, 120)), [0]])
            found = suffix_arrays.suffix_array(text)
            assert found.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
            shared = suffix_arrays.permuted_prefixes(text, found)
            for a, b in zip(found, found[1:]):
                n = 0
                while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                    n += 1
                assert shared[b] == n


def test_runs_do_not_depend_on_the_unit(monkeypatch):
    words = repeated_phrases.Words()
    docs = words.read([prose(1, 500), prose(2, 20), prose(3, 300), "a b c d e f " * 60])
    together = words.runs(docs)
    monkeypatch.setattr(recurring, "UNIT", 64)
    recurring.powers.cache_clear()
    apart = words.runs(docs)
    recurring.powers.cache_clear()
    windows = lambda r: sorted(
        (int(d), int(s) + k, int(a)) for d, s, n, a in zip(r.doc, r.start, r.n, r.anchor, strict=True) for k in range(n)
    )
    assert windows(together) == windows(apart)


def test_word_hashes_of_long_words_and_blanks(monkeypatch):
    texts = ["", " ", "a", "\x0ba\x0c\x1cb\r\n", "x" * 3000 + " y", "é è " * 10]
    whole = [repeated_phrases.word_hashes(t.encode()) for t in texts]
    assert [len(h) for h in whole] == [len(plain.WORD.findall(t)) for t in texts]
    monkeypatch.setattr(repeated_phrases, "BYTES_AT_ONCE", 7)
    assert all((repeated_phrases.word_hashes(t.encode()) == h).all() for t, h in zip(texts, whole, strict=True))
