"""Token counts, periodic runs and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import plain
from samples import odd_rows, prose
from tidewatch.llm import periodic_runs, queries, spelling, token_counts
from tidewatch.llm.common import shared_folder


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, 0 if x is None else x) for x in r))


# token counts


def tokens_of(tokenizer_path, texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(tokenizer_path).encode_batch(texts, add_special_tokens=False)]


def counted(frame):
    return order([(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"], r["was_cached"]) for r in frame.collect()])


def expected_counts(rows, tokenizer_path, known=()):
    texts = [r[1] or "" for r in rows]
    return order([
        (r[0], len(t.encode()), n, n > 512, t in known)
        for r, t, n in zip(rows, texts, tokens_of(tokenizer_path, texts), strict=True)
    ])


def test_counts_and_a_second_run_from_the_cache(spark, odd_docs, tokenizer_path, monkeypatch):
    rows, cache = odd_rows(), shared_folder(spark, "test-cache")
    extra = [(90, "x <|endoftext|> y", *rows[0][2:]), (91, prose("fresh", 900), *rows[0][2:])]
    assert counted(token_counts.count_tokens(odd_docs, tokenizer_path, cache)) == expected_counts(rows, tokenizer_path)
    sent = []
    plain_encode = token_counts.encode
    monkeypatch.setattr(token_counts, "encode", lambda t, p: (sent.append(t), plain_encode(t, p))[1])
    more = odd_docs.unionByName(spark.createDataFrame(extra, odd_docs.schema))
    again = token_counts.count_tokens(more, tokenizer_path, cache)
    assert counted(again) == expected_counts(rows + extra, tokenizer_path, {r[1] or "" for r in rows})
    assert sorted(r["text"] for r in sent[0].collect()) == sorted(e[1] for e in extra)
    token_counts.count_tokens(more, tokenizer_path, cache).collect()
    assert len(sent) == 1  # nothing was missing
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({r[1] or "" for r in rows + extra})


def test_another_tokenizer_is_another_cache(spark, odd_docs, tokenizer_path):
    cache, docs = shared_folder(spark, "test-cache"), odd_docs.filter("doc_id < 4")
    first = token_counts.count_tokens(docs, tokenizer_path, cache)
    other = token_counts.count_tokens(docs, tokenizer_path, cache, version=lambda p: "newer")
    assert not any(r["was_cached"] for r in first.collect() + other.collect())
    packed = token_counts.compact(spark, cache, tokenizer_path)
    assert all(r["was_cached"] for r in token_counts.count_tokens(docs, tokenizer_path, packed).collect())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_tokenizers_that_normalise(spark, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    texts = ["Some Words", "some  words", "SOME words ", "<|ENDOFTEXT|> a", "<|endoftext|> a", "", None, "été"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = token_counts.count_tokens(docs, path, shared_folder(spark, "test-cache"))
    made = token_counts.Counter(path)
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == {
        i: made.counts([t or ""])[0] for i, t in enumerate(texts)
    }


def test_runs_beside_each_other_may_store_a_digest_twice(spark, odd_docs, tokenizer_path):
    cache = shared_folder(spark, "test-cache")
    token_counts.count_tokens(odd_docs, tokenizer_path, cache).collect()
    version = token_counts.tokenizer_version(tokenizer_path)
    token_counts._append(token_counts.cached(spark, cache, version), cache, version)
    assert token_counts.count_tokens(odd_docs, tokenizer_path, cache).count() == len(odd_rows())


# periodic runs


def plain_runs(words, least=12):
    """Every stretch in which words q apart agree, for all q; the smallest q of a stretch is its period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_periods(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return words if h % 10 else [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    words = plain_periods(doc_id, plain.WORD.findall(text or ""))
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha, len(words))


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(400):
        least, documents = rng.choice([2, 3, 8, 12, 12, 21]), []
        for _ in range(rng.randint(1, 4)):
            words = [b"%d" % rng.randint(0, rng.randint(0, 3)) for _ in range(rng.randint(0, 70))]
            a, p = rng.randint(0, len(words)), rng.randint(1, 12)
            documents.append([w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)])
        text, offsets = periodic_runs.joined(documents)
        s, e, q = periodic_runs.runs_of(text, least)
        of = np.searchsorted(offsets, s, side="right") - 1
        for d, words in enumerate(documents):
            got = [(a - offsets[d], b - a, c) for a, b, c in zip(s[of == d], e[of == d], q[of == d], strict=True)]
            assert got == plain_runs(words, least)


def test_tests_in_small_pieces(monkeypatch):
    words = [b"a", b"b", b"a"] * 50 + [b"c"] * 40 + [b"%d" % (i % 7) for i in range(90)]
    text, _ = periodic_runs.joined([words])
    whole = [x.tolist() for x in periodic_runs.runs_of(text)]
    monkeypatch.setattr(periodic_runs, "AT_ONCE", 16)
    assert [x.tolist() for x in periodic_runs.runs_of(text)] == whole


def runs_table(spark, tmp_path, rows, columns):
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "documents.parquet"))
    frame = queries.op12_periodic_runs(spark, str(tmp_path))
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")
    return order([tuple(r[c] for c in names) for r in frame.collect()])


def test_runs_of_odd_documents(spark, tmp_path, odd_docs):
    rows = [r for r in odd_rows() if len(r[1] or "") < 20000]
    rows += [(i, prose(i, i % 90) + " x y" * (i % 9), *rows[0][2:]) for i in range(100, 180)]
    rows += [(200, "la " * 3000, *rows[0][2:]), (201, "a\x1cb " * 20 + "a b", *rows[0][2:])]
    assert runs_table(spark, tmp_path, rows, odd_docs.schema) == order([plain_row(r[0], r[1]) for r in rows])


def test_no_documents_no_runs(spark, tmp_path, no_docs):
    assert runs_table(spark, tmp_path, [], no_docs.schema) == []


def test_runs_of_the_small_table(spark, sf_dir):
    rows = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r["text"] or "") < 12000]
    expected = {r["doc_id"]: plain_row(r["doc_id"], r["text"])[1:] for r in rows}
    found = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")
    assert len(expected) > 100 and sum(e[0] > 0 for e in expected.values()) > 10
    for doc_id, values in expected.items():
        assert tuple(found[doc_id][c] for c in names) == values


# spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(SMALL)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def plain_variants(counts):
    words, near = sorted(counts), {w: [] for w in counts}
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    forms = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, counts[w], len(near[w]), counts.get(forms[w])))
    return out


def variant_rows(frame):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect())


def test_variants_of_the_small_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = plain_variants(plain_words(rows))
    assert variant_rows(queries.op13_spelling_variants(spark, sf_dir)) == expected
    assert sum(e[1] is not None for e in expected) > 20


def test_variants_of_few_letters(spark):
    """Words of two letters over and over: all grams tie, prefixes are long, and forms are followed over several steps."""
    rng = random.Random(3)
    counts = {}
    for _ in range(500):
        word = "".join(rng.choice("abÀÿ" if rng.random() < 0.1 else "ab") for _ in range(rng.randint(5, 9)))
        counts[word] = 3 * 2 ** rng.randint(0, 12) + rng.randint(0, 1)
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert variant_rows(found) == plain_variants(counts)
    assert max(e[4] for e in plain_variants(counts)) > 8


def test_keys_of_stored_words_are_not_broadcast(spark):
    """Spark takes them for little more than the words' file, which is small however many keys a word has."""
    counts = {prose(i, 1) + "xyx"[: i % 4]: 3 + i for i in range(60)}
    words = spelling.stored(spark.createDataFrame([*counts.items()], "word string, n long").filter("length(word) >= 5"), "words")
    found = [spelling.near_words(words), spelling.variants(words)]
    for frame in found:
        assert frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_words_of_odd_documents(spark, odd_docs, no_docs):
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = {r["word"]: r["n"] for r in spelling.word_counts(odd_docs, spoiled=97).collect()}
    assert found == plain_words(rows)
    assert variant_rows(spelling.spelling_variants(odd_docs, spoiled=97)) == plain_variants(plain_words(rows))
    assert spelling.spelling_variants(no_docs).collect() == []


def test_pivots_are_the_rarest_pair(spark):
    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 12)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        chances = sorted(rng.randint(1, 50) for _ in grams)
        rng.shuffle(grams)
        places = {g: (i, n) for i, (g, n) in enumerate(zip(grams, chances, strict=True))}
        positions, last = spelling.prefix_of(word, places)
        pivots = spelling.pivots_of(word, positions, places)
        cost = lambda pair: sum(places[word[i : i + 2]][1] for i in pair)
        assert cost(pivots) == min(cost((i, j)) for i in positions for j in positions if j >= i + 2)
        assert set(pivots) <= set(positions) and pivots[1] >= pivots[0] + 2 and len(positions) >= 3
