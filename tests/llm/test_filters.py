import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import plain
from samples import odd_rows, prose
from pyspark.sql import functions as F

from tidewatch.llm import decontamination, lm_scoring, quality_rules, toxicity, url_rules
from tidewatch.llm.gated_model import GatedModel
from tidewatch.llm import gated_model
from tidewatch.operators import shuffles


def held_out(doc_id, folds):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds == 0


# quality


def test_base_columns_equal_plain_ones(odd_docs, no_docs):
    found = quality_rules.judge(odd_docs).collect()
    expected = []
    for doc_id, text, *_ in odd_rows():
        text = text or ""
        words = plain.WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        twice = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if plain.WORD.search(x)]
        failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
        expected.append((
            doc_id is None, doc_id or 0, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(twice), failed,
        ))
    got = [
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
         r["n_repeat_words"], r["base_failed"]) for r in found
    ]
    assert sorted(got) == sorted(expected)
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert quality_rules.judge(no_docs).collect() == []


def test_thresholds_follow_language_and_source(spark):
    rows = []
    for i in range(60):
        rows.append((i, prose(i, 100), "en", "plain"))
        rows.append((100 + i, " ".join(w + "#" * (i % 3 + 1) for w in prose(i, 100).split()), "en", "tagged"))
    rows.append((900, " ".join(w + "##" for w in prose(900, 100).split()), "en", "plain"))
    rows.append((901, " ".join(w + "#" * 40 for w in prose(901, 100).split()), "en", "tagged"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert [i for i, r in found.items() if not r["kept"]] in ([900, 901], [901, 900])
    assert found[900]["failed_rates"] == ["symbols_per_word"]
    measured = quality_rules.measured(docs, "lang", "source").withColumns(quality_rules.rates())
    halves = [quality_rules.sketches(measured.filter(f"doc_id % 2 = {k}"), ["lang", "source"]) for k in (0, 1)]
    merged = {r["source"]: r["n_docs"] for r in quality_rules.merge_sketches(halves, ["lang", "source"]).collect()}
    assert merged == {"plain": 61, "tagged": 61}


def plain_limits(groups, every, fence=6.0):
    """For each group of values the least and the most allowed, from sorted values."""
    def at(values, rank):
        return values[max(0, math.ceil(rank * len(values) - 1e-9) - 1)]

    out = {}
    for name, values in groups.items():
        values = sorted(values)
        mid, far, limits = at(values, 0.5), sorted(every), []
        for side, (near, tail, alike) in ((-1, (0.25, 0.001, 0.02)), (1, (0.75, 0.999, 0.98))):
            way = mid + 0.5 * (at(far, tail) - mid)
            near = at(values, near)
            wide, narrow = (max, min) if side > 0 else (min, max)
            limits.append(wide(near + fence * (near - mid), way) if near != mid else narrow(at(values, alike), way))
        out[name] = limits
    return out


def test_kept_equals_a_plain_judgement(spark):
    """Groups of 25 documents and more; below 800 values the sketches hold all of them."""
    rng, rows = random.Random(12), []
    for i in range(360):
        lang, source = ("en", "a") if i % 3 else (None, "b") if i % 2 else ("de", "b")
        words = prose(i, rng.randint(40, 90)).split()
        if rng.random() < 0.15:
            words = [w + "#" * rng.randint(0, 3) for w in words]
        if rng.random() < 0.1:
            words = [w.upper() if rng.random() < 0.5 else w[:2] for w in words]
        if rng.random() < 0.1:
            words = [w * 3 for w in words]
        lines = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
        if rng.random() < 0.15:
            lines += lines[:2]
        rows.append((i, "\n".join(lines), lang, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = quality_rules.judge(docs).collect()
    good = [r for r in found if not r["base_failed"]]
    bad = {r["doc_id"]: set() for r in found}
    for rate, sides in quality_rules.RATES.items():
        groups = {}
        for r in good:
            groups.setdefault((r["lang"], r["source"]), []).append(r[rate])
        limits = plain_limits(groups, [r[rate] for r in good])
        for r in found:
            least, most = limits[r["lang"], r["source"]]
            if r[rate] > most or -1 in sides and r[rate] < least:
                bad[r["doc_id"]].add(rate)
    assert {r["doc_id"]: set(r["failed_rates"]) for r in found} == bad
    assert all(r["kept"] == (not r["base_failed"] and not bad[r["doc_id"]]) for r in found)
    assert {rate for rates in bad.values() for rate in rates} >= {"symbols_per_word", "chars_per_word", "capital_share", "dup_line_share"}


def test_limits_move_with_the_spread_of_their_group(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", F.concat("source", F.lit("")).alias("source"))
    measured = quality_rules.measured(rows, "lang", "source").withColumns(quality_rules.rates()).withColumn(
        "base_failed", quality_rules.base_failed()
    )
    from tidewatch.llm.common import stored

    kept = stored(measured.filter("not base_failed"), "test-quality")
    wider = kept.withColumn("chars_per_word", 5 + (F.col("chars_per_word") - 5) * 3)
    limits = []
    for table in (kept, wider):
        found = quality_rules.thresholds(stored(quality_rules.sketches(table, ["lang"]), "test-sketches"), ["lang"])
        limits.append({r["_group_lang"]: r["_most_chars_per_word"] for r in found.collect()})
    moved = [g for g in limits[0] if limits[1][g] - 5 > 2 * (limits[0][g] - 5) > 0]
    assert len(limits[0]) >= 4 and len(moved) >= len(limits[0]) / 2 and len(set(limits[0].values())) == len(limits[0])


# URLs


def test_listed_rules_and_parts(spark):
    cases = {
        "http://A.Example.COM/en/x": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://m.www.example.com/en/?q": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://xexample.com/en/": ("xexample.com", "/en/", "com/", "allow"),
        "http://a.net/es/1#x": ("a.net", "/es/1", "net/es/", "block"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "http://a.net?x/fr/": ("a.net", "", None, "allow"),
        "no scheme.com/": ("", "", None, "allow"),
        "x://y://z.net/es/": ("y:", "//z.net/es/", None, "allow"),
        "://É.net/fr/é?": ("É.net", "/fr/é", "net/fr/", "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(pages, labels).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())
    assert url_rules.judge(pages.limit(0), labels).collect() == []


def test_mined_rules_equal_a_plain_count(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        parts = rng.sample(["pills", "news", "cheap", "blog", "shop"], 2)
        bad = {"pills", "cheap"} <= set(parts) or rng.random() < 0.1
        rows.append((i, f"https://{parts[0]}.{parts[1]}.test/{i}", "extra"))
        labels.append((i, 0 if bad else 1, None))
    rows += [(None, "https://cheap.pills.test/9", "x"), (5000, "https://x.test/pills/cheap", "x"), (5001, "http://news.test/", "x")]
    labels += [(None, 0, 1), (3, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = {tuple(r["tokens"]): (r["n_bad"], r["n_pages"]) for r in url_rules.mine(pages, marks).collect()}
    from itertools import combinations

    bad, every = Counter(), Counter()
    for (_, url, _), (_, quality, _) in zip(rows[:600], labels):
        tokens = sorted({"https", "test", *url.split("//")[1].split("/")[0].split(".")})
        for n in (1, 2, 3):
            for c in combinations(tokens, n):
                every[c] += 1
                bad[c] += quality == 0
    least = max(20, math.ceil(0.002 * 600))
    assert rules == {c: (n, every[c]) for c, n in bad.items() if n >= least and n / every[c] >= 0.6}
    found = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, marks).collect()}
    assert found[None] == found[5000] == "block" and found[5001] == "allow"


def test_four_tokens_that_are_bad_only_together(spark):
    four, rows, labels = ["cheap", "fast", "pills", "shop"], [], []
    for i in range(300):
        bad = i < 60
        parts = four if bad else [t for t in four if t != four[i % 4]]
        rows.append((i, "x://" + ".".join(parts) + f"/{i}"))
        labels.append((i, 0 if bad else 1, None))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = {tuple(r["tokens"]) for r in url_rules.mine(pages, marks).collect()}
    assert tuple(four) in rules and all(set(four) <= set(r) for r in rules)
    found = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, marks).collect()}
    assert all((v == "block") == (i < 60) for i, v in found.items())


# toxicity


@pytest.fixture(scope="module")
def toxic_rows():
    rng, rows, labels = random.Random(5), [], []
    for i in range(700):
        toxic = i % 7 == 0
        words = prose(i, 60).split()
        if toxic:
            for w in rng.sample(["vile", "rotten", "nasty"], 2):
                words.insert(rng.randrange(60), w.upper() if i % 2 else w + ",")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_texts_are_told_apart(spark, toxic_rows, odd_docs, no_docs):
    rows, labels = toxic_rows
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.score(docs, marks).collect()
    truth = {i: t for i, _, t in labels}
    assert all(r["held_out"] == held_out(r["doc_id"], 5) for r in found)
    assert all(r["predicted"] == truth[r["doc_id"]] == (r["score"] >= 0.5) for r in found)
    assert any(r["evidence"] and r["evidence"][0]["toxic"] == 1 for r in found if r["held_out"])
    flipped = [(i, q, 1 - t if held_out(i, 5) else t) for i, q, t in labels]
    again = toxicity.score(docs, spark.createDataFrame(flipped, marks.schema)).collect()
    assert sorted((r["doc_id"], r["score"]) for r in again) == sorted((r["doc_id"], r["score"]) for r in found)
    odd = toxicity.score(odd_docs, marks).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in odd)
    kept = toxicity.without_toxic(docs, marks)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {i for i, t in truth.items() if not t}
    assert toxicity.score(no_docs, marks).collect() == []
    assert {r["score"] for r in toxicity.score(docs.limit(3), marks.limit(0)).collect()} == {0.0}


def test_nearest_examples_equal_all_cosines():
    rng = np.random.default_rng(1)
    terms = [(f"t{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}", 3 + i) for i in range(100)]
    names = [t.lower() for t, _ in terms]
    draw = lambda: " ".join(rng.choice(names, rng.integers(1, 30), p=np.arange(100, 0, -1) / 5050))
    examples = [(i, draw(), int(rng.integers(2))) for i in range(900)]
    index = toxicity.ExampleIndex([(n, c) for n, (_, c) in zip(names, terms)], 1000, examples, (1.0, 1.0), 0.1)
    place = {int(d): i for i, d in enumerate(index.doc_id)}
    dense = np.zeros((900, 100))
    for i, text, _ in examples:
        at, weight = index.vector(text)
        dense[place[i], at] = weight
    for _ in range(60):
        at, weight = index.vector(draw())
        found, scores = index.nearest(at, weight)
        every = dense[:, at] @ weight
        assert np.allclose(scores, np.sort(every)[::-1][: len(scores)]) and np.allclose(every[found], scores)


def test_examples_that_are_alike_share_blocks():
    """A text of one language opens few blocks besides those of that language, whatever the examples' main terms are."""
    rng = np.random.default_rng(2)
    letters = ["".join(w) for w in zip(*[iter("abcdefghijklmnopqrstuvwx" * 10)] * 2)][:12]
    common = [[f"{x}{y}{language}" for x in letters for y in letters][:60] for language in "pqrs"]
    examples = []
    for i in range(8 * toxicity.BLOCK):
        own = f"{letters[i % 12]}{letters[i // 12 % 12]}{letters[i // 144]}z"  # the rarest term, by which nothing is sorted into languages
        examples.append((i, " ".join([own, *rng.choice(common[i % 4], 40)]), i % 2))
    counts = Counter(t for _, text, _ in examples for t in set(text.split()))
    index = toxicity.ExampleIndex(sorted(counts.items()), len(examples), examples, (1.0, 1.0), 0.5)
    languages = [set((index.doc_id[a : a + toxicity.BLOCK] % 4).tolist()) for a in range(0, len(examples), toxicity.BLOCK)]
    assert sum(map(len, languages)) <= 12  # four in each of the eight without the division
    at, _ = index.vector(" ".join(common[1]))
    opened = np.unique(np.concatenate([index.block[index.cells[t] : index.cells[t + 1]] for t in at]))
    assert len(opened) <= 4


def test_few_texts_keep_all_terms_and_clean_examples(spark):
    rows, labels = [], []
    for i in range(70):
        toxic = i % 7 == 0
        rows.append((i, prose(i, 60) + (" vile rotten" if toxic else "")))
        labels.append((i, 1, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    index = toxicity.learn(docs, marks)
    own = {i: t for i, t in rows if not held_out(i, 5)}
    assert set(index.doc_id.tolist()) == set(own)  # clean ones too
    assert set(index.number) == {w for t in own.values() for w in t.split()}
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, marks).collect()}
    assert found == {i: t for i, _, t in labels}


def test_labels_too_many_to_be_broadcast(spark, toxic_rows, odd_docs, monkeypatch):
    """They give the same texts; those without a label are left out before the others are shuffled."""
    rows, labels = toxic_rows
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels[::3] + labels[:5] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")

    def found(docs):
        return sorted(tuple(r) for r in toxicity.labelled_texts(docs, marks).collect())

    expected, odd = found(docs), found(odd_docs)
    ids = marks.select("doc_id").filter("doc_id is not null").distinct()
    likely = {r["doc_id"] for r in toxicity.with_likely_ids(docs, ids).collect()}
    assert {i for i, _ in rows} & {r["doc_id"] for r in ids.collect()} <= likely and len(likely) < 300
    monkeypatch.setattr(shuffles, "BROADCAST_ROWS", 0)
    assert found(docs) == expected and len(expected) > 150 and found(odd_docs) == odd
    monkeypatch.setattr(toxicity, "BITMAPS", 1)
    monkeypatch.setattr(toxicity, "ID_BITS", 2**40)
    assert found(docs) == expected
    frame = toxicity.labelled_texts(docs, marks)
    frame.collect()
    assert "SortMergeJoin" in frame._jdf.queryExecution().executedPlan().toString()


# decontamination


def test_edited_items_are_found_and_others_not(spark, odd_docs, no_docs):
    rng = random.Random(3)
    items = [(i, prose(f"item {i}", n)) for i, n in enumerate((6, 15, 30, 60, 40, 3))] + [(90, None), (91, ""), (2, prose("item 2", 30))]
    pool, rows, texts = prose("pool", 3000).split(), [], {}
    for doc_id in range(120):
        words = prose(f"doc {doc_id}", 50).split()
        if doc_id % 2:
            own = items[rng.randrange(5)][1].split()
            for _ in range(rng.randint(0, len(own) // 4)):
                at, kind = rng.randrange(len(own)), rng.random()
                if kind < 0.6:
                    own[at] = rng.choice(pool).upper()
                elif kind < 0.8:
                    del own[at]
                else:
                    own.insert(at, rng.choice(pool) + "!")
            at = rng.randrange(51)
            words[at:at] = own
        rows.append((doc_id, " ".join(words)))
        texts[doc_id] = plain.item_words(rows[-1][1])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["n_edits"] for r in decontamination.matches(docs, benchmark).collect()}
    expected = {}
    for item_id, text in items[:5]:
        words = plain.item_words(text)
        for doc_id, own in texts.items():
            edits = plain.best_distance(words, own)
            if edits <= 0.2 * len(words) + 1e-9:
                expected[doc_id, item_id] = edits
    assert set(found) <= set(expected) and len(found) >= 0.97 * len(expected)
    assert all(found[k] == expected[k] for k in found)
    kept = {r["doc_id"] for r in decontamination.without_benchmark(docs, benchmark).collect()}
    assert kept == set(texts) - {d for d, _ in found}
    assert decontamination.without_benchmark(odd_docs, benchmark).count() == len(odd_rows())
    assert decontamination.matches(no_docs, benchmark).collect() == []
    assert decontamination.matches(docs, benchmark.limit(0)).collect() == []


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items = [(i, prose(f"item {i}", 20)) for i in range(10)]
    docs = spark.createDataFrame([(i, prose(i, 30) + " " + t) for i, t in items], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "ITEMS_AT_ONCE", 3)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(docs, benchmark).collect()}
    assert found == {(i, i) for i in range(10)}
    assert decontamination.without_benchmark(docs, benchmark).count() == 0


def test_items_of_a_few_words_are_found_word_for_word(spark):
    items = [(1, "alpha"), (2, "Beta gamma"), (3, "one two three four"), (4, "?!"), (5, "zeta zeta")]
    docs = spark.createDataFrame([
        (1, "an ALPHA, here"), (2, "beta; gamma beta"), (3, "beta and gamma"), (4, "zero one two three four five"),
        (5, "one two three"), (6, "zeta"), (7, "so zeta zeta zeta"), (8, ""), (9, None), (10, "alpha alpha"),
    ], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["n_edits"], r["start_word"]) for r in decontamination.matches(docs, benchmark).collect()}
    assert found == {(1, 1, 0, 1), (2, 2, 0, 0), (4, 3, 0, 1), (7, 5, 0, 1), (10, 1, 0, 0)}
    assert decontamination.without_benchmark(docs, benchmark).count() == 10
    assert {r["doc_id"] for r in decontamination.without_benchmark(docs, benchmark, least_words=1).collect()} == {3, 5, 6, 8, 9}


@pytest.mark.parametrize(("place", "least"), [("front", 24), ("back", 37)])
def test_edits_at_one_end_of_long_items(spark, place, least):
    """All edits that are allowed lie together.

    A walk reads about 18 words, so that two thirds of these being edited is the
    worst case; the README gives its recall.
    """
    rng, items, rows = random.Random(21), [], []
    for i in range(40):
        words = prose(f"long {i}", 60 + 4 * i).split()
        items.append((i, " ".join(words)))
        edits = len(words) // 5
        at = rng.sample(range(edits + 6), edits) if place == "front" else rng.sample(range(len(words) - edits - 6, len(words)), edits)
        for k in at:
            words[k] = f"other{k}"
        rows.append((i, " ".join(prose(f"around {i}", 20).split() + words + ["end"])))
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(docs, benchmark).collect()}
    assert found <= {(i, i) for i in range(40)} and len(found) >= least


# language model


@pytest.mark.parametrize("sent_words", [200_000, 20])
def test_counts_and_base_scores(spark, odd_docs, no_docs, monkeypatch, sent_words):
    monkeypatch.setattr(lm_scoring, "SENT_WORDS", sent_words)
    found = lm_scoring.score(odd_docs).collect()
    tokens = [(r[0], lm_scoring.tokens_of(r[1] or "")) for r in odd_rows()]
    counts = Counter(t for i, own in tokens if not held_out(i, 10) for t in own)
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (len(own), sum(counts[t] > 0 for t in own), held_out(i, 10),
         sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)) for i, own in tokens
    )
    got = sorted((r["n_tokens"], r["n_known"], r["held_out"], r["base_score"]) for r in found)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert all(math.isclose(g[3], e[3], rel_tol=1e-9) for g, e in zip(got, expected))
    assert all(r["train_tokens"] == total and r["score"] < 0 for r in found)
    assert lm_scoring.score(no_docs).collect() == []


def test_all_learning_documents_are_dealt(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(40)], "doc_id long, text string")
    tables, kept = {}, lm_scoring.stored
    monkeypatch.setattr(lm_scoring, "stored", lambda df, name: tables.setdefault(name, kept(df, name)))
    lm_scoring.score(docs).collect()
    assert tables["lessons"].count() == sum(not held_out(i, 10) for i in range(40))


def test_the_model_covers_all_sent_words():
    head = [(f"w{i}".encode(), 5000 - i) for i in range(4000)]
    words = lm_scoring.Vocabulary(head, 100, 100 + sum(n for _, n in head), 4001, 0)
    model = GatedModel.start(words.short_counts, float(words.rest))
    assert words.n_short == model.n_short == 4001 and model.class_size == 64 and len(model.values["to_word"]) == 63
    late = words.short(words.numbers([b"w3990", b"w3991", b"w3990", lm_scoring.END]))
    assert len(set(late.tolist())) == 3 and late.max() < 4001
    before = model.score([late], 0)[0]
    for _ in range(20):
        model.learn([late] * 50, 0)
    assert model.score([late], 0)[0] > before + 1


def test_the_model_learns_order_and_sums_to_one(monkeypatch):
    rng = np.random.default_rng(0)
    texts = []
    for _ in range(400):
        start = rng.integers(1, 40)
        texts.append(np.array([(start + k) % 40 + 1 if k < 11 else 0 for k in range(12)], dtype=np.int32))
    counts = np.bincount(np.concatenate(texts), minlength=41).astype(float)
    model = GatedModel.start(counts, 1.0)
    before = model.score(texts[:50], 0).sum()
    for _ in range(30):
        model.learn(texts[50:], 0)
    after = model.score(texts[:50], 0).sum()
    assert after > 0.6 * before
    assert model.score(texts[:1], 0)[0] == pytest.approx(model.score(texts[:1], 0, lanes=1, steps=5)[0], abs=1e-3)
    many = model.score([*texts[:50], np.tile(texts[0], 30)], 0, lanes=3, steps=7)
    assert np.allclose(many[:50], model.score(texts[:50], 0), atol=1e-3)
    chances = np.exp([model.score([np.array([w], dtype=np.int32)], 0)[0] for w in range(42)])
    assert chances.sum() == pytest.approx(1, abs=1e-4)


def test_a_step_reads_and_changes_only_classes_that_were_seen():
    """What a window costs goes with its words and not with the words that were sent."""
    model = GatedModel.start(np.full(100_000, 2.0), 5.0)
    before, slopes = model.flat(), {}
    wanted = np.array([0, 5, 99_999, 100_000], dtype=np.int32)
    model.outputs(np.full((4, gated_model.UNITS), 0.5, dtype=np.float32), wanted, slopes, by_class=True)
    classes, to_word = slopes["to_word"]
    assert classes.tolist() == [0, 99_999 // model.class_size] and to_word.shape == (2, *model.values["to_word"].shape[1:])
    model.improve({"to_word": slopes["to_word"]})
    changed = np.nonzero((model.values["to_word"] != 0).any(axis=(1, 2)))[0]
    assert changed.tolist() == classes.tolist() and (model.flat() != before).any()


def test_gradients(monkeypatch):
    monkeypatch.setattr(gated_model, "UNITS", 5)
    monkeypatch.setattr(gated_model, "CLASS_SIZE", 4)
    rng = np.random.default_rng(0)
    model = GatedModel.start(np.arange(10, 0, -1.0), 5.0)
    model.values = {k: v + rng.normal(0, 0.2, v.shape) for k, v in model.values.items()}
    shown, wanted = rng.integers(0, 11, (6, 3)), rng.integers(0, 11, (6, 3)).ravel()
    fresh = np.zeros((6, 3), dtype=bool)
    fresh[0], fresh[3, 1] = True, True

    def loss():
        states = model.states(shown, fresh, np.zeros((3, 5))).astype(np.float64)
        return -model.outputs(states.reshape(-1, 5), wanted).mean()

    kept, slopes = [], {}
    states = model.states(shown, fresh, np.zeros((3, 5)), kept).astype(np.float64)
    model.outputs(states.reshape(-1, 5), wanted, slopes)
    slopes |= model.back(shown, fresh, kept, slopes.pop("states").reshape(6, 3, 5))
    rows, values = slopes.pop("enter")
    slopes["enter"] = np.zeros_like(model.values["enter"])
    slopes["enter"][rows] = values
    for name, slope in slopes.items():
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in slope.shape)
            old = model.values[name][at]
            model.values[name][at] = old + 1e-2
            up = loss()
            model.values[name][at] = old - 1e-2
            down = loss()
            model.values[name][at] = old
            assert (up - down) / 2e-2 == pytest.approx(float(slope[at]), abs=2e-4)
