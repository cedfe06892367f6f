import random
from collections import defaultdict

import numpy as np

import plain
from samples import odd_rows, prose
from tidewatch.llm import near_duplicates
from tidewatch.llm.components import components


def changed(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_classes_equal_a_plain_join(spark):
    base = prose(1, 300)
    texts = [base, base, "", None, "one two", "one two", "one three"]
    texts += [changed(base, n, n) for n in range(1, 9)]
    texts += [changed(changed(base, 6, 50), n, 90 + n) for n in range(5)]
    texts += [prose(100 + i, 120) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class string")
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicate_classes(docs).collect()}
    members = defaultdict(list)
    for i, c in enumerate(plain.near_classes(texts)):
        members[c].append(i)
    assert found == {i: min(own) for own in members.values() for i in own}


def test_a_group_in_which_no_leader_is_near_all(spark):
    """Copies of copies: near ones are linked in chains, most pairs are below the bound."""
    texts, text = [], prose(7, 200)
    for i in range(40):
        text = changed(text, 3, 1000 + i)
        texts.append(text)
    texts += [changed(prose(8, 200), 9, i) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicate_classes(docs).collect()}
    members = defaultdict(list)
    for i, c in enumerate(plain.near_classes(texts)):
        members[c].append(i)
    assert found == {i: min(own) for own in members.values() for i in own}
    counted = near_duplicates.near_duplicate_classes(docs, counted=True)
    assert {r["doc_id"]: r["class_id"] for r in counted.collect()} == found


def test_odd_documents_keep_one_of_each_class(odd_docs, no_docs):
    found = near_duplicates.near_duplicate_classes(odd_docs).collect()
    assert len(found) == len(odd_rows())
    kept = near_duplicates.deduplicate(odd_docs)
    assert kept.schema == odd_docs.schema
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    expected = sorted((i is None, i or 0) for i in [1, 2, 3, 3, 4, 5, 6, None, None, 8, 9, 12, 13, 14, -5, 2**40 + 7])
    assert ids == expected
    assert near_duplicates.deduplicate(no_docs).collect() == []


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    elements = rng.integers(1, 2**63, 1000).astype(np.uint64)
    both = np.concatenate([elements[:900], elements[100:]])
    owner = np.repeat([0, 1], 900)
    even = near_duplicates.dart_signatures(both, np.ones(1800), owner, 2, 4000)
    assert abs((even[0] == even[1]).mean() - 0.8) < 0.03
    weights = np.concatenate([np.full(900, 1.7), np.full(900, 0.6)])
    uneven = near_duplicates.dart_signatures(both, weights, owner, 2, 4000)
    assert abs((uneven[0] == uneven[1]).mean() - 0.6 * 800 / (1.7 * 900 + 0.6 * 900 - 0.6 * 800)) < 0.03
    assert near_duplicates.dart_signatures(np.array([5], dtype=np.uint64), np.ones(1), np.array([0]), 1, 110).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and all(found[i] == 100 for i in range(101, 130))
    assert components(edges.filter("a < 0")).collect() == []
