import plain
from tidewatch.llm import packing
from tidewatch.llm.common import stored

import corpus_pipeline


def test_each_stage_does_its_part(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, sf_dir), name)
        seen[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = seen["toxicity"]
    kept = {r["doc_id"] for r in after}
    lost = [r["doc_id"] for r in before if r["doc_id"] not in kept and r["doc_id"] in labels]
    assert sum(labels[i] == 0 for i in lost) <= 0.1 * max(1, len(lost))
    before, after = seen["near_dedup"]
    first = {}
    for r, c in sorted(zip(before, plain.near_classes([r["text"] for r in before])), key=lambda x: x[0]["doc_id"]):
        first.setdefault(c if plain.WORD.search(r["text"] or "") else r["doc_id"], r["doc_id"])
    assert {r["doc_id"] for r in after} == set(first.values())
    before, after = seen["substring_dedup"]
    texts = {r["doc_id"]: r["text"] for r in after}
    words = [tuple(plain.WORD.findall(r["text"] or "")) for r in before]
    for r, own, marks in zip(before, words, plain.removed(words, 35)):
        assert plain.WORD.findall(texts[r["doc_id"]] or "") == [w for w, m in zip(own, marks) if not m]
        assert any(marks) or texts[r["doc_id"]] == r["text"]
    before, after = seen["decontamination"]
    items = [plain.item_words(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in after}
    for r in before:
        words = plain.item_words(r["text"] or "")
        near = any(
            len(set(words) & set(i)) >= 0.6 * len(set(i)) and plain.best_distance(i, words) <= 0.2 * len(i) + 1e-9
            for i in items
        )
        assert near == (r["doc_id"] not in kept)
    before, after = seen["packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    loads = {}
    for r in sorted(after, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == loads.get(r["sequence_id"], 0)
        loads[r["sequence_id"]] = r["offset"] + r["length"]
    assert len(loads) == plain.best_fit([r["length"] for r in after], packing.CAPACITY)
