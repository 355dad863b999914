import numpy as np

import corpus_pipeline as p
from spanloom.llm.common import materialize

from .test_text_ops import brute_classes, brute_copies


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in p.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        seen[name] = (before, {r.doc_id for r in docs.select("doc_id").collect()})
    before, after = seen["exact_dedup"]
    assert after == {i for i, v in brute_copies(before).items() if v[2]}
    before, after = seen["ngram_jaccard"]
    assert after == {i for i, v in brute_classes(before, 5, 80).items() if v[1] == i}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = p.q05_toxicity.fit_outside_fold(whole, labels)
    before, after = seen["toxicity"]
    assert after == {i for i, t in before if model.scores([t])[0] < p.q05_toxicity.THRESHOLD}
    left = spark.createDataFrame([(i, t) for i, t in before if i in after], "doc_id long, text string")
    ensemble = p.q04_quality.fit_outside_fold(left, labels)
    before, after = seen["quality"]
    assert after == {i for i, t in before if ensemble.predict(np.array([p.rules.statistics(t)]))[0] >= p.q04_quality.THRESHOLD}
    for name in ("toxicity", "quality"):
        before, after = seen[name]
        assert 0.5 * len(before) < len(after) <= len(before)
    packed = p.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == seen["ngram_jaccard"][1]
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048


def test_pipeline_on_odd_rows(spark, sf_dir, make_docs):
    docs = make_docs([None, "", " ", "x " * 3000, (7, "one two three"), (7, "one two three"), (8, "one  two three"), (None, "q")], ("score", "a.b"))
    for _, stage in p.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "odd")
    assert docs.count() > 0
    empty = make_docs([])
    for _, stage in p.STAGES:
        empty = materialize(stage(spark, empty, sf_dir), "empty")
    assert empty.count() == 0


def test_other_text_of_a_repeated_doc_id_stays(spark, sf_dir, make_docs):
    copied, alone = "one two three four", "a text of its own"
    docs = make_docs([(3, copied), (7, copied), (7, alone), (9, alone + " still")])
    left = {(r.doc_id, r.text) for r in p.drop_copies(spark, docs, sf_dir).collect()}
    assert left == {(3, copied), (7, alone), (9, alone + " still")}
    words = [f"word{i}" for i in range(60)]
    near, first = " ".join(words), " ".join([*words[:-1], "other"])
    docs = make_docs([(3, first), (7, near), (7, alone), (9, "q"), (None, near)])
    left = {(r.doc_id, r.text) for r in p.drop_near_copies(spark, docs, sf_dir).collect()}
    assert left == {(3, first), (7, alone), (9, "q"), (None, near)}
