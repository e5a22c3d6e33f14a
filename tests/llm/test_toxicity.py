import random

import numpy as np
import pytest

from mattercat.llm import toxicity


def maximal_by_definition(scores):
    """Ruzzo and Tompa's own definition: split at the best segment, leftmost and shortest first, and go on beside it."""
    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > 0 and (found is None or total > found[0]):
                    found = total, i, j + 1
        return found

    def split(lo, hi):
        found = best(lo, hi)
        return [] if found is None else split(lo, found[1]) + [found] + split(found[2], hi)

    return split(0, len(scores))


def test_maximal_segments():
    rng = random.Random(0)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 1000 for _ in range(rng.randrange(25))]
        got = toxicity.maximal_segments(np.array(scores, "f8"))
        assert [(i, j) for _, i, j in got] == [(i, j) for _, i, j in maximal_by_definition(scores)]
        assert np.allclose([s for s, _, _ in got], [sum(scores[i:j]) for _, i, j in got])


def test_tokens():
    assert toxicity.token("(Word!)") == "word" and toxicity.token("***") == "" and toxicity.token("a-b.") == "a-b"
    assert toxicity.features("Longer,") == ("longer", " long") and toxicity.features("***") == ()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    plain = [f"w{rng.randrange(400)}" for _ in range(400)]
    bad = ["vile", "Nasty", "rotten"]
    rows = []
    for i in range(600):
        words = rng.choices(plain, k=rng.randrange(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ".", "!"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_passages(spark, corpus):
    train = spark.createDataFrame([r for r in corpus if r[0] % 3], "doc_id bigint, text string, toxic int")
    held = [r for r in corpus if not r[0] % 3]
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t, _ in held], "doc_id bigint, text string, words string, evidence int")
    rows = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(train)).collect()}
    assert all((rows[i].score >= 0.5) == bool(y) for i, _, y in held)
    for i, text, toxic in held:
        if toxic:
            marked = [w for p in rows[i].passages for w in text.split()[p.first:p.last]]
            assert any(w.strip(".!").lower() in ("vile", "nasty", "rotten") for w in marked)


def test_edge_cases(spark, corpus):
    model = toxicity.train(spark.createDataFrame(corpus, "doc_id bigint, text string, toxic int"))
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "word " * 100_000), (3, "vile " * 50)], "doc_id bigint, text string")
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[None] == by[1] < 0.5 and by[3] >= 0.5
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_training_without_both_labels(spark):
    for rows in ([], [(1, "a b", 0)] * 3, [(1, "a b", None)]):
        model = toxicity.train(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
        r = toxicity.score(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), model).collect()
        assert r[0].score < 0.5


def test_labels_join(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id bigint, toxic int")
    assert [tuple(r) for r in toxicity.labelled(docs, labels).collect()] == [("a", 1)]
