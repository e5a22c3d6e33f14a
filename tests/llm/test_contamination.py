import random

import numpy as np

from mattercat.llm import contamination as c


def plain_score(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = max(0, table[i][j] + (2 if a[i] == b[j] else -1), table[i][j + 1] - 1, table[i + 1][j] - 1)
    return max(map(max, table))


def test_alignment_scores():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 20))
        score, matched, spanned, first, last = c.align(a, b)
        assert score == plain_score(a.tolist(), b.tolist())
        if score:
            assert plain_score(a.tolist(), b[first:last].tolist()) == score and matched <= min(spanned, last - first)


def test_copies_edits_and_clean_documents(spark):
    rng = random.Random(1)
    vocabulary = [f"word{i}" for i in range(3000)]
    draw = lambda n: rng.choices(vocabulary, k=n)
    items = [draw(30) for _ in range(20)] + [draw(2)]
    docs, want = [], set()
    for i in range(120):
        text = draw(rng.randrange(5, 300))
        if i % 3 == 0:
            k = rng.randrange(20)
            leak = list(items[k])
            if i % 2:
                leak[7], leak[20] = "edited", "changed"
                leak.insert(12, "inserted")
                del leak[25]
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," for w in leak]
            want.add((i, k))
        docs.append((i, " ".join(text), "k"))
    docs.append((500, " ".join(draw(5) + items[20] + draw(5)), "k"))
    want.add((500, 20))
    tests = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id bigint, text string")
    rows = c.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string, words string"), tests).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    by = {d: t.split() for d, t, _ in docs}
    for r in rows:
        passage = [w.strip(",").lower() for w in by[r.doc_id][r.first_word:r.last_word]]
        assert passage[0] in items[r.item_id] and passage[-1] in items[r.item_id] and r.similarity > 0.7


def test_nulls_repeats_ties_long_texts_and_empty_tables(spark):
    item = " ".join(f"t{i}" for i in range(20))
    tests = spark.createDataFrame([(1, item), (2, item), (None, item), (3, None), (4, ""), (5, "... !")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, item), (1, item), (2, "pad " * 60_000 + item), (None, item), (3, None), (4, ""), (5, (item + " ") * 50)], "doc_id bigint, text string")
    rows = c.contaminated(docs, tests).collect()
    assert sorted((r.doc_id, r.item_id, r.similarity) for r in rows) == [(d, i, 1.0) for d in (1, 2, 5) for i in (1, 2)]
    assert {r.first_word for r in rows if r.doc_id == 5} == {0}
    for d, t in ((docs.limit(0), tests), (docs, tests.limit(0))):
        assert c.contaminated(d, t).collect() == []
