import math
import random
from collections import defaultdict

import numpy as np
import pytest

from mattercat.llm import langid

LANGS = {"aa": "the and of to in that is was he for it with as", "bb": "der die und in den von zu das mit sich des",
         "cc": "le la les de des et en un une du que est pour"}


def sample(rng, lang, n):
    return " ".join(rng.choices(LANGS[lang].split(), k=n))


class Plain:
    """The coder stated plainly, over dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, defaultdict(lambda: defaultdict(int))
        for text in texts:
            data = b"\n" * order + text.encode()
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.counts[data[i - k:i]][data[i]] += 1

    def bits(self, text):
        data, total = b"\n" * self.order + text.encode(), 0.0
        for i in range(self.order, len(data)):
            for k in range(self.order, -1, -1):
                seen = self.counts.get(data[i - k:i])
                if seen is None:
                    continue
                n, d = sum(seen.values()), len(seen)
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / (n + d))
                    break
                total -= math.log2(d / (n + d))
            else:
                total += 8
        return total


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(1)
    rows = [(lang, sample(rng, lang, rng.randrange(5, 60))) for lang in LANGS for _ in range(20)]
    rows += [("aa", None), (None, "unlabelled"), ("bb", "")]
    return rows, langid.train(spark.createDataFrame(rows, "lang string, text string"), order=3)


def test_code_lengths_are_exact(trained):
    rows, model = trained
    rng = random.Random(2)
    texts = [sample(rng, "aa", 30), "xyz Ünï", "a", "the dér\n\n zz", sample(rng, "cc", 300), "\n\nder"]
    got = model.lengths([t.encode() for t in texts])
    assert model.langs == sorted(LANGS)
    for k, lang in enumerate(model.langs):
        plain = Plain([t for x, t in rows if x == lang and t is not None], 3)
        assert np.allclose(got[:, k], [plain.bits(t) for t in texts], rtol=1e-4)


def test_held_out_accuracy(spark, trained):
    rng = random.Random(3)
    rows = [(i, sample(rng, lang, 12), lang) for i, lang in enumerate(list(LANGS) * 20)]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id int, text string, lang_pred string"), trained[1]).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 58
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_cases(spark, trained):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "123 ... \n"), (3, "der und " * 40_000), (4, "é")], "doc_id bigint, text string")
    rows = langid.identify(docs, trained[1]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred, r.score) for r in rows if r.doc_id not in (3, 4)) == [(0, "und", 0.0), (1, "und", 0.0), (1, "und", 0.0), (2, "und", 0.0)]
    assert {r.lang_pred for r in rows if r.doc_id == 3} == {"bb"} and {r.lang_pred for r in rows if r.doc_id == 4} <= set(LANGS)
    assert langid.identify(docs.limit(0), trained[1]).collect() == []
    none = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


def test_bounded_model_keeps_a_tree(spark, trained):
    rows, whole = trained
    small = langid.train(spark.createDataFrame(rows, "lang string, text string"), order=3, most=60)
    assert len(small.key) < len(whole.key)
    assert small.lengths([b"the and of"])[0].argmin() == 0
