import random
import re
from collections import Counter

import numpy as np
import pytest

from mattercat.llm import suffixes
from mattercat.llm.queries import QUERIES

op7_suffix_repeats = QUERIES["op7_suffix_repeats"]


def brute(texts, depth):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + depth] for b in data for i in range(len(b) - depth + 1))
    found = []
    for b in data:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - depth + 1):
            if seen[b[i:i + depth]] > 1:
                covered[i:i + depth] = True
        found.append((len(b), int(covered.sum()), int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum()),
                      np.frombuffer(b, "u1")[~covered].tobytes()))
    return found


@pytest.mark.parametrize("group", [8192, 2])
def test_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rng = random.Random(group)
    text = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    shared = [text(90), text(70), text(40)]
    texts = [None, "", "a", "a" * 300, "ab" * 120, text(39)]
    for _ in range(25):
        texts.append(text(rng.randrange(60)) + rng.choice(shared)[rng.randrange(20):] + text(rng.randrange(60)) + rng.choice(shared))
    texts += [texts[-1], texts[-1], shared[0][:41], text(5000)]
    rows = spark.createDataFrame([(i, t, b"k") for i, t in enumerate(texts)], "doc_id bigint, text string, key binary")
    got = {r.doc_id: r for r in suffixes.remove_repeats(rows, depth=40, gram=12).collect()}
    for i, (size, removed, spans, kept) in enumerate(brute(texts, 40)):
        r = got[i]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), bytes(r.kept)) == (size, removed, spans, kept)
        assert sum(s["last"] - s["first"] for s in r.removed) == removed


@pytest.mark.parametrize("group", [8192, 2])
def test_words_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rng = random.Random(group)
    some = lambda n: [rng.choice(["a", "be", "c,", "(d", "\u00e9t\u00e9", "--", "\u3001x"]) for _ in range(n)]
    shared = [some(14), some(9), some(30)]
    texts = [None, "", " ", "a", "a " * 60, "-- " * 20]
    for _ in range(25):
        texts.append(" ".join(some(rng.randrange(9)) + rng.choice(shared)[rng.randrange(8):] + some(rng.randrange(9)) + rng.choice(shared)))
    texts += [texts[-1], "  ".join(some(500))]

    def places(b):
        found = []
        for m in re.finditer(rb"[^ \t\n\r\v\f]+", b):
            core = re.search(rb"[0-9A-Za-z\x80-\xff](.*[0-9A-Za-z\x80-\xff])?", m[0], re.S)
            found.append((m.start() + core.start(), m.start() + core.end()) if core else m.span())
        return [(x[0], y[1]) for x, y in zip(found, found[7:])]

    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:j] for b in data for i, j in places(b))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(rows, depth=5000, words=8).collect()}
    for k, b in enumerate(data):
        covered = np.zeros(len(b), bool)
        for i, j in places(b):
            covered[i:j] |= seen[b[i:j]] > 1
        assert got[k] == np.frombuffer(b, "u1")[~covered].tobytes()


def test_short_repeated_passages_are_told_and_only_long_strings_go(spark, tmp_path):
    """Passages of 51 to 70 short words in two documents each; below 400 bytes they stay, and each is named."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    some = lambda n: " ".join(word() for _ in range(n))
    shared = [some(n) for n in range(51, 71)]
    planted = [f"{some(80)} {p} {some(80)}" for p in shared for _ in range(2)]
    clean = [some(240) for _ in range(40)] + [f"{some(80)} {p} {some(80)}" for p in [some(50)] * 2]
    rows = [(i, t) for i, t in enumerate([None, "", *planted, *clean])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op7_suffix_repeats(spark, str(tmp_path)).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in (got[i] for i, _ in rows)] == [x[:3] for x in brute([t for _, t in rows], 400)]
    first = 2 + len(planted)
    assert [got[i].n_passages for i, _ in rows] == [0, 0] + [1] * len(planted) + [0] * len(clean)
    assert [got[i].passage_bytes for i in range(2, first)] == [len(p) for p in shared for _ in range(2)]
    assert any(got[i].n_removed == 0 for i in range(2, first)) and any(got[i].n_removed for i in range(2, first))


def test_null_ids_repeated_rows_carried_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "x" * 30, 1), (None, "x" * 30, 2), (7, "short", 3)], "doc_id bigint, text string, extra int")
    got = sorted((r.carry, len(r.kept)) for r in suffixes.remove_repeats(rows, depth=20, gram=5, carry="extra").collect())
    assert got == [(1, 0), (2, 0), (3, 5)]
    assert suffixes.remove_repeats(rows.limit(0)).collect() == []


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 50, 97).astype("u8")
    for width in (1, 2, 10, 97):
        assert suffixes.sliding_minimum(x, width).tolist() == [x[i:i + width].min() for i in range(98 - width)]
