import numpy as np
import pytest
import xxhash

from mattercat.llm import common, simhash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_trie_finds_all_pairs_and_no_others():
    rng = np.random.default_rng(1)
    for bits, n, budget in ((64, 300, 2), (16, 200, 3), (8, 150, 1)):
        base = rng.integers(0, 1 << min(bits, 63), n, dtype="u8")
        near = base ^ (np.uint64(1) << rng.integers(0, bits, n).astype("u8"))
        values = np.sort(np.concatenate([base, near, base[:20]]))
        want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
                if int(values[i] ^ values[j]).bit_count() <= budget}
        found = [(i, j) for a, b in simhash.trie_pairs(values, values, bits, 0, 0, budget, True) for i, j in zip(a.tolist(), b.tolist())]
        assert len(found) == len(set(found)) and set(found) == want
        left, right = values[: n // 2], values[n // 2:]
        cross = {(i, j) for i in range(len(left)) for j in range(len(right)) if int(left[i] ^ right[j]).bit_count() <= budget}
        found = [(i, j) for a, b in simhash.trie_pairs(left, right, bits, 0, 0, budget, False) for i, j in zip(a.tolist(), b.tolist())]
        assert len(found) == len(set(found)) and set(found) == cross


@pytest.mark.parametrize("leaves", [1 << 16, 4])
def test_components_against_brute_force(spark, monkeypatch, leaves):
    monkeypatch.setattr(simhash, "LEAVES", leaves)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", "  \t\n", "one", "Two words", "two WORDS"]
    for _ in range(25):
        t = list(rng.choice(words, 150))
        texts.append(" ".join(t))
        t[int(rng.integers(0, 150))] = "other"
        texts += [" ".join(t), " ".join(t).upper()]
    texts.append("long " * 50_000)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, lane_0 string")
    prints = {i: fingerprint(t) if i < len(texts) - 1 else None for i, t in enumerate(texts)}
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints[len(texts) - 1] = int(rows[len(texts) - 1].fingerprint, 16)
    assert all(int(rows[i].fingerprint, 16) == prints[i] for i in prints)
    want = groups(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert {i: r.component_id for i, r in rows.items()} == want


def test_null_ids_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (3, "a b c d")], "doc_id bigint, text string")
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (3, 3), (5, 3), (5, 3)]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(200, 200), (61, 62), (62, 61)]
    rows = {r.node: r.component for r in common.components(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    assert rows == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}, 61: 61, 62: 61}
    assert common.components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []
