import numpy as np
import pytest

from mattercat.llm import covertree


def brute(vectors, cosine):
    """Links and components by comparing all pairs of sound vectors."""
    sound = [v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v, "f8") / np.linalg.norm(np.array(v, "f8") / np.abs(v).max()) / np.abs(v).max() if s else None for v, s in zip(vectors, sound)]
    n = len(vectors)
    linked = [[j for j in range(n) if j != i and sound[i] and sound[j] and float(unit[i] @ unit[j]) >= cosine] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        for i in range(n):
            root[i] = min([root[i], *[root[j] for j in linked[i]]])
    return [(len(linked[i]), root[i], root[i] == i) for i in range(n)]


@pytest.mark.parametrize("chunk, sample", [(8192, 4096), (16, 12)])
def test_against_brute_force(spark, monkeypatch, chunk, sample):
    monkeypatch.setattr(covertree, "CHUNK", chunk)
    monkeypatch.setattr(covertree, "SAMPLE", sample)
    rng = np.random.default_rng(chunk)
    vectors = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [1.0] * 3]
    base = rng.normal(size=(40, 8))
    vectors += base.tolist() + (base[:10] * 3).tolist() + base[:5].tolist() * 3 + (-base[:5]).tolist()
    for scale in (0.05, 0.1, 0.2):
        vectors += (base[:15] / np.linalg.norm(base[:15], axis=1)[:, None] + rng.normal(size=(15, 8)) * scale).tolist()
    vectors += [[1e200] * 8, [1e-200] * 8, [1.0] * 8]
    rows = spark.createDataFrame([(i, v, "k") for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, leaf string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_vectors(rows, cosine=0.95).collect()}
    assert got == dict(enumerate(brute(vectors, 0.95)))


def test_null_ids_repeated_rows_and_empty_tables(spark):
    v = [1.0, 2.0]
    rows = spark.createDataFrame([(None, v), (4, v), (4, v), (9, [2.0, 4.0])], "vec_id bigint, embedding array<float>")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in covertree.near_vectors(rows).collect())
    assert got == [(0, 0, 0, False), (4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False)]
    assert covertree.near_vectors(rows.limit(0)).collect() == []


def test_nets_are_nested_and_cover():
    x = np.random.default_rng(1).normal(size=(200, 3))
    x /= np.linalg.norm(x, axis=1)[:, None]
    chain = covertree.levels(x)
    for level, radius in enumerate(covertree.RADII):
        assert (covertree.distances((x * x[chain[level]]).sum(axis=1)) <= radius + 1e-9).all()
        nodes = np.unique(chain[level])
        assert (chain[level:, nodes] == nodes).all()


def test_query_against_its_sql(spark):
    from mattercat.llm.queries import ORACLES, QUERIES
    from tests.oracle import differences, duck

    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES["op10_cover_tree"](spark, folder), duck(folder), ORACLES["op10_cover_tree"]) == []


def test_vectors_at_right_angles_are_dropped_before_they_are_opened(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 64))
    near = [x[:40] * 3] + [x[:40] + rng.normal(size=(40, 64)) * s for s in (0.1, 0.2, 0.3)] + [x[:500] + rng.normal(size=(500, 64)) * 0.8]
    x = np.concatenate([x, *near, np.repeat(x[:1], 30, axis=0) + rng.normal(size=(30, 64)) * 0.05])
    x /= np.linalg.norm(x, axis=1)[:, None]
    opened, real = [], covertree.crossed

    def counted(a0, a1, b0, b1):
        opened.append(((a1 - a0) * (b1 - b0)).sum())
        return real(a0, a1, b0, b1)

    monkeypatch.setattr(covertree, "crossed", counted)
    one, two = (covertree.Tree(part, covertree.levels(part)) for part in (x, x[::2]))
    blocks = list(covertree.dual(one, two, 0.95))
    found = sorted((int(one.order[i]), int(two.order[j])) for a, b in blocks for i, j in zip(a, b))
    assert found == [(int(i), int(j)) for i, j in zip(*np.nonzero(np.einsum("id,jd->ij", x, x[::2]) >= 0.95))]
    assert sum(opened) < 10 * len(x)


def test_pairs_of_chunks_are_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(covertree, "CHUNK", 16)
    rng = np.random.default_rng(4)
    raw = [(i, 1, v.tobytes()) for i, v in enumerate(rng.normal(size=(200, 8)))]
    leaves = spark.createDataFrame(raw, "leaf bigint, copies bigint, x binary")
    # 16 vectors a chunk are at least 13 chunks and so 91 pairs.
    assert covertree.search(leaves, -1.0).rdd.getNumPartitions() >= 91
