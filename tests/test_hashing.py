"""Hashes against numpy bytes put together value by value."""

import random
from hashlib import sha512

import numpy as np

from mattercat.functions import hashing as H
from mattercat.functions.hashing import content_hash, structure_hash


def raw(value):
    return value.encode() if isinstance(value, str) else np.array(value).data.tobytes()


def decimal(pieces):
    digest = sha512()
    for piece in pieces:
        digest.update(piece)
    return str(int(digest.hexdigest(), 16))


def expected(row, names):
    return decimal(raw(row[n]) for n in sorted(names) if row[n] is not None and row[n] != "[]")


SCHEMA = (
    "id int, text string, number double, whole int, flag boolean, ints array<int>, "
    "matrix array<array<double>>, flags array<boolean>, words array<string>"
)
ROWS = [
    (1, "abc", 1.5, 7, True, [1, 2, 3], [[0.1, 0.2, 0.3], [1.0, 2.0, 3.0]], [True, False, True], ["H", "He"]),
    (2, None, None, None, None, None, None, None, None),
    (3, "[]", -0.0, 0, False, [], [], [], ["é"]),
    (4, "é中", float("nan"), -5, True, [9], [[1.0], [2.0]], [False], []),
    (5, "", 1e-300, 2**31 - 1, None, [1], [[float("inf"), 0.0, -1.0]], None, ["a", "bb", "ccc"]),
]


def test_content_hash_matches_numpy(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(1)
    names = [c for c in df.columns if c != "id"]
    rows = content_hash(df, names).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        assert row["hash"] == expected(row, names), row["id"]


def test_bytes_of_slices_and_large_types():
    import pyarrow as pa

    values = [[[1.0, 2.0], [3.0]], None, [], [[4.0]], [[5.0], [6.0, 7.0]]]
    for kind in (pa.list_(pa.list_(pa.float64())), pa.large_list(pa.large_list(pa.float64()))):
        whole = pa.array(values, kind)
        for start in range(len(values)):
            found = H.hash_bytes(whole.slice(start, 3))
            flat = [None if v is None else np.array([x for r in v for x in r]).tobytes() for v in values]
            assert found == flat[start:start + 3]


def test_content_hash_does_not_depend_on_batches(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice([None, f"t{i}"]), rng.choice([None, rng.random()]), i, None, [i] * (i % 4),
         [[rng.random()] * 3] * (i % 5) or None, [bool(i % 2)], None)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    names = [c for c in df.columns if c != "id"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        small = {r["id"]: r["hash"] for r in content_hash(df.repartition(3), names).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for row in content_hash(df, names).collect():
        assert row["hash"] == small[row["id"]] == expected(row, names)


STRUCTURE = "id int, atomic_numbers array<int>, cell array<array<double>>, pbc array<boolean>, positions array<array<double>>"


def structure(rng, i, n):
    # Few distinct coordinates, so that sorting has ties on x and on y.
    return (
        i, [rng.randint(1, 90) for _ in range(n)],
        [[rng.random() * 9 for _ in range(3)] for _ in range(3)], [True, False, True],
        [[rng.choice([-0.0, 0.0, 1.25]), rng.choice([0.5, -3.0]), rng.random() * 30] for _ in range(n)],
    )


def structure_bytes(row):
    positions, numbers = np.array(row["positions"]), np.array(row["atomic_numbers"])
    order = np.lexsort((positions[:, 2], positions[:, 1], positions[:, 0]))
    return decimal([
        numbers[order].astype(np.int64).tobytes(), raw(row["cell"]), raw(row["pbc"]),
        np.round(positions[order], 16).tobytes(),
    ])


def test_structure_hash_matches_numpy_and_ignores_atom_order(spark):
    rng = random.Random(1)
    rows = [structure(rng, i, rng.randint(1, 12)) for i in range(60)]
    df = spark.createDataFrame(rows, STRUCTURE)
    found = structure_hash(df).collect()
    for row in found:
        assert row["structure_hash"] == structure_bytes(row)
    mixed = []
    for i, numbers, cell, pbc, positions in rows:
        order = list(range(len(numbers)))
        rng.shuffle(order)
        mixed.append((i, [numbers[k] for k in order], cell, pbc, [positions[k] for k in order]))
    again = {r["id"]: r["structure_hash"] for r in structure_hash(spark.createDataFrame(mixed, STRUCTURE)).collect()}
    assert {r["id"]: r["structure_hash"] for r in found} == again


def test_structure_hash_is_null_without_positions(spark):
    df = spark.createDataFrame([(1, [1], [[1.0]], [True], None)], STRUCTURE)
    assert structure_hash(df).first()["structure_hash"] is None


def test_id_from_hash(one):
    text = one(H.id_from_hash("h", "CO"), h="1234567890" * 15)
    assert text == "CO_1234567890123456789012345" and len(text) == 28


def test_neutral_mode_skips_nulls(spark):
    from hashlib import sha256

    df = spark.createDataFrame([("b", None, 3, "[]")], "b string, a string, c int, d string")
    found = content_hash(df, ["b", "a", "c", "d"], mode="neutral").first()["hash"]
    assert found == sha256(b"b|3").hexdigest()
