"""Digests of tables: what differs is found and named, what is equal is not read twice."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mattercat.operators import digests as D
from mattercat.plans import publish
from mattercat.sinks import tables as W

TREE = (0, 2, 4)


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, n int, tags map<string,int>")


def some(n=2000, seed=1):
    rng = random.Random(seed)
    made = [(f"P{rng.randint(0, 9999):04d}", rng.randint(0, 5), {"a": rng.randint(0, 2)}) for _ in range(n)]
    return made + [(None, 1, None), ("", 2, None), (None, None, {}), ("é1", 1, None)]


def by_hand(a, b):
    left, right = (Counter((i, n, str(t)) for i, n, t in rows) for rows in (a, b))
    ids = {r[0] for r in (left - right)} | {r[0] for r in (right - left)}
    count = lambda rows, i: sum(r[0] == i for r in rows)
    return sorted(((i, count(a, i), count(b, i)) for i in ids), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("most", [D.NAMED, 1])
def test_changed_ids_against_a_multiset_difference(spark, monkeypatch, most):
    monkeypatch.setattr(D, "NAMED", most)
    old = some()
    new = list(old)
    new[5] = (new[5][0], 99, new[5][2])      # changed
    del new[77]                              # gone
    new += [new[3], new[3], ("Q1", 1, None)]  # a copy too many, and a new id
    new.append((None, 4, None))
    a, b = table(spark, old), table(spark, new).repartition(5)
    assert found(D.changed_ids(a, b, lengths=TREE)) == by_hand(old, new)
    assert found(D.changed_ids(a, b.select("tags", "n", "id"), lengths=TREE, content=["id", "n"])) == by_hand(
        [(i, n, "") for i, n, _ in old], [(i, n, "") for i, n, _ in new])


def test_pairs_that_swap_values_and_equal_pairs_are_seen(spark):
    # A sum of values or an exclusive or of hashes would not change.
    old, new = [("a1", 1, None), ("a2", 2, None)], [("a1", 2, None), ("a2", 1, None)]
    assert found(D.changed_ids(table(spark, old), table(spark, new), lengths=TREE)) == [("a1", 1, 1), ("a2", 1, 1)]
    old, new = [("a1", 1, None)] * 2, [("a1", 2, None)] * 2
    assert found(D.changed_ids(table(spark, old), table(spark, new), lengths=TREE)) == [("a1", 2, 2)]


def test_tree_levels_add_up_and_descent_stays_below_what_differs(spark):
    old = table(spark, some())
    tree = D.digest_tree(old, lengths=TREE).collect()
    for level in range(3):
        assert sum(r["n"] for r in tree if r["level"] == level) == 2004
        assert {sum(r[c] for r in tree if r["level"] == level) for c in ("high",)} == {next(r["high"] for r in tree if r["level"] == 0)}
    assert tuple(next(r for r in tree if r["level"] == 0))[2:] == D.table_digest(old)
    new = old.withColumn("n", F.when(F.col("id") == "P0001", -1).otherwise(F.col("n"))).union(table(spark, [("P0001", 7, None)]))
    trees = [D.digest_tree(t, lengths=TREE) for t in (old, new)]
    assert [r["prefix"] for r in D.differing_prefixes(*trees, TREE).collect()] == ["P000"]
    assert D.differing_prefixes(trees[0], trees[0], TREE).collect() == []
    empty = D.digest_tree(old.limit(0), lengths=TREE)
    assert D.differing_prefixes(empty, empty, TREE).collect() == []
    assert found(D.changed_ids(old.limit(0), old.limit(0), lengths=TREE)) == []
    with pytest.raises(ValueError):
        D.digest_tree(old, lengths=(4, 2))


def test_stored_hashes_are_all_that_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("concat('a', id) AS id", "md5(string(id)) AS hash", "id AS wide").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.agg(*D._sums(D.content_hash_of(df, ["id", "hash"])))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,hash:string>" in plan


def test_observed_digest_is_that_of_a_scan(spark, tmp_path):
    df = table(spark, some())
    rows, observation = D.observed_digest(df)
    rows.write.parquet(str(tmp_path / "t"))
    assert tuple(observation.get.values()) == D.table_digest(spark.read.parquet(str(tmp_path / "t")))


def test_a_release_with_two_changed_rows_is_blocked_and_names_them(spark, monkeypatch, tmp_path):
    spark.sql(f"CREATE SCHEMA blocked LOCATION '{tmp_path}/s'")
    current = spark.catalog.currentDatabase()
    try:
        spark.catalog.setCurrentDatabase("blocked")
        W.save_table(spark.range(500).selectExpr("concat('PO_', 1000 + id) AS id", "id AS n", "'d' AS dataset_id"), "src_po")
        keep = publish.save_table

        def broken(df, name, mode="errorifexists", path=None):
            # What a faulty writer would do: same number of rows, two of them wrong.
            keep(df, f"{name}_whole")
            rows = spark.table(f"{name}_whole")
            keep(rows.withColumn("n", F.when(F.col("n").isin(3, 441), -1).otherwise(F.col("n"))), name, mode, path)

        monkeypatch.setattr(publish, "save_table", broken)
        with pytest.raises(ValueError, match=r"PO_1003 \(1 rows, 1 in the copy\), PO_1441 \(1 rows, 1 in the copy\)"):
            publish.release(spark, {"po": "src_po"}, "20240101")
        assert not W.table_exists(spark, "blocked.po")
    finally:
        spark.catalog.setCurrentDatabase(current)
