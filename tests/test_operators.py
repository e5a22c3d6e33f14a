"""Null, empty, repeated and hot keys, against plain Python."""

import decimal
import random
import statistics
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattercat.operators import aggregates as A
from mattercat.operators import edits as E
from mattercat.operators import joins as J
from mattercat.operators import ordering as O
from mattercat.operators import skew as K
from mattercat.operators import sets as S
from mattercat.operators import states as ST
from mattercat.plans import curate
from mattercat.sources import metadata, scan


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", None)], "id string, n int")


@pytest.mark.parametrize("values", [["a"], ["a"] * (E.SHORT_LIST + 1)])
def test_filter_not_in_and_nulls(small, values):
    assert rows(E.filter_not_in(small, "id", values), "id") == [("b",), ("c",)]
    assert rows(E.filter_not_in(small, "id", values, keep_null=True), "id") == [("b",), ("c",), (None,)]


@pytest.mark.parametrize("n", [10, 2000])
def test_filter_not_in_ignores_nulls_in_lists_of_any_length(spark, small, n):
    values = ["a", None, *[f"other{i}" for i in range(n)]]
    table = spark.createDataFrame([(v,) for v in values], "v string")
    for given in (values, table):
        assert rows(E.filter_not_in(small, "id", given), "id") == [("b",), ("c",)]
        assert rows(E.filter_not_in(small, "id", given, keep_null=True), "id") == [("b",), ("c",), (None,)]


def test_limit_rows_is_exact_on_both_ways(spark):
    df = spark.range(900).select((F.col("id") % 40).alias("k"), "id").repartition(5)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 50)
    try:
        near = rows(O.limit_rows(df, 510, ["k"], gather=1000), "k", "id")
        far = rows(O.limit_rows(df, 510, ["k"], gather=10), "k", "id")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(far) == 510 and near == far


def test_filter_not_in_table_and_empty(spark, small):
    table = spark.createDataFrame([("a",), ("a",), ("b",)], "other string")
    assert rows(E.filter_not_in(small, "id", table), "id") == [("c",)]
    assert rows(E.filter_not_in(small, "id", [], keep_null=True), "id") == rows(small, "id")


def test_edits(spark, small):
    assert rows(E.filter_eq(small, "id", "a", negate=True), "id") == [("b",), ("c",)]
    assert rows(E.update_where(small, "n > 1", "id", "z"), "id", "n") == [
        ("a", 1), ("c", None), ("z", 2), ("z", 3)]
    assert rows(E.delete_where(small, "n > 1"), "id") == [("a",), ("c",)]
    new = spark.createDataFrame([("a", 9), ("q", 8)], "id string, n int")
    assert rows(E.update_from_map(small, new, "id", "n"), "id", "n") == [
        ("a", 9), ("b", 2), ("c", None), (None, 3)]
    out = E.update_computed(small, small.filter("id = 'b'"), "id", {"n": F.lit(None).cast("int")})
    assert rows(out, "id", "n") == [("a", 1), ("b", None), ("c", None), (None, 3)]
    assert E.add_column(small, "x", "double").schema["x"].dataType == T.DoubleType()
    with pytest.raises(ValueError):
        E.drop_table_column(small, "absent")
    text = spark.createDataFrame([("['DS_1', 'DS_10']",), ("['DS_10']",), (None,), ("[]",), ("[ ]",)], "v string")
    assert E.filter_member(text, "v", "DS_1").count() == 1
    assert E.filter_nonempty_list(text, "v").count() == 2


def test_cast_timestamp(spark):
    df = spark.createDataFrame([(1_700_000_000_123_456_789,), (None,)], "t long")
    found = E.cast_timestamp(df, "t").select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()
    assert [r[0] for r in found] == ["2023-11-14 22:13:20.123456", None]
    text = spark.createDataFrame([("2023-11-14T22:13:20Z",)], "t string")
    assert E.cast_timestamp(text, "t").schema["t"].dataType == T.TimestampType()


def test_typed_table_keeps_unknown_columns_and_empty_tables(spark):
    schema = T.StructType.fromDDL("v array<double>, n int, w array<string>")
    df = spark.createDataFrame([("[1.0]", 1, "x", ["k"])], "v string, n long, extra string, w array<string>")
    assert tuple(E.typed_table(df, schema).first()) == ([1.0], 1, "x", ["k"])
    assert E.typed_table(df.limit(0), schema).count() == 0


def test_remaps(spark):
    df = spark.createDataFrame([("a", "h1"), ("b", "h2"), (None, "h3")], "id string, hash string")
    new = spark.createDataFrame([("a", "A", "H")], "id string, new_id string, new_hash string")
    replace = {"id": "new_id", "hash": "new_hash"}
    assert rows(J.remap_ids(df, new, replace), "id", "hash") == [("A", "H")]
    assert rows(J.remap_ids(df, new, replace, how="left"), "id", "hash") == [("A", "H"), ("b", "h2"), (None, "h3")]
    total = df.filter("id IS NOT NULL").selectExpr("id", "concat('n', id) AS new_id", "hash AS new_hash")
    assert J.remap_ids(df.filter("id IS NOT NULL"), total, replace).count() == 2


def test_chains_of_maps_are_collapsed(spark):
    rng = random.Random(4)
    steps = [(f"{c}-{i}", f"{c}-{i + 1}") for c in range(30) for i in range(rng.randint(0, 20))]
    steps += [("x-0", "same-end"), ("y-0", "same-end"), ("i", "i"), (None, "a"), ("b", None)]
    rng.shuffle(steps)
    frames = [spark.createDataFrame(steps[i::3] + steps[:5], "id string, new_id string") for i in range(3)]
    after = {a: b for a, b in steps if a and b and a != b}

    def last(x):
        while x in after:
            x = after[x]
        return x

    assert rows(J.collapse_maps(*frames), "id", "new_id") == sorted((a, last(a)) for a in after)
    assert J.collapse_maps(frames[0].limit(0)).collect() == []


def test_forks_and_cycles_of_maps_are_errors_that_name_ids(spark):
    table = lambda pairs: spark.createDataFrame(pairs, "id string, new_id string")
    with pytest.raises(J.MapError, match="several new ids: a$"):
        J.collapse_maps(table([("a", "b"), ("b", "c")]), table([("a", "c")]))
    tail = [(f"t{i}", f"t{i + 1}") for i in range(9)] + [("t9", "c0")]
    for size in (2, 3, 4, 7):
        cycle = [(f"c{i}", f"c{(i + 1) % size}") for i in range(size)]
        with pytest.raises(J.MapError) as error:
            J.collapse_maps(table(tail + cycle + [("p", "q")]))
        assert error.value.ids == sorted(c for c, _ in cycle)


def test_typed_table_with_account(spark):
    schema = T.StructType.fromDDL("v array<double>, w array<string>, n int")
    df = spark.createDataFrame([("a", "[1.0]", "oops", 1), ("b", "bad", None, 2), ("c", None, "['x']", 3), ("d", "worse", "['y']", 4)], "id string, v string, w string, n bigint")
    typed, lost, counts = E.typed_table_with_account(df, schema)
    assert typed.schema["v"].dataType == T.ArrayType(T.DoubleType()) and typed.columns == df.columns and counts == {"v": 2, "w": 1}
    assert rows(typed, "id", "v", "w", "n") == rows(E.typed_table(df, schema), "id", "v", "w", "n")
    assert rows(lost, "id", "column", "text") == [("a", "w", "oops"), ("b", "v", "bad"), ("d", "v", "worse")]
    empty, _, _ = E.typed_table_with_account(df, schema, on_error="empty")
    assert rows(empty, "id", "v") == [("a", [1.0]), ("b", []), ("c", None), ("d", [])]
    none, nothing, counts = E.typed_table_with_account(df.select("id", "n"), schema)
    assert none.count() == 4 and nothing.collect() == [] and counts == {}
    with pytest.raises(ValueError):
        E.typed_table_with_account(df, schema, on_error="fail")


def test_audits(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    child = spark.createDataFrame([("a", ["a", "b"]), ("a", []), ("x", None), (None, ["x"])], "fk string, many array<string>")
    assert rows(J.anti_missing_children(parent, child, "fk"), "id") == [("b",), ("c",)]
    assert rows(J.anti_missing_children(parent, child, "many"), "id") == [("c",)]
    assert rows(J.anti_orphans(child, parent, "fk"), "fk") == [("x",), (None,)]
    assert tuple(A.audit_counts(parent, parent.limit(0)).first()) == (3, 0, 3)
    assert tuple(A.audit_counts(parent.limit(0), parent.limit(0)).first()) == (0, 0, 0)
    changed = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, None)], "a int, b int")
    assert A.changed_rows(changed, "a", "b").count() == 2
    assert rows(A.missing_numbers(changed, "a", 3), "a") == [(0,), (2,)]


def hot(n=3000, seed=5):
    """Rows of which a third share one id."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randint(0, n // 4)}"
        names = [f"n{rng.randint(0, 40)}" for _ in range(rng.randint(0, 3))] if i % 7 else None
        out.append((key, names, rng.choice([None, rng.randint(0, 99)]), rng.choice([None, f"s{i}"]), rng.randint(0, 30)))
    return out


HOT = "id string, names array<string>, n int, s string, stamp int"


def tie_of(n, s):
    return zlib.crc32(f"{s},{n}".encode())


def tie():
    return F.expr("crc32(cast(concat(coalesce(s, 'None'), ',', coalesce(string(n), 'None')) AS binary))")


def merged(data, newest=True):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    out, best = {}, max if newest else min
    for key, members in groups.items():
        # A list that is null in every copy stays null.
        lists = [r[1] for r in members if r[1] is not None]
        names = sorted({x for v in lists for x in v}) if lists else None
        pick = lambda i: best(((r[4], tie_of(r[2], r[3]), r[i]) for r in members if r[i] is not None), default=(None,))[-1]
        out[key] = (names, pick(2), pick(3), best(r[4] for r in members))
    return out


@pytest.mark.parametrize("dealt", [False, True])
def test_combine_duplicates_brute_force(spark, monkeypatch, dealt):
    if dealt:
        monkeypatch.setattr(K, "ROWS_PER_TASK", 100)
    data = hot()
    df = spark.createDataFrame(data, HOT)
    expected = merged(data)
    for out in (
        A.combine_duplicates(df, "id", ["names"], "stamp", tie=tie()),
        curate.repair_duplicates(df, ["names"], order="stamp", tie=tie()),
    ):
        found = {r["id"]: (r["names"], r["n"], r["s"], r["stamp"]) for r in out.collect()}
        assert out.columns == df.columns and len(found) == out.count() == len(expected)
        for key, value in expected.items():
            if found[key] != value:
                # A row that is not repeated keeps its list as it is.
                own = [r for r in data if r[0] == key]
                assert len(own) == 1 and found[key] == tuple(own[0][1:])
    first = A.combine_duplicates(df, "id", ["names"], "stamp", "first", tie())
    assert {r["id"]: tuple(r)[1:] for r in first.collect()} == merged(data, newest=False)


def test_combine_duplicates_takes_ties_from_one_row_and_repeats(spark):
    data = [("a", i % 3, f"x{i}", f"y{i}") for i in range(60)] * 2 + [("b", None, "only", None), ("c", None, None, None), ("d", 1, None, "p"), ("d", None, "q", None)]
    df = spark.createDataFrame(data, "id string, stamp int, x string, y string")
    once = rows(A.combine_duplicates(df, "id", [], "stamp"), "id", "stamp", "x", "y")
    assert once == rows(A.combine_duplicates(df.repartition(7, "x"), "id", [], "stamp"), "id", "stamp", "x", "y")
    a, b, c, d = once
    assert a[1] == 2 and int(a[2][1:]) % 3 == 2 and a[2][1:] == a[3][1:]
    assert (b, c, d) == (("b", None, "only", None), ("c", None, None, None), ("d", 1, "q", "p"))
    without = rows(A.combine_duplicates(df, "id", []), "id", "x", "y")
    assert [r[0] for r in without] == ["a", "b", "c", "d"] and without[0][1][1:] == without[0][2][1:]
    assert A.combine_duplicates(df.limit(0), "id", [], "stamp").collect() == []
    with pytest.raises(ValueError):
        A.combine_duplicates(df, "id", [], "stamp", "newest")


def test_combine_duplicates_union_and_null_elements(spark):
    df = spark.createDataFrame(
        [("a", ["x", None], 1, {"k": 1}), ("a", ["x"], 2, None), ("a", None, None, None), ("b", [], None, None), ("c", None, None, None)],
        "id string, names array<string>, n int, m map<string,int>")
    some = df.drop("m")
    union = lambda keep: rows(A.combine_duplicates(some, "id", ["names"], policy="union", keep_nulls=keep), "id", "names", "n")
    assert union(False) == [("a", ["x"], [1, 2]), ("b", [], None), ("c", None, None)] and union(True)[0] == ("a", [None, "x"], [1, 2])
    kept = A.combine_duplicates(some, "id", ["names"], "n", keep_nulls=True)
    assert rows(kept, "id", "names", "n") == [("a", [None, "x"], 2), ("b", [], None), ("c", None, None)]
    # A row hash stands maps, wherever they are.
    assert df.select(A.row_hash(df)).distinct().count() == 5


def test_combine_duplicates_sorts_no_wide_rows(spark):
    df = spark.createDataFrame(hot(200), HOT)
    plan = A.combine_duplicates(df, "id", ["names"], "stamp", tie=tie())._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_metadata_lookup_with_hot_and_null_paths(spark):
    paths = [None if i % 3 == 0 else "hot" if i % 3 == 1 else f"p{i}" for i in range(900)]
    df = spark.createDataFrame(list(enumerate(paths)), "i int, path string")
    store = spark.createDataFrame([(f"p{i}", f"text {i}") for i in range(400)] + [("hot", "hot text")], "path string, content string")
    known = {**{f"p{i}": f"text {i}" for i in range(400)}, "hot": "hot text"}
    for limit in ("10MB", "-1"):  # broadcast and shuffled
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found = metadata.metadata_lookup(df, store, {"path": "m"}).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert {r["i"]: r["m"] for r in found} == {i: known.get(p) for i, p in enumerate(paths)}
        assert len(found) == 900


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_deals_out_hot_keys(spark, monkeypatch, how, broadcast):
    monkeypatch.setattr(K, "ROWS_PER_TASK", 100)
    keys = [None if i % 5 == 0 else "hot" if i % 3 == 0 else "gone" if i % 7 == 0 else f"k{i % 40}" for i in range(3000)]
    left = spark.createDataFrame(list(enumerate(keys)), "i int, k string").repartition(5)
    table = {"hot": "H", **{f"k{i}": f"v{i}" for i in range(30)}}
    right = spark.createDataFrame(list(table.items()), "k string, v string")
    hot = K.hot_keys(left, "k")
    assert hot["hot"] == -(-keys.count("hot") // 100) and hot[None] == 6 and "k1" not in hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        out = K.lookup_join(left, right, "k", how)
        expected = [(i, k, table.get(k)) for i, k in enumerate(keys) if how == "left" or k in table]
        assert sorted((r["i"], r["k"], r["v"]) for r in out.collect()) == expected
        assert out.columns == ["k", "i", "v"] == left.join(right, "k", how).columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_reach_every_lookup(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS_PER_TASK", 10)
    po = spark.range(300).selectExpr("concat('p', id) AS id", "if(id % 3 = 0, 'c0', concat('c', id % 7)) AS configuration_id")
    co = spark.range(7).selectExpr("concat('c', id) AS id", "cast(id AS int) AS nsites", "concat('n', id) AS new_id")
    wanted = {r["id"]: r["configuration_id"][1:] for r in po.collect()}
    assert {r["id"]: str(r["nsites"]) for r in J.attach_nsites(po, co).collect()} == wanted
    assert {r["id"]: r["configuration_id"][1:] for r in J.remap_foreign_key(po, co).collect()} == wanted
    merged = J.merge_po_co(po, co, ["property_id", "configuration_id", "nsites"])
    assert {r["property_id"]: str(r["nsites"]) for r in merged.collect()} == wanted
    assert J.flatten_po_co(po, co.filter("nsites > 3")).count() == 300
    numbers = spark.range(50).selectExpr("id", "cast(if(id % 2 = 0, 0, id) AS int) AS k")
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "k int, name string")
    assert K.lookup_join(numbers, names, "k").filter("name = 'zero'").count() == 25


def test_metadata_lookup_of_two_columns(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "a"), (3, "c", None), (4, "x", "b")], "i int, p string, q string")
    store = spark.createDataFrame([(k, k * 2) for k in "abcd"], "path string, content string")
    found = metadata.metadata_lookup(df, store, {"p": "pm", "q": "qm"})
    assert rows(found, "i", "pm", "qm") == [(1, "aa", "bb"), (2, None, "aa"), (3, "cc", None), (4, None, "bb")]
    assert found.columns == ["i", "p", "q", "pm", "qm"]


def test_metadata_store_reads_files(spark, tmp_path):
    folder = tmp_path / "store" / "store" / "data" / "MD"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"a": 1}\n{"b": 2}\n')
    (folder / "b.json").write_text("")
    found = rows(metadata.metadata_store(spark, str(tmp_path / "store" / "store")), "path", "content")
    assert ("data/MD/a.json", '{"a": 1}\n{"b": 2}\n') in found


def test_scan_text_ids_over_many_files_and_splits(spark, tmp_path):
    ids = [f"id{i:05d}" for i in range(2000)]
    (tmp_path / "list.csv").write_text("id,name\n\n" + "".join(f"  {i} ,x\n" + "\n" * (k % 2) for k, i in enumerate(ids)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        found = scan.scan_text_ids(spark, str(tmp_path / "list.csv"), start=10, stop=1990).orderBy("position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["id"].strip() for r in found] == ids[10:1990]
    assert [r["position"] for r in found] == list(range(10, 1990))


def test_rows_to_df(spark):
    schema = T.StructType.fromDDL("id string, size int, x double")
    found = scan.rows_to_df(spark, [("a", 3.0, 1.5), ("b", None, None), ("c", 4, 0.0)], schema)
    assert found.schema == schema and rows(found, "id", "size") == [("a", 3), ("b", None), ("c", 4)]


def test_recalculate_dataset(spark):
    co = spark.createDataFrame(
        [("c1", 4, ["H", "O"], [0.5, 0.5], 3, [1, 1, 1]), ("c2", 6, ["H"], [1.0], 0, [0, 0, 0]), ("c3", 5, [], [], 3, [1, 1, 1])],
        "id string, nsites int, elements array<string>, elements_ratios array<double>, nperiodic_dimensions int, dimension_types array<int>",
    )
    po = spark.createDataFrame(
        [("d1", "c1", 1.0), ("d1", "c1", 3.0), ("d1", "c2", None), ("d2", "c3", 5.0)],
        "dataset_id string, configuration_id string, energy double",
    )
    ds = spark.createDataFrame([("d1", "one", 99), ("d2", "two", 99), ("d3", "none", 99)], "id string, name string, nsites int")
    found = {r["id"]: r.asDict() for r in A.recalculate_dataset(ds, po, co).collect()}
    one = found["d1"]
    assert (one["nconfigurations"], one["nsites"], one["nproperty_objects"], one["energy_count"]) == (2, 10, 3, 2)
    assert (one["elements"], one["nelements"], one["total_elements_ratios"]) == (["H", "O"], 2, [0.8, 0.2])
    assert (one["energy_mean"], one["energy_variance"]) == (2.0, 2.0)
    assert one["nperiodic_dimensions"] == [0, 3] and one["dimension_types"] == [[0, 0, 0], [1, 1, 1]]
    assert (found["d2"]["nconfigurations"], found["d2"]["nsites"], found["d2"]["elements"]) == (1, 5, [])
    assert found["d3"]["nsites"] is None and found["d3"]["name"] == "none"


def test_states_of_batches_are_those_of_a_rebuild(spark, tmp_path):
    rng = random.Random(3)
    co = spark.createDataFrame(
        [(f"c{i}", i % 5 + 1, ["H", "O"][: i % 3], [0.5, 0.5][: i % 3], i % 4, [i % 2]) for i in range(40)],
        "id string, nsites int, elements array<string>, elements_ratios array<double>, nperiodic_dimensions int, dimension_types array<int>",
    )
    # One dataset appears late, one has one energy, one none; energies are large and close, so sums of squares would cancel.
    made = [(f"d{rng.choice([0, 0, 0, 1, 2])}", f"c{rng.randint(0, 45)}", 1e9 + rng.random() if rng.random() < 0.8 else None, i // 100) for i in range(400)]
    made += [("late", "c1", 5.0, 3), ("none", None, None, 1)]
    po = spark.createDataFrame(made, "dataset_id string, configuration_id string, energy double, batch int")
    ds = spark.createDataFrame([(d, d.upper(), 7) for d in ("d0", "d1", "d2", "late", "none", "empty")], "id string, name string, nsites int")
    cs = spark.createDataFrame([("s1", "d0"), ("s2", "d0"), ("s3", "late")], "id string, dataset_id string")
    states = ST.DatasetStates(spark, str(tmp_path))
    with pytest.raises(ValueError):
        states.rows(ds)
    for i in (0, 1, 2, 1, 3):
        states.add(f"b{i}", po.filter(F.col("batch") == i), co)
    assert states.batches() == ["b0", "b1", "b2", "b3"]
    whole, grown = A.recalculate_dataset(ds, po, co, cs), states.rows(ds, cs)
    assert whole.schema == grown.schema and dict(whole.dtypes)["nsites"] == dict(whole.dtypes)["energy_count"] == "int"
    for a, b in zip(whole.orderBy("id").collect(), grown.orderBy("id").collect()):
        a, b = a.asDict(), b.asDict()
        values = [float(r[2]) for r in made if r[0] == a["id"] and r[2] is not None]
        if len(values) > 1:
            assert a.pop("energy_variance") == pytest.approx(statistics.variance(values), rel=1e-6)
            assert b.pop("energy_variance") == pytest.approx(statistics.variance(values), rel=1e-6)
        assert a.pop("energy_mean") == pytest.approx(b.pop("energy_mean")) and a.pop("total_elements_ratios") == pytest.approx(b.pop("total_elements_ratios"))
        assert a == b and a["nconfiguration_sets"] == {"d0": 2, "late": 1}.get(a["id"], 0)


def test_an_uncommitted_batch_is_written_anew(spark, tmp_path):
    co = spark.createDataFrame([("c1", 2, ["H"], [1.0], 0, [0])], "id string, nsites int, elements array<string>, elements_ratios array<double>, nperiodic_dimensions int, dimension_types array<int>")
    po = spark.createDataFrame([("d", "c1", 1.0)], "dataset_id string, configuration_id string, energy double")
    ds = spark.createDataFrame([("d",)], "id string")
    states = ST.DatasetStates(spark, str(tmp_path))
    for table in ST.TABLES:  # left by a run that died
        spark.range(3).write.parquet(f"{tmp_path}/{table}/b0")
    states.add("b0", po, co)
    row = states.rows(ds).first()
    assert (row["nproperty_objects"], row["nconfigurations"], row["energy_mean"], row["energy_variance"]) == (1, 1, 1.0, None)


def test_orders_and_sets(spark, small):
    assert O.nth_by_size(small, 1, "n").first()["id"] == "a"
    assert O.first_row(small, ["n"]).first()["id"] == "c"
    assert [r["n"] for r in O.reverse_order(small, ["n"]).collect()] == [3, 2, 1, None]
    assert [r["n"] for r in O.order_by(small, "n", desc=True).collect()] == [3, 2, 1, None]
    paths = spark.createDataFrame([("a", "b"), ("b", None), (None, None)], "x string, y string")
    assert rows(S.distinct_paths(paths, ["x", "y"]), "path") == [("a",), ("b",)]


def test_large_limit_takes_what_is_below_a_counted_place(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v")).repartition(7)
    found = O.limit_rows(df, 1234, ["k"], gather=10)
    assert found.columns == ["k", "v"]
    assert sorted(r["k"] for r in found.collect()) == list(range(1234))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("kind", ["text", "number", "double", "mixed", "same", "decimal"])
def test_limit_rows_by_counting_is_a_sort(spark, monkeypatch, kind):
    monkeypatch.setattr(O, "BINS", 5)
    rng = random.Random(8)
    inf = float("inf")
    texts = [None, "", "a", "ab", "ab\x00", "PO_000001_1", "PO_000001_12", "PO_0000019", "é", "\U0001f600", "zz" * 20, "zz" * 20 + "a"]
    value = {
        "text": lambda: (rng.choice([*texts, f"PO_{rng.randint(0, 30):06d}_1"]), 0),
        "number": lambda: (rng.choice([None, -(2**63), 2**63 - 1, 0, rng.randint(-50, 50)]), 0),
        "double": lambda: (rng.choice([None, float("nan"), inf, -inf, 1.7e308, -1.7e308, 5e-324, 0.0, rng.random()]), 0),
        "mixed": lambda: (rng.choice(["a", "b", None]), rng.randint(0, 9)), "same": lambda: ("x", 1),
        "decimal": lambda: (decimal.Decimal(rng.randint(0, 9)) / 4, 0),
    }[kind]
    types = {"number": "bigint", "double": "double", "decimal": "decimal(10,2)"}
    df = spark.createDataFrame([(*value(), i % 40 if kind != "same" else 0) for i in range(400)], f"k {types.get(kind, 'string')}, l int, i int").repartition(3)
    order = ["k", "l"]
    key = lambda r: str(tuple(r))
    for n in (1, 21, 200, 399, 400, 500):
        want = df.orderBy(*order, F.xxhash64(*df.columns)).limit(n).collect()
        got = O.limit_rows(df, n, order, gather=0 if n == 21 else 7).collect()
        assert sorted(map(key, got)) == sorted(map(key, want)), n


def test_purge_of_an_unknown_dataset_removes_nothing(spark):
    co = spark.createDataFrame([("c1", []), ("c2", None), ("c3", ["d2"])], "id string, dataset_ids array<string>")
    out, audit = curate.purge_datasets({"co": co}, ["gone"])
    assert out["co"].count() == 3 and audit.first()["difference"] == 0


def test_purge(spark):
    ds = spark.createDataFrame([("d1",), ("d2",)], "id string")
    co = spark.createDataFrame([("c1", ["d1"]), ("c2", ["d1", "d2"]), ("c3", ["d2"])], "id string, dataset_ids array<string>")
    po = spark.createDataFrame([("p1", "d1"), ("p2", "d2"), ("p3", None)], "id string, dataset_id string")
    cs = spark.createDataFrame([("s1", "d1"), ("s2", "d2")], "id string, dataset_id string")
    pairs = spark.createDataFrame([("s1", "c1"), ("s2", "c2")], "configuration_set_id string, configuration_id string")
    out, audit = curate.purge_datasets({"ds": ds, "co": co, "po": po, "cs": cs, "cs_co_map": pairs}, ["d1"])
    assert rows(out["co"], "id", "dataset_ids") == [("c2", ["d2"]), ("c3", ["d2"])]
    assert rows(out["po"], "id") == [("p2",), ("p3",)]
    assert rows(out["cs_co_map"], "configuration_set_id") == [("s2",)]
    assert rows(audit, "table", "before", "after", "difference") == [
        ("co", 3, 2, 1), ("cs", 2, 1, 1), ("cs_co_map", 2, 1, 1), ("ds", 2, 1, 1), ("po", 3, 2, 1)]


def test_large_limit_reads_a_long_table_a_few_times(spark, monkeypatch):
    reads = []
    of_table = lambda df: "Range (0, 20000" in df._jdf.queryExecution().optimizedPlan().toString()

    def counted(f):
        def call(self, *args):
            reads.append(of_table(self))
            return f(self, *args)
        return call

    kind = type(spark.range(1))
    for name in ("agg", "count", "groupBy"):
        monkeypatch.setattr(kind, name, counted(getattr(kind, name)))
    key = F.concat(F.lit("PO_"), F.lpad(((F.col("id") * 7919) % 20000).cast("string"), 8, "0"), F.lit("_1"))
    df = spark.range(20000).select(key.alias("k"), F.lit("x").alias("l"), F.col("id").cast("int").alias("i"))
    found = O.limit_rows(df, 60, ["l", "k", "i"], gather=10)
    monkeypatch.undo()
    assert "Range (0, 20000" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sum(reads) <= 8 and len(reads) > 8
    assert sorted(r["k"] for r in found.collect()) == [f"PO_{i:08d}_1" for i in range(60)]


def test_lists_of_all_kinds_are_merged_in_one_aggregate(spark):
    rng, nan = random.Random(3), float("nan")
    texts, doubles = ["a", "b", "", None], [nan, 0.0, -0.0, 1.5, float("-inf"), None]
    some = lambda values: rng.choice([None, [], [rng.choice(values) for _ in range(rng.randint(1, 5))]])
    data = [(rng.choice("klmnop"), some(texts), some(doubles), some([1, 2, 3, None]), some([(0.0,), (-0.0,), (nan,), None])) for _ in range(60)]
    data += [("z", None, None, None, None), ("y", [], None, None, None), ("x", [None], [None], None, [])]
    names = ["t", "d", "i", "s"]
    df = spark.createDataFrame(data, "k string, t array<string>, d array<double>, i array<int>, s array<struct<v: double>>").repartition(5)
    for keep in (False, True):
        got = {r["k"]: [r[c] for c in names] for r in A.merged_lists(df, "k", names, keep).collect()}
        want = {}
        for k in sorted({r[0] for r in data} - {"z"}):
            want[k] = []
            for c in range(1, 5):
                lists = [r[c] for r in data if r[0] == k and r[c] is not None]
                seen = {str(v).replace("-0.0", "0.0") for items in lists for v in items if v is not None}
                want[k].append((keep and any(None in items for items in lists), seen) if lists else None)
        plain = lambda v: str(tuple(v)) if isinstance(v, tuple) else str(v)
        for k, lists in got.items():
            for found, expected in zip(lists, want[k], strict=True):
                values = None if found is None else [v for v in found if v is not None]
                assert (found is None) == (expected is None)
                if found is not None:
                    assert (None in found) == expected[0] and {plain(v) for v in values} == expected[1] and len(values) == len(expected[1])
                    numbers = [v for v in values if not isinstance(v, tuple) and v == v]
                    assert numbers == sorted(numbers) and found[:1] == [None][:expected[0]] + values[:1 - expected[0]]
        assert set(got) == set(want)
    plan = A.merged_lists(df, "k", names[:3])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 + 1  # the other is the repartition above
