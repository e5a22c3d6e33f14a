import json
import os

import pytest
from pyspark.sql import functions as F

from mattercat.functions.hashing import hash_columns
from mattercat.plans import publish
from mattercat.plans.rehash import fix_pbc_and_rehash
from mattercat.plans.standardize import Layout, standardize_properties
from mattercat.session import STAGED, drop_staged, scratch, shuffle_settings, staged
from mattercat.sinks import cards, exports as X, tables as W
from mattercat.streaming.incremental import incremental_copy
from workload import sinks
from workload.registry import Tables


def test_size_partitions():
    assert [W.size_partitions(n) for n in (0, 99_999, 100_000, 1_250_000)] == [1, 1, 1, 12]
    assert [W.size_partitions(n, "steps") for n in (5, 10_000, 10_001, 100_001, 1_000_000)] == [2, 2, 4, 8, 20]


def test_publish_swap_stops_before_the_first_rename(spark, tmp_path):
    for name in ("swap_a", "swap_a_tmp", "swap_b"):
        W.save_table(spark.range(3), name, "overwrite", str(tmp_path / name))
    with pytest.raises(ValueError, match="swap_b"):
        W.publish_swap(spark, "20240101", ["swap_a", "swap_b"])
    assert W.table_exists(spark, "swap_a_tmp") and not W.table_exists(spark, "swap_a_20240101")
    W.save_table(spark.range(5), "swap_b_tmp", "overwrite", str(tmp_path / "swap_b_tmp"))
    W.publish_swap(spark, "20240101", ["swap_a", "swap_b"])
    assert spark.table("swap_b").count() == 5 and spark.table("swap_b_20240101").count() == 3
    W.save_table(spark.range(1), "swap_b_tmp", "overwrite", str(tmp_path / "again"))
    W.save_table(spark.range(1), "swap_a_tmp", "overwrite", str(tmp_path / "again2"))
    with pytest.raises(ValueError, match="already retired"):
        W.publish_swap(spark, "20240101", ["swap_a", "swap_b"])


def test_save_modes(spark, tmp_path):
    W.save_table(spark.range(3), "modes", path=str(tmp_path / "modes"))
    with pytest.raises(Exception, match="already exists"):
        W.save_table(spark.range(3), "modes")
    W.save_table(spark.range(3), "modes", "append")
    assert spark.table("modes").count() == 6


def test_resumable_export_skips_what_is_there(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).select("id", F.concat(F.lit("DS_"), F.col("id") % 4).alias("dataset_id"))
    X.export_resumable(df.filter("dataset_id < 'DS_2'"), path, level=1)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/dataset=DS_0/*.parquet")}
    X.export_resumable(df, path, level=1)
    assert {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/dataset=DS_0/*.parquet")} == before
    back = spark.read.parquet(path)
    assert back.count() == 100 and back.select("dataset_id").distinct().count() == 4
    X.export_resumable(df, path, level=1)
    assert spark.read.parquet(path).count() == 100


def test_a_large_dataset_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    sized = X.file_sized
    # One dataset holds most rows; shuffle partitions above 100 KB are cut.
    df = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.when(F.col("id") % 10 < 8, "DS_hot").otherwise(F.concat(F.lit("DS_"), F.col("id") % 10)).alias("dataset_id"),
    ).repartition(8)
    monkeypatch.setattr(X, "file_sized", lambda session: sized(session, 100_000))
    X.export_all_datasets(df, str(tmp_path / "out"), level=1)
    assert len(list(tmp_path.glob("out/dataset=DS_hot/*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60_000


def test_row_limit_and_codec(spark, tmp_path):
    import pyarrow.parquet as pq

    X.export_dataset_parquet(spark.range(1000).coalesce(1), str(tmp_path / "o"), max_rows=300, level=1)
    files = sorted(tmp_path.glob("o/*.parquet"))
    assert [pq.read_metadata(f).num_rows for f in files] == [300, 300, 300, 100]
    assert pq.read_metadata(files[0]).row_group(0).column(0).compression == "ZSTD"


def test_json_timestamps(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS id, timestamp '2024-01-31 12:00:05.5' AS last_modified, cast(NULL AS int) AS n")
    X.export_dataset_json(df, str(tmp_path / "j"))
    lines = [line for f in tmp_path.glob("j/*.json") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"id": "a", "last_modified": "2024-01-31T12:00:05Z", "n": None}]


def test_extxyz_frame(spark):
    df = spark.createDataFrame([
        ("DS_1", [1, 8], [[0.0, 0.0, 0.0], [1.5, -2.0, 0.25]], [[5.0, 0.0, 0.0], [0.0, 5.0, 0.0], [0.0, 0.0, 5.0]],
         [True, True, False], [[0.1, 0.2, 0.3], [-0.1, -0.2, -0.3]], -1.25, "DFT-PBE", "VASP 5", ["a b", "c"], [], True, None),
        ("DS_1", [26], [[0.0, 0.0, 0.0]], [[1.0, 0.0, 0.0]] * 3, [False] * 3, None, None, "x", None, None, None, None, 3),
    ], "dataset_id string, atomic_numbers array<int>, positions array<array<double>>, cell array<array<double>>, "
       "pbc array<boolean>, atomic_forces array<array<double>>, energy double, method string, software string, "
       "names array<string>, labels array<string>, cauchy_stress_volume_normalized boolean, multiplicity int")
    first, second = [r["value"] for r in X.extxyz_frames(df).collect()]
    assert first.split("\n") == [
        "2",
        'Lattice="5.0 0.0 0.0 0.0 5.0 0.0 0.0 0.0 5.0" Properties=species:S:1:pos:R:3:forces:R:3 dataset_id=DS_1 '
        'software="VASP 5" method=DFT-PBE energy=-1.25 cauchy_stress_volume_normalized=T names=["a b","c"] pbc="T T F"',
        "H        0.00000000       0.00000000       0.00000000       0.10000000       0.20000000       0.30000000",
        "O        1.50000000      -2.00000000       0.25000000      -0.10000000      -0.20000000      -0.30000000",
    ]
    assert second.split("\n")[1:] == [
        'Lattice="1.0 0.0 0.0 1.0 0.0 0.0 1.0 0.0 0.0" Properties=species:S:1:pos:R:3 dataset_id=DS_1 multiplicity=3 '
        'method=x pbc="F F F"',
        "Fe       0.00000000       0.00000000       0.00000000",
    ]


def test_cards(spark):
    ds = spark.createDataFrame(
        [("DS_1", "A_b", "['Ann Bee']", "text", "['C', 'H']", 3, 9, 3, 0, "CC0", "{'source-publication': 'P', 'source-data': 'D'}", "2024", "10.1/x"),
         ("DS_2", "C", "Cy Dee", None, "[]", 1, 1, 0, 0, None, "bad", None, None)],
        "id string, name string, authors string, description string, elements string, nconfigurations int, nsites int, "
        "energy_count int, formation_energy_count int, license string, links string, publication_year string, doi string",
    )
    cs = spark.createDataFrame([("CS_1", "DS_1"), ("CS_2", "DS_1")], "id string, dataset_id string")
    found = {r["id"]: r["card"] for r in cards.dataset_card(ds, cs, "Site", "https://s").collect()}
    assert len(found) == 2
    for part in ("license: cc0-1.0\n", "Bee, A. _A b_. Site, 2024", "### Publication  \nP  \n", "### Original data link  \nD",
                 "### Elements included  \nC, H  \n", "### Properties included  \nenergy  \n", "kind=cs/*.parquet"):
        assert part in found["DS_1"]
    assert "kind=cs/*.parquet" not in found["DS_2"] and "Publication" not in found["DS_2"]


def test_incremental_copy_takes_only_new_files(spark, tmp_path):
    src, dst, mark = (str(tmp_path / n) for n in ("src", "dst", "mark"))
    spark.range(10).write.parquet(src)
    schema = spark.range(1).schema
    incremental_copy(spark, src, dst, mark, schema)
    incremental_copy(spark, src, dst, mark, schema)
    assert spark.read.parquet(dst).count() == 10
    spark.range(10, 15).write.mode("append").parquet(src)
    incremental_copy(spark, src, dst, mark, schema, transform=lambda d: d.filter("id <> 12"), max_files=1)
    assert sorted(r["id"] for r in spark.read.parquet(dst).collect()) == [*range(12), 13, 14]


def test_incremental_copy_takes_files_with_an_old_time(spark, tmp_path):
    src, dst, mark = (str(tmp_path / n) for n in ("src", "dst", "mark"))
    schema = spark.range(1).schema
    for first, age in ((0, 0), (5, 400 * 86_400)):
        before = set(tmp_path.glob("src/*.parquet"))
        spark.range(first, first + 5).coalesce(1).write.mode("append").parquet(src)
        for new in set(tmp_path.glob("src/*.parquet")) - before:
            os.utime(new, (new.stat().st_mtime - age,) * 2)
        incremental_copy(spark, src, dst, mark, schema)
    assert spark.read.parquet(dst).count() == 10


def test_resumable_export_keeps_finished_groups(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    df = spark.range(100).select("id", F.concat(F.lit("DS_"), F.col("id") % 4).alias("dataset_id"))
    calls, real = [], X.spread_by

    def failing(rows, col):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(rows, col)

    monkeypatch.setattr(X, "spread_by", failing)
    with pytest.raises(RuntimeError):
        X.export_resumable(df, path, level=1, group_rows=25)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/dataset=*/*.parquet")}
    assert len({p.parent for p in before}) == 2
    X.export_resumable(df, path, level=1, group_rows=25)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("out/dataset=*/*.parquet")}
    assert before.items() <= after.items() and spark.read.parquet(path).count() == 100


def test_resumable_export_keeps_rows_without_a_dataset(spark, tmp_path):
    path = str(tmp_path / "out")
    names = F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "").otherwise(F.concat(F.lit("DS_"), F.col("id") % 4))
    df = spark.range(100).select("id", names.alias("dataset_id"))
    for _ in range(2):
        X.export_resumable(df, path, level=1, group_rows=25)
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(100))
    assert spark.read.parquet(f"{path}_done").count() == 4


def test_resumable_export_names_datasets_without_a_size(spark, tmp_path):
    df = spark.range(10).select("id", F.concat(F.lit("DS_"), F.col("id") % 2).alias("dataset_id"))
    sizes = spark.createDataFrame([("DS_0", 5)], "dataset_id string, rows bigint")
    with pytest.raises(ValueError, match="DS_1"):
        X.export_resumable(df, str(tmp_path / "out"), level=1, sizes=sizes)
    assert not (tmp_path / "out").exists()


def test_publish_swap_is_undone_when_a_rename_fails(spark, tmp_path, monkeypatch):
    for name, n in (("undo_a", 1), ("undo_a_tmp", 2), ("undo_b", 1), ("undo_b_tmp", 2)):
        W.save_table(spark.range(n), name, "overwrite", str(tmp_path / name))
    real = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if "undo_b_tmp RENAME" in text:
            raise RuntimeError("lost")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        W.publish_swap(spark, "20240202", ["undo_a", "undo_b"])
    assert [spark.table(t).count() for t in ("undo_a", "undo_a_tmp", "undo_b", "undo_b_tmp")] == [1, 2, 1, 2]


def test_export_of_merged_rows_and_of_bad_lists(spark, tmp_path):
    ds = spark.createDataFrame([("DS_1", "A", "['x']", "d", "['C']", 1, 1, "{}", "2024", "10.1/x", "CC0")],
                               "id string, name string, authors string, description string, elements string, nconfigurations int, "
                               "nsites int, links string, publication_year string, doi string, license string")
    cs = spark.createDataFrame([], "id string, dataset_id string")
    merged = spark.createDataFrame([("p", "DS_1", "a", "b")], "id string, dataset_id string, property_metadata_path string, configuration_metadata_path string")
    store = spark.createDataFrame([("a", "one"), ("b", "two")], "path string, content string")
    publish.export({"ds": ds, "cs": cs, "merged": merged}, str(tmp_path / "m"), "S", "https://s", store, 1)
    row = spark.read.parquet(str(tmp_path / "m" / "dataset=DS_1" / "kind=merged")).first()
    assert (row["dataset_id"], row["property_metadata"], row["configuration_metadata"]) == ("DS_1", "one", "two")
    co = spark.createDataFrame([("c", "[broken", ["DS_1"])], "id string, names string, dataset_ids array<string>")
    with pytest.raises(Exception):
        publish.export({"ds": ds, "cs": cs, "co": co}, str(tmp_path / "b"), "S", "https://s", None, 1)
    with pytest.raises(ValueError, match="other"):
        publish.export({"ds": ds, "cs": cs, "other": co}, str(tmp_path / "o"), "S", "https://s")


def test_frames_with_unknown_atoms_and_unequal_lists(spark):
    schema = "dataset_id string, atomic_numbers array<int>, positions array<array<double>>, cell array<array<double>>, pbc array<boolean>"
    frame = lambda numbers, positions: X.extxyz_frames(
        spark.createDataFrame([("d", numbers, positions, [[1.0, 0.0, 0.0]] * 3, [True] * 3)], schema)).first()["value"]
    assert frame([0], [[0.0] * 3]).split("\n")[2].startswith("X  ")
    for numbers, positions in (([1, 1], [[0.0] * 3]), ([1], None)):
        with pytest.raises(Exception, match="one length"):
            frame(numbers, positions)


def test_missing_hash_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="energy"):
        hash_columns(spark.range(1), ["id", "energy"])


def test_shuffle_width_follows_the_input():
    width = int(shuffle_settings(100 << 40)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
    assert width > 100_000 and shuffle_settings(1)["spark.sql.shuffle.partitions"] == "200"


def test_staged_files_can_be_dropped(spark):
    df = staged(spark.range(3), "gone")
    path = STAGED[spark.sparkContext.applicationId][-1]
    assert df.count() == 3
    kept, STAGED[spark.sparkContext.applicationId] = STAGED[spark.sparkContext.applicationId][:-1], [path]
    drop_staged(spark)
    STAGED[spark.sparkContext.applicationId] = kept
    assert not os.path.exists(path.removeprefix("file:"))


def test_standardize_full_layout(spark):
    lay = Layout()
    lay.hash_columns = ["energy", "configuration_id", "dataset_id", "atomic_forces", "cauchy_stress"]
    cells = {"id": "PO_old", "hash": "old", "configuration_id": "c", "dataset_id": "d", "atomic_forces": "[[1.0, 0.0, 0.0]]",
             "cauchy_stress": None, "atomic_forces_unit": "hartree/bohr", "cauchy_stress_unit": None}
    for e in lay.energies:
        cells |= {e: 1.0, f"{e}_unit": "kcal/mol"}
        if e in lay.references:
            cells |= {f"{e}_reference": 2.0, f"{e}_reference_unit": "eV", f"{e}_per_atom": True}
    kinds = {str: "string", float: "double", bool: "boolean", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in cells.items())
    po = spark.createDataFrame([tuple(cells.values())], schema)
    co = spark.createDataFrame([("c", 4)], "id string, nsites int")
    ds = spark.createDataFrame([("d", "name")], "id string, name string")
    rows, datasets = standardize_properties(po, co, ds, lay)
    row = rows.first().asDict()
    assert not [c for c in row if "_unit" in c or "reference" in c or "per_atom" in c or c in ("free_energy", "nsites")]
    kcal = 0.0433641
    assert row["energy"] == pytest.approx(4 * (kcal + 2.0), rel=1e-5)
    assert row["electronic_band_gap"] == pytest.approx(kcal, rel=1e-5)
    assert row["atomic_forces"][0][0] == pytest.approx(51.4220670, rel=1e-6)
    assert row["cauchy_stress"] == [] and row["old_hash"] == "old" and row["id"] == "PO_" + row["hash"][:25]
    assert datasets.first()["energy_count"] == 1


def test_fix_pbc_changes_ids_everywhere(spark):
    co = spark.createDataFrame(
        [("c1", "h", [1], [[1.0, 0.0, 0.0]] * 3, [False] * 3, [[0.0, 0.0, 0.0]], "m", "s"),
         ("c2", "h", [1], [[0.0, 0.0, 0.0]] * 3, [False] * 3, [[0.0, 0.0, 0.0]], "m", "s")],
        "id string, hash string, atomic_numbers array<int>, cell array<array<double>>, pbc array<boolean>, "
        "positions array<array<double>>, metadata_id string, structure_hash string",
    )
    po = spark.createDataFrame([("p1", "x", "c1", "d"), ("p2", "x", "c2", "d"), ("p3", "x", "gone", "d")],
                               "id string, hash string, configuration_id string, dataset_id string")
    new_co, new_po, mapping = fix_pbc_and_rehash(co, po, po_hash_columns=["configuration_id", "dataset_id"],
                                                 co_hash_columns=["atomic_numbers", "cell", "metadata_id", "pbc", "positions"])
    found = {tuple(r["pbc"]): r.asDict() for r in new_co.collect()}
    assert set(found) == {(True,) * 3, (False,) * 3}
    ids = {r["id"] for r in found.values()}
    assert {r["configuration_id"] for r in new_po.collect()} == ids and new_po.count() == 2
    assert all(r["id"] == "CO_" + r["hash"][:25] and r["structure_hash"] != "s" for r in found.values())
    assert found[(True,) * 3]["nperiodic_dimensions"] == 3
    assert mapping.count() == 2


@pytest.mark.parametrize("group", [50_000, 7])
def test_tasks_are_filled_evenly_whatever_the_sizes(spark, monkeypatch, group):
    from mattercat.sinks import placement

    monkeypatch.setattr(placement, "GROUP", group)
    # A third in one dataset, one without a name, one unknown to the sizes, and many small ones.
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id < 20000 THEN 'big' WHEN id < 24000 THEN null WHEN id < 24010 THEN 'unknown' "
        "WHEN id < 40000 THEN concat('m', id % 13) ELSE concat('s', id % 997) END AS dataset_id", "id", "map(1, 2) AS m")
    sizes = rows.filter("dataset_id is null or dataset_id <> 'unknown'").groupBy("dataset_id").count()
    out = placement.placed(rows, sizes, rows_per_task=4_000)
    counts = {r["p"]: r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    assert out.columns == rows.columns and sum(counts.values()) == 60_000 and out.select("id").distinct().count() == 60_000
    if group == 50_000:
        assert max(counts.values()) <= 2 * min(counts.values()) and max(counts.values()) < 4_400
    tasks = out.select("dataset_id", F.spark_partition_id().alias("p")).distinct()
    spread = {r["dataset_id"]: r["count"] for r in tasks.groupBy("dataset_id").count().collect()}
    assert spread["big"] == 5 and all(n == 1 for d, n in spread.items() if d not in ("big", None))


def test_placement_is_right_whatever_is_given(spark):
    from mattercat.sinks import placement

    assert placement.fill_tasks([], 10) == ([], 1) and placement.fill_tasks([0, 0], 10) == ([0, 0], 1)
    place, tasks = placement.fill_tasks([5, 3, 3, 2, 2, 1], 8)
    assert tasks == 2 and sorted(sum(r for r, p in zip([5, 3, 3, 2, 2, 1], place) if p == t) for t in range(2)) == [8, 8]
    rows = spark.createDataFrame([("a", 1), (None, 2)], "dataset_id string, id int")
    for sizes in ([], [("a", None)], [("a", 10**9), ("b", 3)]):
        known = spark.createDataFrame(sizes, "d string, n bigint")
        assert sorted(r["id"] for r in placement.placed(rows, known, rows_per_task=10**8).collect()) == [1, 2]


def test_scratch_leaves_only_what_is_kept(spark):
    before = set(STAGED.get(spark.sparkContext.applicationId, []))
    with scratch(spark) as keep:
        a = staged(spark.range(5), "inner")
        with scratch(spark) as deeper:
            b = deeper(staged(a, "deep").filter("id > 1"), "kept")
        result = keep(b.filter("id > 2"), "result")
    left = [p for p in STAGED[spark.sparkContext.applicationId] if p not in before]
    assert len(left) == 1 and sorted(r["id"] for r in result.collect()) == [3, 4]
    assert not os.path.exists(a.inputFiles()[0].removeprefix("file:") if a.inputFiles() else "")
    with pytest.raises(ValueError), scratch(spark):
        staged(spark.range(1), "failed")
        raise ValueError
    assert len([p for p in STAGED[spark.sparkContext.applicationId] if p not in before]) == 2


def test_many_small_datasets_are_written_by_several_tasks(spark, tmp_path):
    ds = spark.range(40, numPartitions=1).select(F.concat(F.lit("DS_"), "id").alias("id"), F.lit("n").alias("name"))
    X.export_bundle({"ds": ds}, str(tmp_path / "out"), level=1)
    tasks = lambda kind, end: {p.name[:10] for p in tmp_path.glob(f"out/dataset=*/kind={kind}/*.{end}")}
    assert len(tasks("ds", "parquet")) > 1 and spark.read.parquet(str(tmp_path / "out")).count() == 40
    cards.write_cards(ds.select("id", F.col("name").alias("card")), str(tmp_path / "out"))
    assert len(tasks("card", "txt")) > 1


def test_resumable_export_reads_its_input_once_for_all_groups(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def name(i):
        seen.add(1)
        return f"DS_{i % 20:02}"

    df = spark.range(200).select("id", F.udf(name)("id").alias("dataset_id"))
    X.export_resumable(df, str(tmp_path / "out"), level=1, group_rows=10)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in back.collect()) == list(range(200))
    assert spark.read.parquet(str(tmp_path / "out_done")).count() == 20
    assert seen.value <= 4 * 200


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_few_blobs_meet_rows_where_these_are_written(spark, tmp_path, monkeypatch, most):
    from mattercat.sources import metadata

    monkeypatch.setattr(metadata, "MOST_BLOB_BYTES", most)
    cells = [("p1", "DS_1", "a"), ("p2", None, "b"), ("p3", "", "gone"), ("p4", "DS_1", None), ("p5", "DS_1", "e")]
    po = spark.createDataFrame(cells, "id string, dataset_id string, metadata_path string")
    store = spark.createDataFrame([("a", "one"), ("b", "two"), ("e", None), ("z", "other")], "path string, content string")
    step = metadata.metadata_attached(po, store, {"metadata_path": "metadata"})
    assert (step is None) == (most == 0)
    if step:
        plan = step(X.spread_by(po, "dataset_id"))._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        X.export_all_datasets(po, str(tmp_path / "out"), level=1, kind="po", attach=step)
        back = spark.read.parquet(str(tmp_path / "out"))
        assert back.select("id", "dataset_id", "metadata").sort("id").collect() == [
            ("p1", "DS_1", "one"), ("p2", None, "two"), ("p3", "", None), ("p4", "DS_1", None), ("p5", "DS_1", None)]
        X.export_all_datasets(po, str(tmp_path / "plain"), level=1, kind="po")
        assert back.select("id", "dataset").sort("id").collect() == spark.read.parquet(str(tmp_path / "plain")).select("id", "dataset").sort("id").collect()


def test_text_frames_are_packed_and_read_back_whole(spark, tmp_path):
    df = spark.range(400).selectExpr(
        "concat('DS_', id % 2) AS dataset_id", "transform(sequence(0, id % 4), i -> array(id * 1.25D, i * 0.5D, 1D)) AS positions",
        "transform(sequence(0, id % 4), i -> 6) AS atomic_numbers", "array(array(1D, 0D, 0D)) AS cell", "array(true) AS pbc")
    want = sorted(line for r in X.extxyz_frames(df).collect() for line in r["value"].split("\n"))
    sizes = {}
    for kind, ending in (("gzip", ".txt.gz"), ("none", ".txt")):
        path = str(tmp_path / kind)
        X.export_extxyz(df, path, **({} if kind == "gzip" else {"compression": kind}))
        files = [f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
        assert files and all(f.endswith(ending) for f in files)
        sizes[kind] = sum(map(os.path.getsize, files))
        assert sorted(r["value"] for r in spark.read.text(path).select("value").collect()) == want
    assert sizes["gzip"] * 3 < sizes["none"]


def test_folders_are_read_without_making_their_names_a_column(spark, tmp_path):
    # Discovered names cost the driver the square of their number, and turned 007 into 7.
    ids = ["DS_1", "007", "a b", "x+y%2F", "p=q/r", "é#?:", "100%", None]
    rows = spark.createDataFrame([(i, f"PO_{n}") for n, i in enumerate(ids)], "dataset_id string, id string")
    path = str(tmp_path / "out +%20")
    X.export_all_datasets(rows, path, level=1)
    back = sinks.read_folders(Tables(spark, ""), path)
    assert back.columns == ["dataset_id", "id"]
    found = back.select("dataset_id", sinks.folder_value("dataset").alias("folder"), "id").collect()
    assert len(found) == len(ids) and all(r["dataset_id"] == r["folder"] == ids[int(r["id"][3:])] for r in found)


@pytest.mark.parametrize("kind", [None, "po"])
def test_rows_are_in_the_order_of_folders_before_wide_columns_are_attached(spark, tmp_path, kind):
    from mattercat.sources import metadata

    names = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, "").otherwise(F.concat(F.lit("DS %"), F.col("id") % 7))
    df = spark.range(400, numPartitions=2).select("id", names.alias("dataset_id"), (F.col("id") % 3).cast("string").alias("path"))
    X.export_all_datasets(df, str(tmp_path / "out"), level=1, kind=kind, attach=lambda rows: rows.withColumn("at", F.monotonically_increasing_id()))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in back.collect()) == list(range(400))
    spans = sorted(tuple(r) for r in back.groupBy(F.expr("shiftright(at, 33)"), "dataset").agg(F.min("at"), F.max("at")).select("min(at)", "max(at)").collect())
    assert all(upto < first for (_, upto), (first, _) in zip(spans, spans[1:]))
    # Folders are those of an export without a step.
    X.export_all_datasets(df, str(tmp_path / "plain"), level=1, kind=kind)
    found = [sorted(str(p.parent.relative_to(tmp_path / top)) for p in tmp_path.glob(f"{top}/**/*.parquet")) for top in ("out", "plain")]
    assert found[0] == found[1]
    # The writer's own order asks for no second sort, which would hold the texts.
    store = spark.createDataFrame([("0", "zero"), ("1", "one")], "path string, content string")
    step = metadata.metadata_attached(df, store, {"path": "text"})
    rows = step(X.in_folder_order(X.spread_by(df, "dataset_id"), "dataset_id", kind))
    rows = rows.sortWithinPartitions(*["dataset", "kind"][: 2 if kind else 1])
    rows.collect()
    assert rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Sort [") == 1


def test_resumable_export_bounds_its_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "MOST_GROUPS", 3, raising=False)
    df = spark.range(120).select("id", F.format_string("DS_%02d", F.col("id") % 40).alias("dataset_id"))
    calls, real = [], X.spread_by
    monkeypatch.setattr(X, "spread_by", lambda rows, col: calls.append(1) or real(rows, col))
    X.export_resumable(df.filter("dataset_id < 'DS_05'"), str(tmp_path / "out"), level=1, group_rows=6)
    X.export_resumable(df, str(tmp_path / "out"), level=1, group_rows=6)
    assert len(calls) == 6  # 15 rows in groups of 6, then 105 in 3 groups of 35
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in back.collect()) == list(range(120))
    assert spark.read.parquet(str(tmp_path / "out_done")).distinct().count() == 40
    X.export_resumable(df, str(tmp_path / "out"), level=1, group_rows=6)
    assert len(calls) == 6


def test_cards_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    from workload import plans, registry

    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000")
    read, widths = type(spark).read, []
    try:
        ds = spark.range(40).select(F.concat(F.lit("DS_"), "id").alias("id"), F.lit("n").alias("name"))
        X.export_bundle({"ds": ds}, str(tmp_path / "out"), level=1)
        cards.write_cards(ds.select("id", F.lit('  data_files: "kind=ds/*.parquet"\n').alias("card")), str(tmp_path / "out"))
        seen = lambda self: widths.append(self.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) or read.fget(self)
        monkeypatch.setattr(type(spark), "read", property(seen))
        found = plans.named_in_cards(registry.Tables(spark, ""), str(tmp_path / "out"), {})
        assert found.count() == 40 and widths == ["64", "64"]
    finally:
        spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "4")
