import pytest

import __spark_entry__
import corpus_pipeline as pipeline
from mattercat.llm import simhash
from mattercat.llm.queries import QUERIES

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)], COLUMNS)


def test_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and "pipeline" in __spark_entry__.queries()
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert [name for name, _ in pipeline.STAGES][0] == "toxicity" and len(pipeline.STAGES) == 5


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_stand_odd_rows(spark, stage):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (7, "", "xx", None, 0), (None, "clean and short", "en", "s", 15)], docs.schema)
    # Columns that bear the names of the operators' own.
    mixed = docs.union(odd)
    for name in ("row", "key", "words", "evidence", "id", "kept", "carry", "lane_0"):
        mixed = mixed.selectExpr("*", f"doc_id as {name}")
    got = stage(spark, mixed, folder)
    assert got.schema.simpleString() == mixed.schema.simpleString()
    rows = got.collect()
    assert 0 < len(rows) <= 203 and any(r.doc_id is None and r.text == "clean and short" for r in rows)
    assert stage(spark, mixed.limit(0), folder).collect() == []


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    near = text + " end"
    docs = frame(spark, [text, near, text.upper(), "something else entirely", None, "", " ", "something else entirely"])
    prints = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert prints == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4, 6: 4, 7: 3}
    kept = [r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert len(kept) == 3 and {prints[i] for i in kept} == {0, 3, 4}


def test_repeats_are_cut_and_lengths_follow(spark):
    shared = "".join(chr(97 + i * i % 26) for i in range(450))
    # The last bytes of these two letters are the same, so the repeat begins inside them.
    docs = frame(spark, ["start \u00e9" + shared + " end", "begin \u0169" + shared + "\ufffd", None])
    rows = {r.doc_id: r for r in pipeline.cut_repeats(spark, docs, "").collect()}
    assert [rows[i].text for i in range(3)] == ["start  end", "begin \ufffd", None]
    assert [rows[i].n_chars for i in range(3)] == [10, 7, None]


def test_passages_of_51_words_are_cut_and_of_50_stay(spark):
    many, few = " ".join(f"w{i}" for i in range(51)), " ".join(f"v{i}" for i in range(50))
    assert len(many) < 400
    docs = frame(spark, [f"one {many}. two {few} three", f"four ({many}) five", f"six {few} seven"])
    rows = {r.doc_id: r.text for r in pipeline.cut_repeats(spark, docs, "").collect()}
    assert rows == {0: f"one . two {few} three", 1: "four () five", 2: f"six {few} seven"}


def test_whole_run(spark):
    rows = pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) > 100
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
