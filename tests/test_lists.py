import math

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mattercat.functions import lists as L

CASES = [
    ("[]", "double", []),
    ("[[]]", "array<double>", [[]]),
    ("[nan, 1.0]", "double", [math.nan, 1.0]),
    ("[None, -inf, 1e-05]", "double", [None, -math.inf, 1e-05]),
    ("[[0.0, 1.0], [2.5, nan]]", "array<double>", [[0.0, 1.0], [2.5, math.nan]]),
    ("[1, None, 3]", "int", [1, None, 3]),
    ("[[1, 0, 1]]", "array<int>", [[1, 0, 1]]),
    ("[True, False, None]", "boolean", [True, False, None]),
    (r"['it\'s']", "string", ["it's"]),
    ("""["it's", 'x']""", "string", ["it's", "x"]),
    ("['a', None, 'None', 'xNonex']", "string", ["a", None, "None", "xNonex"]),
    ("['None of it, really', 'b']", "string", ["None of it, really", "b"]),
    (r"['a\\b', 'c\nd', '\x41\xe9', 'None']", "string", ["a\\b", "c\nd", "Aé", "None"]),
    ("['[', ']]']", "string", ["[", "]]"]),
]


@pytest.mark.parametrize("text,element,expected", CASES)
@pytest.mark.parametrize("on_error", ["keep_null", "fail", "empty"])
def test_parse_list(one, text, element, expected, on_error):
    found = one(L.parse_list("t", element, on_error), t=text)
    assert str(found) == str(expected)


def test_parse_list_null_and_bad_text(one):
    assert one(L.parse_list("t", "double"), t=None) is None
    assert one(L.parse_list("t", "double", "fail"), t=None) is None
    assert one(L.parse_list("t", "double", "empty"), t=None) == []
    assert one(L.parse_list("t", "double"), t="abc") is None
    assert one(L.parse_list("t", "double", "empty"), t="[1.0, abc]") == []
    assert one(L.parse_list("t", "string"), t="None") is None
    for bad, element in [("abc", "double"), ("[1.0", "double"), ("['x']]", "string"), ("[1.0]]", "double"),
                         ("[1.0, abc]", "double"), ("None", "string")]:
        with pytest.raises(Exception, match="not a list"):
            one(L.parse_list("t", element, "fail"), t=bad)


@pytest.mark.parametrize("text,expected", [
    ("[[0.0, 1.0, 2.0], [3.0, 4.0, 1e-05]]", [[0.0, 1.0, 2.0], [3.0, 4.0, 1e-05]]),
    ("[0, 1, 2, 3, 4, 5]", [[0.0, 1.0, 2.0], [3.0, 4.0, 5.0]]),
    ("[[0, 1], [2, 3, 4, 5]", [[0.0, 1.0, 2.0], [3.0, 4.0, 5.0]]),
    ("[]", []),
    (None, None),
])
def test_parse_matrix(one, text, expected):
    assert one(L.parse_matrix("t"), t=text) == expected


def test_parse_matrix_refuses_other_widths(one):
    with pytest.raises(Exception, match="multiple of 3"):
        one(L.parse_matrix("t"), t="[1, 2]")


def test_text_forms(spark):
    row = spark.range(1).select(
        L.list_to_text(F.array(F.lit("it's"), F.lit('say "x"'), F.lit(None), F.lit("a\\b"))).alias("s"),
        L.list_to_text(F.array(F.lit(1.5), F.lit(float("nan")), F.lit(float("-inf"))), "double").alias("d"),
        L.list_to_text(F.array(F.lit(True), F.lit(False)), "boolean").alias("b"),
        L.list_to_text(F.array(F.array(F.lit(1), F.lit(2))), "array<int>").alias("n"),
        L.list_to_text(F.array().cast("array<string>")).alias("e"),
        L.list_to_text(F.array().cast("array<string>"), empty_as_null=True).alias("z"),
    ).first()
    assert row["s"] == r"""["it's", 'say "x"', None, 'a\\b']"""
    assert (row["d"], row["b"], row["n"]) == ("[1.5, nan, -inf]", "[True, False]", "[[1, 2]]")
    assert (row["e"], row["z"]) == ("[]", None)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(st.none(), st.text(
    alphabet=st.sampled_from("aé'\"\\\n\t ,[]N:None"), max_size=8))), min_size=1, max_size=30))
def test_round_trip_of_strings(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<string>")
    back = df.select("i", L.parse_list(L.list_to_text("v"), "string", "fail").alias("v")).orderBy("i")
    assert [r["v"] for r in back.collect()] == rows


def test_python_repr_is_read(spark):
    values = ["plain", "it's", 'both \' and "', "tab\tnew\nline", "back\\slash", "é ", "\x00\x1f", "None"]
    df = spark.createDataFrame([(repr([v, None, v]),) for v in values], "t string")
    found = [r[0] for r in df.select(L.parse_list("t", "string", "fail")).collect()]
    assert found == [[v, None, v] for v in values]


def test_concat_chunks(spark):
    schema = "f_00 string, f_01 string, f_02 string"
    df = spark.createDataFrame([("[[1.0]]", None, None), ("[[9.0]]", "[[1.0]]", "[[2.0]]")], schema)
    every = [r[0] for r in L.concat_chunks(df, "f", 3, "f").collect()]
    assert every == [[[1.0]], [[9.0], [1.0], [2.0]]]
    over = [r[0] for r in L.concat_chunks(df, "f", 3, "f", overflow=True).collect()]
    assert over == [[[1.0]], [[1.0], [2.0]]]


def test_list_remove_keeps_what_was_empty_and_works_on_text(spark):
    lists = spark.createDataFrame([(1, []), (2, None), (3, ["x"]), (4, ["x", None])], "k int, v array<string>")
    assert {r["k"]: r["v"] for r in L.list_remove(lists, "v", ["x"]).collect()} == {1: [], 2: None, 4: [None]}
    assert L.list_remove(lists, "v", ["absent"]).count() == L.list_remove(lists, "v", []).count() == 4
    texts = spark.createDataFrame([(1, "[]"), (2, None), (3, "['x']"), (4, "['a', 'x']"), (5, "['it\\'s']")], "k int, v string")
    got = {r["k"]: r["v"] for r in L.list_remove(texts, "v", ["x"]).collect()}
    assert got == {1: "[]", 2: None, 4: "['a']", 5: "['it\\'s']"}


def test_list_edits(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, None)], "k int, v array<string>")
    # Only the row that loses its last element goes; a list that was null before stays.
    assert [r["v"] for r in L.list_remove(df, "v", ["b"]).collect()] == [["a", "a"], None]
    kept = L.list_remove(df, "v", ["b"], drop_empty=False).orderBy("k").collect()
    assert [r["v"] for r in kept] == [["a", "a"], [], None]
    assert df.select(L.list_distinct("v")).first()[0] == ["a", "b"]
    pairs = L.list_explode(df, "k", "v", "key", "item").collect()
    assert sorted(map(tuple, pairs)) == [(1, "a"), (1, "a"), (1, "b"), (2, "b")]


def test_ensure_list_and_links(one):
    assert one(L.ensure_list("t"), t="['a', 'b']") == ["a", "b"]
    assert one(L.ensure_list("t"), t="Ann Bee") == ["Ann Bee"]
    assert one(L.ensure_list("t"), t=None) == []
    text = "{'source-publication': 'https://doi.org/1', 'source-data': None, 'other': None}"
    assert list(one(L.parse_links("t"), t=text)) == ["https://doi.org/1", None, None]
    bad = one(L.parse_links("t"), t="nothing")
    assert bad is None or list(bad) == [None, None, None]
