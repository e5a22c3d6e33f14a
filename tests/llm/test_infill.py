import hashlib
import re

import pytest

from mattercat.llm import infill

MARKS = ("<P>", "<S>", "<M>")


def by_hand(doc_id, text, unit="."):
    """The contract, step by step: (n, form, prefix end, middle end, output)."""
    t = text or ""
    units = [m.group() for m in re.finditer(unit, t, re.S)]
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not t or any(m in t for m in MARKS) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, t
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    spm = h[3] % 100 < 20
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), "spm" if spm else "psm", len(prefix), len(prefix + middle), out


@pytest.mark.parametrize("unit", [".", r"\s*\S+\s*"])
def test_against_the_contract_by_hand(spark, unit):
    texts = [None, "", "x", "a<P>b", "tail <", "<<S", "é漢🙂 \n\r\x0b\x85  z", "same", "same", "P> <S M>" * 9, "🙂" * 50]
    rows = [(i, texts[i % len(texts)], "clash") for i in range(200)] + [(None, "no id", "x"), (7, texts[7], "again")]
    docs = spark.createDataFrame(rows, "id bigint, body string, output string")
    if unit != ".":
        docs = docs.filter("trim(body) <> '' or body is null or body = ''")
    found = infill.infill(docs, "id", "body", unit=unit).withColumn("back", infill.restored()).collect()
    wanted = [by_hand(r.id, r.body, unit) for r in docs.collect()]
    assert [tuple(r)[1:6] for r in found] == wanted
    assert [r.back for r in found] == [r.body or "" for r in docs.collect()]
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_a_long_text_is_cut_like_a_short_one(spark, monkeypatch):
    text = "ab🙂\n" * 200_000
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")
    found = infill.infill(docs).withColumn("back", infill.restored()).collect()
    assert [tuple(r)[1:6] for r in found] == [by_hand(i, text) for i in range(4)]
    assert all(r.back == text for r in found)


def test_runs_join_without_a_gap(monkeypatch):
    import regex

    monkeypatch.setattr(infill, "RUN", 7)
    whole, run = regex.compile("(ab?)*"), regex.compile("(ab?){0,7}+")
    text = "aababaabab" * 5
    assert infill.unit_ends(text, whole, run) == [m.end() for m in re.finditer("ab?", text)]
    for bad in ["abab-", "a" * 30 + "-" + "a" * 30]:
        with pytest.raises(ValueError):
            infill.unit_ends(bad, whole, run)


def test_bytes_that_are_not_utf8_and_empty_tables(spark):
    docs = spark.sql("SELECT id AS doc_id, cast(unhex('61FF62C3') AS string) AS text FROM range(30)")
    found = infill.infill(docs).withColumn("back", infill.restored()).select("n", "form", "back", (infill.F.col("back").cast("binary")).alias("raw")).collect()
    assert {r.n for r in found} == {4} and {bytes(r.raw) for r in found} == {b"a\xffb\xc3"}
    assert infill.infill(docs.limit(0)).collect() == []


def test_marks_that_could_be_misread_are_refused():
    for bad in [("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("ab", "ba", "c"), ("aa", "b", "c"), ("abc", "b", "d")]:
        with pytest.raises(ValueError):
            infill.check_sentinels(bad)
    infill.check_sentinels(MARKS)
