import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from mattercat.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int, text string"
DOCS = "doc_id bigint, text string, source string, words string"


def checks():
    words, different = filter_audit.word_counts()
    return {"A": words < 3, "B": 100 * different < 50 * words, "C": 100 * filter_audit.capitals() > 20 * F.length("text")}


def by_hand(docs, labels):
    """Every order, step by step over the documents."""
    failed, found = [], {}
    for doc_id, text, source, _ in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        f |= {"A"} if len(w) < 3 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 20 * len(t) else set()
        if doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == t for o in docs):
            f |= {"E"}
        mine = [x for x in labels if x[0] == doc_id and doc_id is not None]
        failed.append((source or "", f, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    orders = ["".join(p) for p in permutations("ABCE")]
    for part in {x[0] for x in failed}:
        rows, shapley = [x for x in failed if x[0] == part], dict.fromkeys("ABCE", 0)
        for order in orders:
            left = rows
            for at, letter in enumerate(order):
                gone = [x for x in left if letter in x[1]]
                fails = [x for x in rows if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                found[part, order, at + 1] = [
                    len(left), len(gone), len(fails) - len(gone), sum(x[1] == {letter} for x in rows),
                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for order in orders:
            for at, letter in enumerate(order):
                found[part, order, at + 1].append(shapley[letter])
    return found


def result(df):
    return {tuple(r)[:3]: list(r)[3:] for r in df.collect()}


TEXTS = ["one two three four", "a a a a a", "SHOUT LOUD NOW", "", None, " \t\n\x0b", "x", "one  two\x0bthree\nfour", "Café ÉÉ \U0001f600 ok"]


def write(spark, folder, rows):
    """One file per row list, in the order of their times."""
    for i, part in enumerate(rows):
        spark.createDataFrame(part, DOCS).coalesce(1).write.mode("append").parquet(folder)


def test_orders_and_retraction_over_batches(spark, tmp_path):
    # Ids fall from file to file, so that smaller ones keep arriving; each text is in each file, twice with one id.
    files = []
    for f in range(4):
        rows = [(1000 - 100 * f + i % len(TEXTS), TEXTS[i % len(TEXTS)], f"s{(i * 7 + f) % 3}" if i % 5 else None, "clash") for i in range(20)]
        rows += [(None, TEXTS[0], "s1", None), (None, None, None, None)]
        files.append(rows)
    docs = [r for rows in files for r in rows]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0, "x") for i in range(600, 1100)] + [(None, 1, 1, "x"), (700, None, 1, "x"), (700, 1, None, "y")]
    folder = str(tmp_path / "docs")
    write(spark, folder, files)
    known = spark.createDataFrame(labels, LABELS)
    for batches in (1, 4):
        got = result(filter_audit.audit_filters(spark, folder, known, checks(), copies="E", batches=batches))
        assert got == by_hand(docs, labels)


def test_a_later_run_adds_new_files_and_retracts(spark, tmp_path):
    labels = spark.createDataFrame([(5, 1, 0, "")], LABELS)
    folder, state = str(tmp_path / "docs"), str(tmp_path / "state")
    first, second = [(9, "one two three", "a", None), (9, "one two three", "b", None)], [(5, "one two three", "c", None), (7, "one two three", "a", None)]
    write(spark, folder, [first])
    assert result(filter_audit.audit_filters(spark, folder, labels, checks(), copies="E", folder=state)) == by_hand(first, [(5, 1, 0)])
    write(spark, folder, [second])
    assert result(filter_audit.audit_filters(spark, folder, labels, checks(), copies="E", folder=state)) == by_hand(first + second, [(5, 1, 0)])


def test_state_steps_cancel_out():
    import pandas as pd

    columns = ["digest", "doc_id", "part", "mask", "good", "toxic", "n"]
    one = pd.DataFrame([(b"x", 9, "p", 1, False, True, 2)], columns=columns)
    kept, added = filter_audit.stepped(one.iloc[:0], one, 16)
    assert added.values.tolist() == [["p", 1, False, True, 2]]
    kept, added = filter_audit.stepped(kept, pd.DataFrame([(b"x", 3, "q", 1, True, False, 1), (b"x", 9, "p", 1, False, True, 1)], columns=columns), 16)
    assert sorted(added.values.tolist()) == [["p", 1, False, True, -2], ["p", 17, False, True, 3], ["q", 1, True, False, 1]]
    assert kept[["doc_id", "n"]].values.tolist() == [[3, 1]]


def test_empty_tables_and_too_many_filters(spark, tmp_path):
    folder = str(tmp_path / "docs")
    write(spark, folder, [[]])
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(spark, folder, labels, checks(), copies="E").collect() == []
    for letters in ("", "AA", "ABCDEFGH"):
        with pytest.raises(ValueError):
            filter_audit.interactions(spark.createDataFrame([], filter_audit.COUNTS), letters)
