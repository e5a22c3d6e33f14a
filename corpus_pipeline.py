"""A training corpus from raw documents: five stages, each written and read again by the next.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All
but the last return the columns of ``documents``; other columns of ``docs`` are handed
through, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mattercat.llm import contamination, packing, simhash, suffixes, toxicity
from mattercat.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5.

    The model learns from labelled documents outside the held-out fifth, labels being
    those of the table ``labels``. Null and empty texts stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = toxicity.train(toxicity.labelled(docs.filter(learn), labels.filter(learn)))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return toxicity.score(rows, model, doc_id="row").filter("score < 0.5").select("doc_id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints of three-word shingles, two bits apart at most.

    The first of a group in the order of rows stays. Null, empty and wordless texts are one
    group; rows without a doc_id take part like any other. Only the rows that go are
    joined, so texts move only if those are many.
    """
    rows = staged(docs.select(F.struct(*docs.columns).alias("row"), F.col("text"), F.monotonically_increasing_id().alias("id")), "rows")
    groups = simhash.near_duplicates(rows, doc_id="id", words=3, seed=42, budget=2)
    gone = staged(groups.filter("doc_id <> component_id").select("doc_id"), "gone")
    return rows.join(gone, rows.id == gone.doc_id, "left_anti").select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of more than 50 words, or of 400 bytes or more, that occur elsewhere too.

    A cut may fall inside a character, whose other bytes go with it. ``n_chars`` follows
    the text. Null texts stay null.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    found = suffixes.remove_repeats(rows, depth=400, carry="row", words=51)
    length = F.when(F.size("removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("carry.n_chars"))
    names = {"text": F.col("text"), "n_chars": length}
    return found.select(*[names[c].alias(c) if c in names else F.col("carry")[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with an item of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    # Keyed by their text, so that repeated rows and rows without a doc_id are judged too.
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text", F.md5(F.col("text").cast("binary")).alias("key"))
    leaks = staged(contamination.contaminated(rows, items, doc_id="key").select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return rows.join(leaks, "key", "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left as token sequences of 2048: one row for each piece with its place."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Trained scores, alignments and packing are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
