"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    contamination, covertree, filter_audit, infill, langid, main_text, packing, secret_scan, simhash, suffixes, toxicity,
    url_templates, warc,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, capacity=2048, end_id=0)


def remainder(column: str, n: int) -> F.Column:
    """crc32 of an id as text, modulo ``n``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


@query
def op2_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = remainder("doc_id", 5) != 0
    model = toxicity.train(toxicity.labelled(docs.filter(learn), labels.filter(learn)))
    return toxicity.score(docs, model).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("passages").alias("n_passages"),
    )


@query
def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    return url_templates.filter_urls(table(spark, sf_dir, "pages"), rules)


@query
def op4_benchmark_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(remainder("doc_id", 3) != 1), order=4)
    return langid.identify(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op6_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, seed=42, budget=2)


@query
def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Strings of 400 bytes go; repeated passages of more than 50 words, which may be shorter, are told beside them.
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), depth=400, words=51, cut_words=False)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.size("passages").cast("bigint").alias("n_passages"),
        F.aggregate("passages", F.lit(0).cast("bigint"), lambda n, p: n + p["last"] - p["first"]).alias("passage_bytes"),
    )


@query
def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pages carry no time of capture, so one is given.
    return warc.derive(warc.responses_from_pages(table(spark, sf_dir, "pages"), date="2024-01-01T00:00:00Z"))


@query
def op9_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages")).select("*", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op11_retraction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, different = filter_audit.word_counts()
    checks = {
        "A": words < 200, "B": 100 * different < 50 * words,
        "C": 100 * filter_audit.capitals() > 2 * F.length("text"), "D": F.col("text").rlike("[#$%&*|]"),
    }
    return filter_audit.audit_filters(
        spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"), checks, copies="E")


ORACLES["op11_retraction_audit"] = r"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                      list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
                 {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
                  'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                  'D': regexp_matches(t, '[#$%&*|]'),
                  'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)} AS fail
          FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
    m AS (SELECT part, good, toxic, concat(CASE WHEN fail.A THEN 'A' ELSE '' END, CASE WHEN fail.B THEN 'B' ELSE '' END,
                 CASE WHEN fail.C THEN 'C' ELSE '' END, CASE WHEN fail.D THEN 'D' ELSE '' END, CASE WHEN fail.E THEN 'E' ELSE '' END) AS failed
          FROM f),
    n AS (SELECT part, failed, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
    orders AS (SELECT concat(a.c, b.c, c.c, d.c, e.c) AS filter_order FROM x a, x b, x c, x d, x e
               WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
    s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
          FROM orders, range(1, 6) r(step)),
    g AS (SELECT part, filter_order, step, letter, n.*, contains(failed, letter) AS fails,
                 len(list_filter(string_split(before, ''), lambda b: b <> '' AND contains(failed, b))) > 0 AS earlier FROM n, s)
    SELECT part, filter_order, step::INTEGER AS step,
           coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (fails AND NOT earlier), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails AND earlier), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (failed = letter), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (fails AND NOT earlier), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0)::BIGINT AS toxic_lost,
           coalesce(sum(n * 120 // greatest(length(failed), 1)) FILTER (fails), 0)::BIGINT AS shapley
    FROM g GROUP BY part, filter_order, step"""


@query
def op12_repeated_capture_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.infill(table(spark, sf_dir, "documents"), unit=".", seed=1, rate=90, suffix_first=20)
    return cut.select(
        "doc_id", "n", "form", F.col("prefix_end").alias("prefix_chars"),
        (F.col("middle_end") - F.col("prefix_end")).alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored().cast("binary"), 256).alias("restored_sha256"),
    )


ORACLES["op12_repeated_capture_infill"] = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                      sha256(concat('1:', doc_id::VARCHAR)) AS h FROM documents),
    k AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS y,
                 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                           OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    c AS (SELECT doc_id, t, n, form, least(x, y) AS a, greatest(x, y) - least(x, y) AS b FROM k),
    p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b) AS middle, substring(t, a + b + 1) AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p"""


@query
def op13_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"), rate=0.01, level=0.001)
    base = F.filter("spans", lambda s: s["kind"] != "random")
    number = [secret_scan.counted(F.col("spans"), k).alias(f"n_{k}") for k in secret_scan.PATTERNS]
    return found.select(
        "doc_id", *number, F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


# All pairs, then reachability: what the tree search must find, stated plainly.
ORACLES["op10_cover_tree"] = """
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    sound AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
                              AND list_sum([abs(x) for x in e]) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT v.vec_id, coalesce(n.n, 0) AS n_links, root.component_id, v.vec_id = root.component_id AS kept
    FROM v JOIN root ON root.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id"""
