"""Queries over sources."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattercat.functions.names import trim_path
from mattercat.sinks.tables import export_text_list
from mattercat.sources import metadata, scan

from .registry import Tables, query


@query("scan_table", "SELECT * FROM part")
def scan_table(t: Tables):
    return scan.scan_table(t.spark, f"{t.folder}/part.parquet")


@query("scan_columns", "SELECT l_orderkey, l_quantity FROM lineitem")
def scan_columns(t: Tables):
    return scan.scan_columns(t.lineitem, ["l_orderkey", "l_quantity"])


@query("scan_id_prefix", "SELECT id, dataset_id, multiplicity FROM {po} WHERE starts_with(id, 'PO_000001')")
def scan_id_prefix(t: Tables):
    return scan.scan_id_prefix(t.po, "id", "PO_000001").select("id", "dataset_id", "multiplicity")


@query("scan_id_list", """
    SELECT id, configuration_id FROM {po}
    WHERE configuration_id IN (SELECT id FROM {co} WHERE nsites > 25)""")
def scan_id_list(t: Tables):
    ids = t.co.filter("nsites > 25").select(F.col("id").alias("configuration_id"))
    return scan.scan_id_list(t.po, ids, "configuration_id").select("id", "configuration_id")


@query("scan_by_dataset", "SELECT id, configuration_id FROM {po} WHERE dataset_id = 'DS_000007_0'")
def scan_by_dataset(t: Tables):
    return scan.scan_by_dataset(t.po, "DS_000007_0").select("id", "configuration_id")


@query("scan_dataset_and_prefix", """
    SELECT id, configuration_id FROM {po}
    WHERE dataset_id = 'DS_000007_0' AND starts_with(id, 'PO_0000')""")
def scan_dataset_and_prefix(t: Tables):
    rows = scan.scan_dataset_and_prefix(t.po, "DS_000007_0", "id", "PO_0000")
    return rows.select("id", "configuration_id")


@query("scan_parquet", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_parquet(t: Tables):
    schema = T.StructType.fromDDL("c_custkey long, c_name string, c_acctbal double")
    return scan.scan_parquet(t.spark, f"{t.folder}/customer.parquet", schema)


@query("scan_csv_ids", "SELECT id FROM {co}")
def scan_csv_ids(t: Tables):
    path = t.fresh("csv-ids")
    t.co.select("label", "id").write.option("header", True).csv(path)
    return scan.scan_csv_ids(t.spark, path)


@query("scan_text_ids", """
    SELECT position, id FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM {co})
    WHERE position >= 100""")
def scan_text_ids(t: Tables):
    # Every second line is blank and each id carries a second field.
    path = t.fresh("text-ids")
    lines = t.co.orderBy("id").select(F.concat(F.lit("  "), "id", F.lit(","), "label", F.lit("\n")).alias("line"))
    export_text_list(lines, "line", path)
    return scan.scan_text_ids(t.spark, path, start=100, header=False)


@query("rows_to_df", """
    SELECT p_partkey AS key, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS size, p_name AS name FROM part""")
def rows_to_df(t: Tables):
    drifted = t.part.select(
        F.col("p_partkey").cast("double").alias("key"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double"))
        .otherwise(F.lit(float("nan"))).alias("size"),
        F.col("p_name").alias("name"),
    )
    schema = T.StructType.fromDDL("key long, size int, name string")
    return scan.rows_to_df(t.spark, drifted, schema)


TRIMMED = "regexp_replace(metadata_path, '^/mnt/blobs/(data/)?', 'data/')"


@query("metadata_lookup", f"""
    SELECT c.id, md5(m.content) AS content_md5
    FROM (SELECT id, {TRIMMED} AS path FROM {{co}}) c LEFT JOIN {{metadata}} m ON m.path = c.path""")
def metadata_lookup(t: Tables):
    co = t.co.select("id", trim_path("metadata_path", "/mnt/blobs").alias("metadata_path"))
    rows = metadata.metadata_lookup(co, t.metadata, {"metadata_path": "metadata"})
    return rows.select("id", F.md5("metadata").alias("content_md5"))


@query("metadata_null", "SELECT id, cast(NULL AS VARCHAR) AS metadata FROM {co}")
def metadata_null(t: Tables):
    return metadata.metadata_null(t.co.select("id"), ["metadata"])
