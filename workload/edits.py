"""Queries over projections, filters, edits and order."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattercat.operators import edits as E
from mattercat.operators import ordering as O

from .registry import Tables, query


@query("rename_prefixed", "SELECT id AS property_id, method AS property_method, dataset_id FROM {po}")
def rename_prefixed(t: Tables):
    return E.rename_prefixed(t.po.select("id", "method", "dataset_id"), "property", ["id", "method", "hash"])


@query("drop_columns", "SELECT id, name, score FROM {ds}")
def drop_columns(t: Tables):
    return E.drop_columns(t.ds, ["group_key", "not_there"])


@query("select_ordered", "SELECT method, id, multiplicity FROM {po}")
def select_ordered(t: Tables):
    return E.select_ordered(t.po, ["method", "id", "multiplicity"])


@query("typed_table", """
    SELECT c.id, p_name AS first_name, 3 AS n_names, cast(p_size % 3 AS DOUBLE) AS cell_00,
           p_partkey % 2 = 0 AS flag, c.nsites
    FROM part JOIN {co} c ON c.id = concat('CO_', lpad(cast(p_partkey AS string), 8, '0'))""")
def typed_table(t: Tables):
    schema = T.StructType.fromDDL(
        "names array<string>, cell array<array<double>>, flag_text array<boolean>, nsites int"
    )
    typed = E.typed_table(t.co, schema, "fail")
    return typed.select(
        "id", F.col("names")[0].alias("first_name"), F.size("names").alias("n_names"),
        F.col("cell")[0][0].alias("cell_00"), F.col("flag_text")[0].alias("flag"), "nsites",
    )


@query("filter_eq", "SELECT id FROM {po} WHERE method <> 'A'")
def filter_eq(t: Tables):
    return E.filter_eq(t.po, "method", "A", negate=True).select("id")


@query("filter_not_in", """
    SELECT id, metadata_path FROM {co} WHERE metadata_path NOT IN ('/mnt/blobs/MD/2', '/mnt/blobs/data/MD/3')""")
def filter_not_in(t: Tables):
    gone = ["/mnt/blobs/MD/2", "/mnt/blobs/data/MD/3"]
    return E.filter_not_in(t.co, "metadata_path", gone).select("id", "metadata_path")


@query("filter_member", """
    SELECT p_partkey AS key FROM part WHERE p_brand = 'Brand#1' OR p_name = 'Brand#1'""")
def filter_member(t: Tables):
    # Brand#1 is also the head of longer brand names.
    key = F.substring("id", 4, 8).cast("long").alias("key")
    return E.filter_member(t.co, "names", "Brand#1").select(key)


@query("filter_nonempty_list", "SELECT id, n FROM {sites} WHERE n > 3")
def filter_nonempty_list(t: Tables):
    text = F.when(F.col("n") > 3, F.concat(F.lit("["), "n", F.lit("]"))).when(F.col("n") > 1, "[]")
    return E.filter_nonempty_list(t.sites.withColumn("list", text), "list").select("id", "n")


@query("filter_sql", "SELECT id, multiplicity FROM {po} WHERE multiplicity > 10 AND method = 'R'")
def filter_sql(t: Tables):
    return E.filter_sql(t.po, "multiplicity > 10 AND method = 'R'").select("id", "multiplicity")


@query("update_where", """
    SELECT id, CASE WHEN method = 'A' AND multiplicity > 20 THEN 'DFT' ELSE method END AS method FROM {po}""")
def update_where(t: Tables):
    return E.update_where(t.po, "method = 'A' AND multiplicity > 20", "method", "DFT").select("id", "method")


@query("update_from_map", """
    SELECT d.id, coalesce(n.n_name, d.name) AS name
    FROM {ds} d LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON n.n_nationkey = d.group_key""")
def update_from_map(t: Tables):
    new = t.nation.filter("n_regionkey < 3").selectExpr("n_nationkey AS group_key", "n_name AS name")
    return E.update_from_map(t.ds, new, "group_key", "name").select("id", "name")


@query("update_computed", """
    SELECT id, CASE WHEN configuration_id IN (SELECT id FROM {co} WHERE nsites < 10)
                    THEN multiplicity * 2 ELSE multiplicity END AS multiplicity FROM {po}""")
def update_computed(t: Tables):
    ids = t.co.filter("nsites < 10").select(F.col("id").alias("configuration_id"))
    new = {"multiplicity": F.col("multiplicity") * 2}
    return E.update_computed(t.po, ids, "configuration_id", new).select("id", "multiplicity")


@query("delete_where", """
    SELECT id, energy_reference FROM {po} WHERE energy_reference IS NULL OR NOT energy_reference > 0.06""")
def delete_where(t: Tables):
    return E.delete_where(t.po, "energy_reference > 0.06").select("id", "energy_reference")


@query("add_column", "SELECT id, name, cast(NULL AS DOUBLE) AS energy_above_hull FROM {ds}")
def add_column(t: Tables):
    return E.add_column(t.ds, "energy_above_hull", "double").select("id", "name", "energy_above_hull")


@query("drop_table_column", "SELECT id, group_key, score FROM {ds}")
def drop_table_column(t: Tables):
    return E.drop_table_column(t.ds, "name")


@query("cast_timestamp", """
    SELECT id, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified FROM {po}""")
def cast_timestamp(t: Tables):
    rows = t.po.select("id", F.date_format("last_modified", "dd.MM.yyyy HH:mm").alias("last_modified"))
    rows = E.cast_timestamp(rows, "last_modified", "dd.MM.yyyy HH:mm")
    return rows.select("id", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"))


@query("stamp_modified", "SELECT id, true AS later, true AS whole_seconds FROM {ds}")
def stamp_modified(t: Tables):
    stamped = E.stamp_modified(t.ds)
    now = F.col("last_modified")
    return stamped.select(
        "id", (now > F.lit("2024-01-01").cast("timestamp")).alias("later"),
        (now == F.date_trunc("second", now)).alias("whole_seconds"),
    )


@query("set_multiplicity", """
    SELECT id, CASE WHEN dataset_id = 'DS_000003_0' THEN 1 ELSE multiplicity END AS multiplicity FROM {po}""")
def set_multiplicity(t: Tables):
    return E.set_multiplicity(t.po, "DS_000003_0", 1).select("id", "multiplicity")


@query("limit_rows_counted", """
    SELECT id, dataset_id, configuration_id, multiplicity FROM {po}
    ORDER BY id, dataset_id, configuration_id, multiplicity LIMIT 20000""")
def limit_rows_counted(t: Tables):
    # Ordered by all columns: rows that tie are equal.
    columns = ["id", "dataset_id", "configuration_id", "multiplicity"]
    return O.limit_rows(t.po.select(*columns), 20_000, columns)


@query("typed_table_with_account", """
    SELECT 'cell' AS kind, id, CASE WHEN nsites % 3 = 1 THEN 'x' || nsites END AS text, CASE WHEN nsites % 3 <> 1 THEN 3 END AS size FROM {co}
    UNION ALL SELECT 'lost', id, 'x' || nsites, NULL FROM {co} WHERE nsites % 3 = 1
    UNION ALL SELECT 'count', 'cell', count(*)::VARCHAR, NULL FROM {co} WHERE nsites % 3 = 1""")
def typed_table_with_account(t: Tables):
    # A third of the cells hold no list.
    text = "CASE WHEN nsites % 3 = 1 THEN concat('x', nsites) ELSE cell END"
    rows = t.co.selectExpr("id", f"{text} AS cell", f"{text} AS old")
    typed, lost, counts = E.typed_table_with_account(rows, T.StructType.fromDDL("cell array<array<double>>"))
    size = F.when(F.col("cell").isNotNull(), F.size("cell")).alias("size")
    kept = typed.select(F.lit("cell").alias("kind"), "id", F.when(F.col("cell").isNull(), F.col("old")).alias("text"), size)
    number = t.spark.range(1).select(
        F.lit("count").alias("kind"), F.lit("cell").alias("id"), F.lit(str(counts["cell"])).alias("text"), F.lit(None).cast("int").alias("size"))
    return kept.unionAll(lost.select(F.lit("lost").alias("kind"), "id", "text", F.lit(None).cast("int").alias("size"))).unionAll(number)


@query("limit_rows", "SELECT id, nsites FROM {co} ORDER BY id LIMIT 100")
def limit_rows(t: Tables):
    return O.limit_rows(t.co.select("id", "nsites"), 100, ["id"])


SIZES = """SELECT d.id, count(m.configuration_id) AS nconfigurations
           FROM {ds} d LEFT JOIN {member} m ON m.dataset_id = d.id GROUP BY d.id"""


@query("order_by", f"SELECT id, nconfigurations FROM ({SIZES}) ORDER BY nconfigurations")
def order_by(t: Tables):
    return O.order_by(t.sql(SIZES), "nconfigurations")


@query("nth_by_size", f"SELECT id, nconfigurations FROM ({SIZES}) ORDER BY nconfigurations, id LIMIT 1 OFFSET 7")
def nth_by_size(t: Tables):
    return O.nth_by_size(t.sql(SIZES), 7)


@query("first_row", "SELECT id, multiplicity FROM {po} ORDER BY id, multiplicity LIMIT 1")
def first_row(t: Tables):
    return O.first_row(t.po.select("id", "multiplicity"), ["id", "multiplicity"])


@query("reverse_order", "SELECT id, score FROM {ds} ORDER BY score DESC, id DESC")
def reverse_order(t: Tables):
    return O.reverse_order(t.ds.select("id", "score"), ["score", "id"])
