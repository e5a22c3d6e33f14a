"""Queries over joins and set operations."""

from pyspark.sql import functions as F

from mattercat.operators import joins as J
from mattercat.operators import sets as S

from .registry import Tables, query

MERGE_COLUMNS = [
    "property_id", "dataset_id", "multiplicity", "method", "configuration_id", "nsites", "names",
    "cell", "configuration_metadata_path",
]


@query("merge_po_co", """
    SELECT p.id AS property_id, p.dataset_id, p.multiplicity, p.method, p.configuration_id,
           c.nsites, c.names, c.cell, c.metadata_path AS configuration_metadata_path
    FROM {po} p JOIN {co} c ON c.id = p.configuration_id""")
def merge_po_co(t: Tables):
    return J.merge_po_co(t.po.drop("last_modified"), t.co, MERGE_COLUMNS)


@query("flatten_po_co", """
    SELECT p.id AS property_object_id, p.configuration_id, p.method, c.nsites, c.names AS configuration_names
    FROM {po} p LEFT JOIN (SELECT * FROM {co} WHERE nsites > 25) c ON c.id = p.configuration_id""")
def flatten_po_co(t: Tables):
    rows = J.flatten_po_co(t.po, t.co.filter("nsites > 25"))
    return rows.select("property_object_id", "configuration_id", "method", "nsites", "configuration_names")


@query("attach_dataset", """
    SELECT p.id, p.dataset_id, d.name AS dataset_name, d.score AS dataset_score
    FROM {po} p LEFT JOIN (SELECT * FROM {ds} WHERE group_key < 12) d ON d.id = p.dataset_id""")
def attach_dataset(t: Tables):
    rows = J.attach_dataset(t.po.select("id", "dataset_id"), t.ds.filter("group_key < 12"), ["name", "score"])
    return rows.select("id", "dataset_id", "dataset_name", "dataset_score")


@query("attach_nsites", """
    SELECT p.id, p.configuration_id, c.nsites FROM {po} p LEFT JOIN {co} c ON c.id = p.configuration_id""")
def attach_nsites(t: Tables):
    return J.attach_nsites(t.po.select("id", "configuration_id"), t.co).select("id", "configuration_id", "nsites")


@query("attach_stats", """
    SELECT d.id, d.name, s.nproperty_objects
    FROM (SELECT id, name FROM {ds} UNION ALL SELECT id, name FROM {cs}) d
    LEFT JOIN (SELECT dataset_id, count(*) AS nproperty_objects FROM {po} GROUP BY dataset_id) s
    ON s.dataset_id = d.id""")
def attach_stats(t: Tables):
    # Sets stand in for datasets without rows.
    datasets = t.ds.select("id", "name").unionByName(t.cs)
    stats = t.po.groupBy("dataset_id").agg(F.count("*").alias("nproperty_objects"))
    return J.attach_stats(datasets, stats).select("id", "name", "nproperty_objects")


@query("rows_for_duplicates", """
    SELECT id, configuration_id FROM {po} WHERE id IN (SELECT id FROM {po} GROUP BY id HAVING count(*) > 1)""")
def rows_for_duplicates(t: Tables):
    dups = t.po.groupBy("id").count().filter("count > 1")
    return J.rows_for_duplicates(t.po.select("id", "configuration_id"), dups)


@query("sets_to_map", """
    SELECT configuration_set_id, configuration_id FROM {cs_co_map}
    WHERE configuration_set_id IN (SELECT id FROM {cs} WHERE name LIKE 'Brand#1%')""")
def sets_to_map(t: Tables):
    return J.sets_to_map(t.cs_co_map, t.cs.filter("name LIKE 'Brand#1%'"))


@query("has_sets", """
    SELECT id, id IN (SELECT dataset_id FROM {cs_owned}) AS has_sets FROM {ds}""")
def has_sets(t: Tables):
    return J.has_sets(t.ds, t.cs_owned)


@query("remap_ids", """
    SELECT concat('CO_new_', substr(id, 4)) AS id, concat('h', substr(id, 4)) AS hash, nsites
    FROM {co} WHERE nsites < 20""")
def remap_ids(t: Tables):
    new = t.co.filter("nsites < 20").selectExpr(
        "id", "concat('CO_new_', substr(id, 4)) AS new_id", "concat('h', substr(id, 4)) AS new_hash"
    )
    return J.remap_ids(t.co.select("id", "nsites"), new, {"id": "new_id", "hash": "new_hash"})


@query("remap_foreign_key", """
    SELECT p.id, concat('CO_new_', substr(p.configuration_id, 4)) AS configuration_id
    FROM {po} p JOIN {co} c ON c.id = p.configuration_id WHERE c.nsites < 20""")
def remap_foreign_key(t: Tables):
    new = t.co.filter("nsites < 20").selectExpr("id", "concat('CO_new_', substr(id, 4)) AS new_id")
    return J.remap_foreign_key(t.po.select("id", "configuration_id"), new)


@query("collapse_maps", """
    WITH s AS (SELECT substr(id, 4) AS x, nsites FROM {co})
    SELECT concat('CO_', x) AS id, concat(CASE WHEN nsites < 10 THEN 'N3_' WHEN nsites < 20 THEN 'N2_' ELSE 'N1_' END, x) AS new_id FROM s
    UNION ALL SELECT concat('N1_', x), concat(CASE WHEN nsites < 10 THEN 'N3_' ELSE 'N2_' END, x) FROM s WHERE nsites < 20
    UNION ALL SELECT concat('N2_', x), concat('N3_', x) FROM s WHERE nsites < 10""")
def collapse_maps(t: Tables):
    # Ids were changed three times, each time for fewer structures.
    step = lambda old, new, below: t.co.filter(f"nsites < {below}").selectExpr(
        f"concat('{old}_', substr(id, 4)) AS id", f"concat('{new}_', substr(id, 4)) AS new_id")
    return J.collapse_maps(step("N2", "N3", 10), step("CO", "N1", 1_000_000), step("N1", "N2", 20))


@query("anti_missing_children", """
    SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def anti_missing_children(t: Tables):
    return J.anti_missing_children(t.orders.select("o_orderkey"), t.lineitem, "l_orderkey", key="o_orderkey")


@query("anti_orphans", """
    SELECT id, dataset_id FROM {po}
    WHERE dataset_id NOT IN (SELECT id FROM {ds} WHERE score > 3000)""")
def anti_orphans(t: Tables):
    return J.anti_orphans(t.po.select("id", "dataset_id"), t.ds.filter("score > 3000"), "dataset_id")


@query("copy_closure", """
    WITH chosen AS (SELECT * FROM {po} WHERE dataset_id IN (SELECT id FROM {ds} WHERE group_key = 3))
    SELECT 'po' AS kind, id FROM chosen
    UNION ALL
    SELECT 'co' AS kind, id FROM {co}
    WHERE id IN (SELECT configuration_id FROM chosen) AND NOT nsites < 10""")
def copy_closure(t: Tables):
    po, co = J.copy_closure(t.ds.filter("group_key = 3").select("id"), t.po, t.co, t.co.filter("nsites < 10"))
    return po.select(F.lit("po").alias("kind"), "id").unionAll(co.select(F.lit("co").alias("kind"), "id"))


@query("anti_already_done", "SELECT id, name FROM {ds} WHERE id NOT IN (SELECT id FROM {ds} WHERE score > 0)")
def anti_already_done(t: Tables):
    return J.anti_already_done(t.ds.select("id", "name"), t.ds.filter("score > 0"), "id")


@query("ids_minus", """
    SELECT configuration_id AS id FROM {po} EXCEPT SELECT id FROM {co} WHERE nsites < 15""")
def ids_minus(t: Tables):
    needed = t.po.select(F.col("configuration_id").alias("id"))
    return S.ids_minus(needed, t.co.filter("nsites < 15").select("id"))


@query("append_rows", """
    SELECT id, name FROM {ds} UNION ALL SELECT id, name FROM {cs} UNION ALL SELECT id, label AS name FROM {co}""")
def append_rows(t: Tables):
    return S.append_rows(
        t.ds.select("id", "name"), t.cs.select("name", "id"), t.co.selectExpr("label AS name", "id")
    )


@query("distinct_ids", "SELECT DISTINCT configuration_id FROM {po}")
def distinct_ids(t: Tables):
    return S.distinct_ids(t.po, "configuration_id")


@query("distinct_paths", """
    SELECT DISTINCT path FROM (SELECT metadata_path AS path FROM {co}
                               UNION ALL SELECT replace(metadata_path, '/data/', '/') AS path FROM {co})
    WHERE path IS NOT NULL""")
def distinct_paths(t: Tables):
    rows = t.co.withColumn("other_path", F.replace("metadata_path", F.lit("/data/"), F.lit("/")))
    return S.distinct_paths(rows, ["metadata_path", "other_path"])
