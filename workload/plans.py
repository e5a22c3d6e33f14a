"""Queries over composed jobs."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattercat.functions.lists import parse_list
from mattercat.operators import digests
from mattercat.operators.joins import merge_po_co
from mattercat.plans import curate, publish
from mattercat.plans.rehash import fix_pbc_and_rehash as rehash
from mattercat.plans.standardize import Layout
from mattercat.plans.standardize import standardize_properties as standardize
from mattercat.sinks import tables as W

from .aggregates import COUNTS, TIE, listed, picked, rounded
from .columns import DATASET_LISTS, converted
from .registry import Tables, query
from .sinks import LEVEL, described, read_folders

LAYOUT = Layout(
    energies=["free_energy", "potential_energy"],
    references={"free_energy": "energy_reference", "potential_energy": "energy_reference"},
    per_atom={"free_energy": "energy_per_atom", "potential_energy": "energy_per_atom"},
    units={c: "energy_unit" for c in ("free_energy", "potential_energy", "energy_reference")},
    arrays={}, null_datasets=("DS_000001_0",),
    hash_columns=["configuration_id", "dataset_id", "energy", "formation_energy", "method"],
)

# Energy of the view in eV with its reference, as a total, free energy first.
STANDARD = f"""
    SELECT p.dataset_id, coalesce(free, potential) * CASE WHEN energy_per_atom THEN c.nsites ELSE 1 END AS energy,
           formation_energy
    FROM (SELECT *, {converted('free_energy')} + ref AS free, {converted('potential_energy')} + ref AS potential
          FROM (SELECT *, CASE WHEN dataset_id = 'DS_000001_0' THEN 0
                               ELSE coalesce({converted('energy_reference')}, 0) END AS ref FROM {{po}})) p
    JOIN {{co}} c ON c.id = p.configuration_id"""


@query("standardize_properties", f"""
    SELECT d.id, d.name, {COUNTS}, s.energy_mean
    FROM {{ds}} d LEFT JOIN (
        SELECT dataset_id, count(energy) AS energy_count, count(formation_energy) AS formation_energy_count,
               count(*) AS nproperty_objects, round(avg(energy), 2) AS energy_mean
        FROM ({STANDARD}) GROUP BY dataset_id) s ON s.dataset_id = d.id""")
def standardize_properties(t: Tables):
    _, datasets = standardize(t.po, t.co, t.ds, LAYOUT)
    return rounded(datasets, "energy_mean", digits=2).select(
        "id", "name", "energy_count", "formation_energy_count", "nproperty_objects", "energy_mean"
    )


@query("standardize_properties_rows", f"""
    SELECT dataset_id, count(*) AS n, round(avg(energy), 2) AS energy_mean, count(*) AS with_id
    FROM ({STANDARD}) GROUP BY dataset_id""")
def standardize_properties_rows(t: Tables):
    properties, _ = standardize(t.po, t.co, t.ds, LAYOUT)
    return rounded(
        properties.groupBy("dataset_id").agg(
            F.count("*").alias("n"), F.avg("energy").alias("energy_mean"),
            F.count_if(F.col("id").rlike("^PO_[0-9]{25}$")).alias("with_id"),
        ), "energy_mean", digits=2,
    )


def structures(t: Tables) -> DataFrame:
    """``co`` with typed lists, sites along x, and periodicity that is still to be corrected."""
    return t.co.select(
        "id", F.lit("old").alias("hash"), "nsites", parse_list("cell", "array<double>").alias("cell"),
        F.array_repeat(F.lit(False), 3).alias("pbc"), F.lit("old").alias("structure_hash"),
        F.expr("transform(sequence(1, nsites), i -> array(cast(i AS double), 0D, 0D))").alias("positions"),
        F.expr("transform(sequence(1, nsites), i -> 6)").alias("atomic_numbers"),
        F.concat(F.lit("MD_"), "id").alias("metadata_id"),
    )


@query("fix_pbc_and_rehash", """
    SELECT p.dataset_id, count(*) AS n, count(DISTINCT p.configuration_id) AS structures,
           count_if(NOT starts_with(c.cell, '[[0.0'))::BIGINT AS periodic
    FROM {po} p JOIN {co} c ON c.id = p.configuration_id GROUP BY p.dataset_id""")
def fix_pbc_and_rehash(t: Tables):
    co, po, _ = rehash(structures(t), t.po, po_hash_columns=["configuration_id", "dataset_id", "formation_energy", "method"])
    moved = po.join(co.select(F.col("id").alias("configuration_id"), "pbc"), "configuration_id")
    # Most pairs of dataset and structure occur once: they are brought together and then counted, so that
    # no task holds those of a whole input split.
    pairs = moved.select("dataset_id", "configuration_id", F.col("pbc")[0].alias("periodic")).repartition("dataset_id", "configuration_id")
    counted = pairs.groupBy("dataset_id", "configuration_id").agg(F.count("*").alias("n"), F.count_if("periodic").alias("periodic"))
    return counted.groupBy("dataset_id").agg(
        F.sum("n").alias("n"), F.count("configuration_id").alias("structures"), F.sum("periodic").alias("periodic"),
    )


@query("repair_duplicates", f"""
    SELECT id, string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) AS dataset_ids,
           CASE WHEN count(*) = 1 THEN concat(first(configuration_id), ',', first(method))
                ELSE array_to_string(list_sort(list_distinct(list_concat(list(configuration_id), list(method)))), ',') END AS names,
           {picked('DESC')}
    FROM {{po}} GROUP BY id""")
def repair_duplicates(t: Tables):
    repaired = curate.repair_duplicates(listed(t), ["dataset_ids", "names"], tie=F.expr(TIE))
    return repaired.select(
        "id", F.array_join("dataset_ids", ",").alias("dataset_ids"), F.array_join("names", ",").alias("names"),
        "method", "multiplicity", "formation_energy",
    )


@query("build_set_map", """
    SELECT concat('CS_', s) AS configuration_set_id, id AS configuration_id
    FROM (SELECT concat('CO_', lpad(cast(p_partkey AS string), 8, '0')) AS id,
                 unnest(CASE WHEN p_size % 3 = 0 THEN [p_brand, p_type] WHEN p_size % 3 = 1 THEN [p_brand] END) AS s
          FROM part)""")
def build_set_map(t: Tables):
    sets = """CASE WHEN p_size % 3 = 0 THEN concat("['CS_", p_brand, "', 'CS_", p_type, "']")
                   WHEN p_size % 3 = 1 THEN concat("['CS_", p_brand, "']") ELSE '[]' END AS configuration_set_ids"""
    co = t.part.selectExpr("concat('CO_', lpad(cast(p_partkey AS string), 8, '0')) AS id", sets)
    return curate.build_set_map(co)


@query("build_arrays", """
    SELECT p.id AS property_id, p.multiplicity, c.nsites, cast(c.nsites % 3 AS DOUBLE) AS cell_00, 3 AS n_names
    FROM {po} p JOIN {co} c ON c.id = p.configuration_id""")
def build_arrays(t: Tables):
    schema = T.StructType.fromDDL(
        "property_id string, multiplicity int, nsites int, cell array<array<double>>, names array<string>"
    )
    name, path = t.fresh_name("arrays"), t.fresh("arrays")
    W.create_or_append(curate.build_arrays(t.po.drop("last_modified"), t.co, schema), name, path)
    return t.spark.table(name).select(
        "property_id", "multiplicity", "nsites", F.col("cell")[0][0].alias("cell_00"),
        F.size("names").alias("n_names"),
    )


def counts(gone: str) -> str:
    """SQL: rows of each table before and after datasets ``gone`` are removed."""
    tables = {
        "ds": ("{ds}", f"id NOT IN ({gone})"), "po": ("{po}", f"dataset_id NOT IN ({gone})"),
        "co": ("(SELECT DISTINCT configuration_id AS id FROM {member})",
               f"id IN (SELECT configuration_id FROM {{member}} WHERE dataset_id NOT IN ({gone}))"),
        "cs": ("{cs_owned}", f"dataset_id NOT IN ({gone})"),
        "cs_co_map": ("{cs_co_map}", "configuration_set_id NOT IN "
                      f"(SELECT id FROM {{cs_owned}} WHERE dataset_id IN ({gone}))"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS before, count_if({keep})::BIGINT AS after, "
        f"count_if(NOT {keep})::BIGINT AS difference FROM {source}"
        for name, (source, keep) in tables.items()
    )


GONE = ["DS_000000_0", "DS_000002_0", "DS_000003_0"]


@query("purge_datasets", counts(", ".join(f"'{g}'" for g in GONE)))
def purge_datasets(t: Tables):
    tables = {
        "ds": t.ds, "po": t.po, "co": t.sql(DATASET_LISTS), "cs": t.cs_owned, "cs_co_map": t.cs_co_map
    }
    _, audit = curate.purge_datasets(tables, GONE)
    return audit


@query("release", """
    SELECT 'po' AS "table", w.prefix, coalesce(f.n, 0) AS count
    FROM (SELECT concat('PO_', lpad(cast(i AS string), 3, '0')) AS prefix FROM range(0, 1000) r(i)) w
    LEFT JOIN (SELECT substr(id, 1, 6) AS prefix, count(*) AS n FROM {po} GROUP BY 1) f ON f.prefix = w.prefix
    UNION ALL SELECT 'po_by_dataset', dataset_id, count(*) FROM {po} GROUP BY dataset_id
    UNION ALL SELECT 'po_by_configuration', configuration_id, count(*) FROM {po} GROUP BY configuration_id
    UNION ALL SELECT 'cs_by_dataset', dataset_id, count(*) FROM {cs_owned} GROUP BY dataset_id
    UNION ALL SELECT 'cs_co_map_by_set', configuration_set_id, count(*) FROM {cs_co_map} GROUP BY configuration_set_id
    UNION ALL SELECT 'ds_by_id', id, count(*) FROM {ds} GROUP BY id
    UNION ALL SELECT 'co_by_id', id, count(*) FROM {co} GROUP BY id""")
def release(t: Tables):
    # Source tables, and a schema of their own to publish in.
    schema = t.fresh_name("release")
    t.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{t.fresh('release')}'")
    current = t.spark.catalog.currentDatabase()
    try:
        t.spark.catalog.setCurrentDatabase(schema)
        sources = {}
        for name in W.TABLES:
            W.save_table(t.cs_owned if name == "cs" else getattr(t, name), f"source_{name}")
            sources[name] = f"source_{name}"
        # ids of the view start at 00000000, not at 100
        counts = publish.release(t.spark, sources, "20240131", heads={"po": "PO_"}, prefixes=(0, 999))["po"]
        found = [counts.select(F.lit("po").alias("table"), "prefix", "count")]
        for name, _, keys in publish.CLUSTERED:
            rows = t.spark.table(f"{schema}.{name}")
            found.append(rows.groupBy(F.col(keys[0]).alias("prefix")).agg(F.count("*").alias("count")).select(
                F.lit(name).alias("table"), "prefix", "count"))
        return reduce(DataFrame.unionAll, found)
    finally:
        t.spark.catalog.setCurrentDatabase(current)


CHANGED = """
    SELECT id, configuration_id, CASE WHEN {hit} AND multiplicity = 7 THEN 'Z' ELSE method END AS method, multiplicity
    FROM {{po}} WHERE NOT ({hit} AND multiplicity = 9)"""


@query("changed_ids", """
    WITH old AS (SELECT id, configuration_id, method, multiplicity FROM {po}), new AS (%s UNION ALL SELECT 'PO_new', 'CO_new', 'N', 1),
    other AS (SELECT id FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new) UNION SELECT id FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old))
    SELECT o.id, (SELECT count(*) FROM old WHERE old.id = o.id) AS n_before, (SELECT count(*) FROM new WHERE new.id = o.id) AS n_after
    FROM other o""" % CHANGED.format(hit="id LIKE 'PO_000000%'"))
def changed_ids(t: Tables):
    old = t.po.select("id", "configuration_id", "method", "multiplicity")
    new = t.sql(CHANGED.format(hit="id LIKE 'PO_000000%'") + " UNION ALL SELECT 'PO_new', 'CO_new', 'N', 1")
    return digests.changed_ids(old, new, lengths=(0, 8, 10))


@query("export", """
    SELECT 'po' AS kind, p.dataset_id, p.id, md5(m.content) AS content
    FROM {po} p LEFT JOIN {metadata} m ON m.path = concat('data/MD/', cast(p.multiplicity AS VARCHAR))
    UNION ALL SELECT 'ds', id, id, md5(concat('Data of ', name)) FROM {ds}
    UNION ALL SELECT 'co', m.dataset_id, m.configuration_id, md5(concat(cast(c.nsites % 3 AS VARCHAR), '.0'))
    FROM {member} m JOIN {co} c ON c.id = m.configuration_id
    UNION ALL SELECT 'cs', dataset_id, id, NULL FROM {cs_owned}
    UNION ALL SELECT 'cs_co_map', o.dataset_id, m.configuration_id, NULL
    FROM {cs_co_map} m JOIN {cs_owned} o ON o.id = m.configuration_set_id""")
def export(t: Tables):
    path = t.fresh("export")
    po = t.po.select(
        "id", "dataset_id", "configuration_id", "multiplicity",
        F.concat(F.lit("data/MD/"), "multiplicity").alias("metadata_path"),
    )
    tables = {
        "ds": described(t), "po": po, "co": t.co.select("id", "names", "cell").join(t.sql(DATASET_LISTS), "id"),
        "cs": t.cs_owned, "cs_co_map": t.cs_co_map,
    }
    publish.export(tables, path, "Site", "https://site.example", t.metadata, LEVEL)
    content = {"po": F.md5("metadata"), "ds": F.md5("description"), "co": F.md5(F.col("cell")[0][0].cast("string"))}
    return named_in_cards(t, path, content)


def named_in_cards(t: Tables, path: str, content: dict) -> DataFrame:
    """``(kind, dataset_id, id, content)`` of all files that the cards of an export point to."""
    cards = read_folders(t, f"{path}/dataset=*/kind=card", "text", wholetext=True)
    globs = cards.select(F.explode(F.regexp_extract_all("value", F.lit('data_files: "([^"]+)"'), 1)).alias("g")).distinct()
    keys = {"cs_co_map": "configuration_id", "merged": "property_id"}
    found = []
    for row in globs.orderBy("g").collect():
        kind = row["g"].split("/")[0].removeprefix("kind=")
        found.append(read_folders(t, f"{path}/dataset=*/{row['g']}").select(
            F.lit(kind).alias("kind"), "dataset_id", F.col(keys.get(kind, "id")).alias("id"),
            content.get(kind, F.lit(None).cast("string")).alias("content")))
    return reduce(DataFrame.unionAll, found)


@query("export_merged", """
    SELECT 'merged' AS kind, p.dataset_id, p.id, md5(concat_ws('|', coalesce(a.content, ''), coalesce(b.content, ''),
           p_name, cast(c.nsites AS VARCHAR))) AS content
    FROM {po} p JOIN {co} c ON c.id = p.configuration_id
    JOIN (SELECT concat('CO_', lpad(cast(p_partkey AS VARCHAR), 8, '0')) AS id, p_name FROM part) n ON n.id = c.id
    LEFT JOIN {metadata} a ON a.path = concat('data/MD/', cast(p.multiplicity AS VARCHAR))
    LEFT JOIN {metadata} b ON b.path = concat('data/MD/', cast(c.nsites AS VARCHAR))
    UNION ALL SELECT 'ds', id, id, md5(concat('Data of ', name)) FROM {ds}
    UNION ALL SELECT 'cs', dataset_id, id, NULL FROM {cs_owned}""")
def export_merged(t: Tables):
    path = t.fresh("export-merged")
    po = t.po.select(
        "id", F.lit("h").alias("hash"), "dataset_id", "configuration_id", "multiplicity",
        F.concat(F.lit("data/MD/"), "multiplicity").alias("metadata_path"))
    co = t.co.select("id", F.lit("h").alias("hash"), "names", "nsites", F.concat(F.lit("data/MD/"), "nsites").alias("metadata_path"))
    columns = ["property_id", "dataset_id", "configuration_id", "multiplicity", "names", "nsites",
               "property_metadata_path", "configuration_metadata_path"]
    tables = {"ds": described(t), "merged": merge_po_co(po, co, columns), "cs": t.cs_owned}
    publish.export(tables, path, "Site", "https://site.example", t.metadata, LEVEL)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    merged = F.md5(F.concat_ws("|", blank("property_metadata"), blank("configuration_metadata"), F.col("names")[0], F.col("nsites").cast("string")))
    return named_in_cards(t, path, {"merged": merged, "ds": F.md5("description")})
