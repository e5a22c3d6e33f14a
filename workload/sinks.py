"""Queries that write, read back and return what was read.

Everything is written below the shared folder of the session.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattercat.operators.aggregates import recreate_datasets
from mattercat.session import setting
from mattercat.sinks import cards as C
from mattercat.sinks import exports as X
from mattercat.sinks import tables as W
from mattercat.streaming.incremental import incremental_copy as copy_new

from .aggregates import with_energy
from .columns import LICENSES, MATRIX, STORED, pick
from .registry import Tables, query


# What is read back does not depend on how hard the files are packed.
LEVEL = 3


def read_folders(t: Tables, path: str, format: str = "parquet", **options) -> DataFrame:
    """The files below a folder per dataset, listed by some tasks and not by one for each folder.

    The folders' names are not made a column: for that the driver alone takes steps in the square of the number
    of folders. ``folder_value`` reads a name where files lack the value.
    """
    with setting(t.spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", "64"):
        return t.spark.read.format(format).options(recursiveFileLookup=True, **options).load(path)


def folder_value(name: str) -> Column:
    """The value of the folder ``name=value`` above a row's file, as text; null for the folder of null."""
    value = F.substring_index(F.substring_index("_metadata.file_path", f"/{name}=", -1), "/", 1)
    # Escaped once as a folder's name and once more as part of a path; a plus is no blank here.
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.nullif(F.when(F.contains(value, F.lit("%")), plain(plain(value))).otherwise(value), F.lit("__HIVE_DEFAULT_PARTITION__"))


def narrow_po(t: Tables) -> DataFrame:
    return t.po.select("id", "dataset_id", "configuration_id", "multiplicity")


NARROW = "SELECT id, dataset_id, configuration_id, multiplicity FROM {po}"


@query("copy_table", "SELECT * FROM part")
def copy_table(t: Tables):
    name = t.fresh_name("copied")
    W.copy_table(t.spark, f"{t.folder}/part.parquet", name, path=t.fresh("copied"))
    return t.spark.table(name)


@query("save_table", "SELECT id, dataset_id, configuration_id, multiplicity FROM {po} UNION ALL "
                     "SELECT id, id, id, 0 FROM {ds}")
def save_table(t: Tables):
    name = t.fresh_name("saved")
    W.save_table(narrow_po(t), name, "errorifexists", path=t.fresh("saved"))
    W.save_table(t.ds.selectExpr("id", "id AS dataset_id", "id AS configuration_id", "0 AS multiplicity"), name, "append")
    return t.spark.table(name)


@query("align_schema", """
    SELECT cast(multiplicity AS BIGINT) AS multiplicity, id, cast(NULL AS VARCHAR) AS software FROM {po}""")
def align_schema(t: Tables):
    schema = T.StructType.fromDDL("multiplicity long, id string, software string")
    return W.align_schema(t.po.select("id", "multiplicity"), schema)


@query("export_dataset_parquet", NARROW + " WHERE dataset_id = 'DS_000005_0'")
def export_dataset_parquet(t: Tables):
    path = t.fresh("one-dataset")
    X.export_dataset_parquet(narrow_po(t).filter("dataset_id = 'DS_000005_0'"), path, max_rows=100, level=LEVEL)
    return t.spark.read.parquet(path)


@query("export_all_datasets", NARROW)
def export_all_datasets(t: Tables):
    path = t.fresh("all-datasets")
    X.export_all_datasets(narrow_po(t), path, level=LEVEL)
    return read_folders(t, path)


@query("export_bundle", """
    SELECT 'ds' AS kind, id AS dataset_id, id FROM {ds}
    UNION ALL SELECT 'po', dataset_id, id FROM {po}
    UNION ALL SELECT 'co', dataset_id, configuration_id FROM {member}
    UNION ALL SELECT 'cs', dataset_id, id FROM {cs_owned}
    UNION ALL SELECT 'cs_co_map', o.dataset_id, m.configuration_id
    FROM {cs_co_map} m JOIN {cs_owned} o ON o.id = m.configuration_set_id""")
def export_bundle(t: Tables):
    path = t.fresh("bundle")
    members = t.member.groupBy(F.col("configuration_id").alias("id")).agg(
        F.collect_set("dataset_id").alias("dataset_ids")
    )
    tables = {
        "ds": t.ds, "po": narrow_po(t),
        "co": t.co.join(members, "id"), "cs": t.cs_owned, "cs_co_map": t.cs_co_map,
    }
    X.export_bundle(tables, path, level=LEVEL)
    # Every file holds the dataset it belongs to, besides the name of its folder.
    found = [
        read_folders(t, f"{path}/dataset=*/kind={kind}").select(
            F.lit(kind).alias("kind"), "dataset_id", F.col("configuration_id" if kind == "cs_co_map" else "id").alias("id"))
        for kind in ("ds", "po", "co", "cs", "cs_co_map")
    ]
    return reduce(DataFrame.unionAll, found)


@query("export_resumable", NARROW)
def export_resumable(t: Tables):
    # A first run that got only some datasets done, then the run that completes it.
    path = t.fresh("resumable")
    X.export_resumable(narrow_po(t).filter("dataset_id < 'DS_000050_0'"), path, level=LEVEL)
    X.export_resumable(narrow_po(t), path, level=LEVEL, group_rows=20_000)
    return read_folders(t, path)


@query("size_partitions", "SELECT id, dataset_id, configuration_id, multiplicity FROM {po}")
def size_partitions(t: Tables):
    # Sizes come from the dataset rows; the rows themselves are not counted.
    path = t.fresh("sized")
    sizes = recreate_datasets(t.ds, with_energy(t)).select("id", "nproperty_objects")
    X.export_all_datasets(narrow_po(t), path, level=LEVEL, sizes=sizes, rows_per_task=5_000)
    return read_folders(t, path)


@query("export_flat_parquet", """
    SELECT p.id AS property_object_id, p.configuration_id, p.dataset_id, d.name AS dataset_name, c.nsites,
           c.names AS configuration_names, p.multiplicity, p.method
    FROM {po} p LEFT JOIN {co} c ON c.id = p.configuration_id LEFT JOIN {ds} d ON d.id = p.dataset_id""")
def export_flat_parquet(t: Tables):
    path = t.fresh("flat")
    X.export_flat_parquet(t.po, t.co, t.ds, path)
    return t.spark.read.parquet(path).select(
        "property_object_id", "configuration_id", "dataset_id", "dataset_name", "nsites", "configuration_names",
        "multiplicity", "method",
    )


@query("export_dataset_json", """
    SELECT dataset_id AS id, strftime(max(last_modified), '%Y-%m-%dT%H:%M:%SZ') AS last_modified,
           count(*) AS nproperty_objects FROM {po} GROUP BY dataset_id""")
def export_dataset_json(t: Tables):
    path = t.fresh("json")
    stats = t.po.groupBy(F.col("dataset_id").alias("id")).agg(
        F.max("last_modified").alias("last_modified"), F.count("*").alias("nproperty_objects")
    )
    X.export_dataset_json(stats, path)
    return t.spark.read.schema("id string, last_modified string, nproperty_objects long").json(path)


@query("export_counts_csv", "SELECT method, count(*) AS n FROM {po} GROUP BY method")
def export_counts_csv(t: Tables):
    path = t.fresh("counts")
    W.export_counts_csv(t.po.groupBy("method").agg(F.count("*").alias("n")), path)
    return t.spark.read.schema("method string, n long").option("header", True).csv(path)


@query("export_text_list", "SELECT metadata_path AS value FROM {co} WHERE metadata_path IS NOT NULL")
def export_text_list(t: Tables):
    path = t.fresh("text-list")
    W.export_text_list(t.co, "metadata_path", path)
    return t.spark.read.text(path)


FRAME = """concat(cast(n AS VARCHAR), chr(10), 'Lattice="1.0 0.0 0.0 0.0 1.0 0.0 0.0 0.0 1.0" ',
    'Properties=species:S:1:pos:R:3:forces:R:3 dataset_id=', dataset_id, ' pbc="T F T"', chr(10),
    array_to_string([printf('%-2s %16.8f %16.8f %16.8f %16.8f %16.8f %16.8f',
                     (['H', 'He', 'Li', 'Be', 'B', 'C', 'N'])[i], q * i, d, t, q * i, d, t)
                     for i in range(1, n + 1)], chr(10)))"""


@query("export_extxyz", f"""
    SELECT dataset_id, line, count(*) AS n
    FROM (SELECT dataset_id, unnest(string_split({FRAME}, chr(10))) AS line FROM {{sites}})
    GROUP BY dataset_id, line""")
def export_extxyz(t: Tables):
    path = t.fresh("extxyz")
    rows = t.sites.selectExpr(
        "dataset_id", MATRIX.replace("AS matrix", "AS positions"), "sequence(1, n) AS atomic_numbers",
        "array(array(1D, 0D, 0D), array(0D, 1D, 0D), array(0D, 0D, 1D)) AS cell",
        "array(true, false, true) AS pbc", MATRIX.replace("AS matrix", "AS atomic_forces"),
        "cast(NULL AS double) AS energy",
    )
    X.export_extxyz(rows, path)
    lines = read_folders(t, path, "text").withColumn("dataset_id", folder_value("dataset_id"))
    return lines.groupBy("dataset_id", F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("write_clustered", "SELECT dataset_id, id, multiplicity FROM {po}")
def write_clustered(t: Tables):
    name = t.fresh_name("clustered")
    W.write_clustered(t.po, name, ["dataset_id"], ["id", "multiplicity"], path=t.fresh("clustered"))
    return t.spark.table(name)


@query("publish_swap", """
    SELECT 'new' AS version, id, nsites FROM {co} WHERE nsites > 10 UNION ALL SELECT 'old', id, nsites FROM {co}""")
def publish_swap(t: Tables):
    name = t.fresh_name("published")
    rows = t.co.select("id", "nsites")
    W.save_table(rows, name, path=t.fresh("published"))
    W.save_table(rows.filter("nsites > 10"), f"{name}_tmp", path=t.fresh("published"))
    W.publish_swap(t.spark, "20240131", [name])
    new, old = t.spark.table(name), t.spark.table(f"{name}_20240131")
    return new.select(F.lit("new").alias("version"), "*").unionAll(old.select(F.lit("old").alias("version"), "*"))


@query("table_exists", "SELECT id, name FROM {ds} UNION ALL SELECT id, name FROM {cs}")
def table_exists(t: Tables):
    # Created by the first batch, appended to by the second.
    name = t.fresh_name("appended")
    W.create_or_append(t.ds.select("id", "name"), name, path=t.fresh("appended"))
    W.create_or_append(t.cs.select("id", "name"), name, path=t.fresh("appended"))
    return t.spark.table(name)


def described(t: Tables) -> DataFrame:
    """``ds`` with what a card shows."""
    sizes = t.po.groupBy("dataset_id").agg(
        F.count("*").alias("nproperty_objects"), F.count("formation_energy").alias("formation_energy_count"),
        F.count("energy_reference").alias("energy_count"),
    )
    return t.ds.join(sizes.withColumnRenamed("dataset_id", "id"), "id", "left").select(
        "id", "name", F.lit("['Ludwig van der Berg', 'Sam Ring']").alias("authors"),
        F.concat(F.lit("Data of "), "name").alias("description"), F.lit("['C', 'H']").alias("elements"),
        F.col("nproperty_objects").alias("nconfigurations"), F.col("nproperty_objects").alias("nsites"),
        F.coalesce("energy_count", F.lit(0)).alias("energy_count"),
        F.coalesce("formation_energy_count", F.lit(0)).alias("formation_energy_count"),
        F.expr(pick(STORED, "group_key")).alias("license"),
        F.concat(F.lit("{'source-publication': 'https://doi.org/"), "group_key", F.lit("', 'source-data': None}")).alias("links"),
        F.lit("2024").alias("publication_year"), F.concat(F.lit("10.1/"), "group_key").alias("doi"),
    )


CARD_PARTS = f"""
    SELECT d.id, {pick('|'.join(LICENSES.values()), 'd.group_key')} AS license, d.name AS pretty_name,
           concat('Berg, L., and Ring, S. _', d.name, '_. Site, 2024. https://doi.org/10.1/', cast(d.group_key AS VARCHAR)) AS citation,
           d.id IN (SELECT dataset_id FROM {{cs_owned}}) AS shows_sets,
           concat('https://doi.org/', cast(d.group_key AS VARCHAR)) AS publication, false AS shows_data_link,
           cast(s.n AS VARCHAR) AS nconfigurations, 'energy, formation energy' AS properties
    FROM {{ds}} d JOIN (SELECT dataset_id, count(*) AS n FROM {{po}} GROUP BY dataset_id) s ON s.dataset_id = d.id"""


@query("dataset_card", CARD_PARTS)
def dataset_card(t: Tables):
    path = t.fresh("cards")
    card = C.dataset_card(described(t), t.cs_owned, "Site", "https://site.example")
    C.write_cards(card, path)
    # Each card is one file; its parts are picked out of the text again.
    back = read_folders(t, path, "text", wholetext=True).withColumn("dataset", folder_value("dataset"))
    after = lambda head: F.regexp_extract("value", rf"{head}([^\n]*?) *\n", 1)
    return back.select(
        F.col("dataset").alias("id"), after("license: ").alias("license"),
        after("pretty_name: ").alias("pretty_name"),
        after(r"### Cite this dataset  \n").alias("citation"),
        F.contains("value", F.lit("configuration_sets")).alias("shows_sets"),
        after(r"### Publication  \n").alias("publication"),
        F.contains("value", F.lit("Original data link")).alias("shows_data_link"),
        after(r"### Number of unique molecular configurations  \n").alias("nconfigurations"),
        after(r"### Properties included  \n").alias("properties"),
    )


@query("incremental_copy", "SELECT event_id, user_id, event_type, value FROM events")
def incremental_copy(t: Tables):
    dst, checkpoint = t.fresh("incremental"), t.fresh("incremental-checkpoint")
    schema = t.events.schema
    for _ in range(2):  # the second run finds nothing new
        copy_new(
            t.spark, t.folder, dst, checkpoint, schema, glob="events.parquet",
            transform=lambda df: df.select("event_id", "user_id", "event_type", "value"),
        )
    return t.spark.read.parquet(dst)
