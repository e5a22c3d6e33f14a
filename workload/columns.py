"""Queries over lists, hashes, structures, units and names."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mattercat.functions import hashing as H
from mattercat.functions import lists as L
from mattercat.functions import names as N
from mattercat.functions import structures as S
from mattercat.functions import units as U
from mattercat.session import staged

from .registry import Tables, query


def numbers(column: str = "text") -> str:
    """Spark expression: n rows of three numbers per line item, as text; the first differs."""
    first, rest = ("concat('[', " + ", ', ', ".join(f"cast({c} AS string)" for c in order) + ", ']')"
                   for order in ("qdt", "dtq"))
    return f"concat('[', {first}, repeat(concat(', ', {rest}), n - 1), ']') AS {column}"


# Sums of these numbers: x over the first column, total over all.
TEXT_SUMS = """SELECT id, n, round(q + (n - 1) * d, 6) AS x, round(n * (q + d + t), 6) AS total FROM {sites}"""

MATRIX = "transform(sequence(1, n), i -> array(q * i, d, t)) AS matrix"

# The same for this matrix.
SUMS = """SELECT id, n, round(list_sum([q * i for i in range(1, n + 1)]), 6) AS x,
                 round(list_sum([q * i + d + t for i in range(1, n + 1)]), 6) AS total FROM {sites}"""


def sums(rows: DataFrame, col: str) -> DataFrame:
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    return rows.select(
        "id", F.size(col).alias("n"),
        F.round(add(F.transform(col, lambda r: r[0])), 6).alias("x"),
        F.round(add(F.flatten(col)), 6).alias("total"),
    )


@query("parse_list", TEXT_SUMS)
def parse_list(t: Tables):
    rows = t.sites.selectExpr("id", numbers())
    return sums(rows.withColumn("matrix", L.parse_list("text", "array<double>", "fail")), "matrix")


@query("parse_matrix", TEXT_SUMS)
def parse_matrix(t: Tables):
    rows = t.sites.selectExpr("id", numbers())
    return sums(rows.withColumn("matrix", L.parse_matrix("text")), "matrix")


@query("list_to_text", """
    SELECT id, CASE WHEN n > 2 THEN concat('[', chr(39), 'site', chr(39), ', ', chr(39), id, chr(39), ']') END AS text
    FROM {sites}""")
def list_to_text(t: Tables):
    items = F.when(F.col("n") > 2, F.array(F.lit("site"), "id")).otherwise(F.array().cast("array<string>"))
    return t.sites.select("id", L.list_to_text(items, "string", empty_as_null=True).alias("text"))


@query("concat_chunks", SUMS)
def concat_chunks(t: Tables):
    # The text of each odd row in chunk 00, of each even row in chunk 01; chunk 02 is never filled.
    rows = t.sites.selectExpr("id", MATRIX).select(
        "id",
        L.list_to_text(F.filter("matrix", lambda r, i: i < 2), "array<double>").alias("positions_00"),
        L.list_to_text(F.filter("matrix", lambda r, i: i >= 2), "array<double>", True).alias("positions_01"),
        F.lit(None).cast("string").alias("positions_02"),
    )
    return sums(L.concat_chunks(rows, "positions", 3, "positions"), "positions")


@query("list_distinct", """
    SELECT concat('CO_', lpad(cast(p_partkey AS string), 8, '0')) AS id, concat(p_name, ',', p_brand) AS names FROM part""")
def list_distinct(t: Tables):
    names = L.list_distinct(L.parse_list("names", "string"))
    return t.co.select("id", F.array_join(names, ",").alias("names"))


DATASET_LISTS = """
    SELECT configuration_id AS id, array_sort(collect_set(dataset_id)) AS dataset_ids
    FROM {member} GROUP BY configuration_id"""


@query("list_remove", """
    SELECT configuration_id AS id, string_agg(dataset_id, ',' ORDER BY dataset_id) AS dataset_ids FROM {member}
    WHERE dataset_id NOT IN ('DS_000001_0', 'DS_000002_0') GROUP BY configuration_id""")
def list_remove(t: Tables):
    rows = L.list_remove(t.sql(DATASET_LISTS), "dataset_ids", ["DS_000001_0", "DS_000002_0"])
    return rows.select("id", F.array_join("dataset_ids", ",").alias("dataset_ids"))


@query("list_explode", "SELECT configuration_id, dataset_id FROM {member}")
def list_explode(t: Tables):
    return L.list_explode(t.sql(DATASET_LISTS), "id", "dataset_ids", "configuration_id", "dataset_id")


HASHED = ["configuration_id", "dataset_id", "multiplicity", "method"]
CANONICAL = "concat_ws('|', configuration_id, dataset_id, method, cast(multiplicity AS VARCHAR))"


@query("content_hash", f"SELECT id, sha256({CANONICAL}) AS hash FROM {{po}}")
def content_hash(t: Tables):
    return H.content_hash(t.po, HASHED, mode="neutral").select("id", "hash")


# SQL has no such hash, but can state which rows share one: those with equal content.
@query("content_hash_parity", """
    SELECT id, min(id) OVER (PARTITION BY dataset_id, q, n, d > 0.05, d, t) AS first_id, true AS digits FROM {sites}""")
def content_hash_parity(t: Tables):
    rows = t.sites.selectExpr("id", "dataset_id", "q", "n", "d > 0.05 AS flag", MATRIX)
    hashed = H.content_hash(rows, ["dataset_id", "q", "n", "flag", "matrix"]).select("id", "hash")
    return same_hash(hashed.withColumn("digits", F.col("hash").rlike("^[0-9]+$"))).select("id", "first_id", "digits")


def packed(digits: Column) -> Column:
    """A text as bytes that differ where texts differ: a decimal number without leading zeros takes half a byte a digit."""
    # No packed number starts with the byte 0xFF.
    other = F.concat(F.lit(b"\xff"), digits.cast("binary"))
    return F.when(digits.rlike(r"\A[1-9][0-9]*\z"), F.unhex(digits)).otherwise(other)


def same_hash(rows: DataFrame) -> DataFrame:
    """``id`` and ``hash`` with the smallest id of equal hashes.

    Hashes are written, so that they are made once, and are compared as packed bytes, which is
    what moves; the text moves only where it is used.
    """
    rows = staged(rows, "hashes", compression="zstd").withColumn("__packed", packed(F.col("hash")))
    first = rows.groupBy("__packed").agg(F.min("id").alias("first_id"))
    return rows.join(first, "__packed").drop("__packed")


@query("hash_bytes", """
    SELECT 'q' AS kind, count(DISTINCT q) AS hashes FROM {sites} UNION ALL SELECT 'n', count(DISTINCT n) FROM {sites}
    UNION ALL SELECT 'dataset_id', count(DISTINCT dataset_id) FROM {sites} UNION ALL SELECT 'flag', count(DISTINCT d > 0.05) FROM {sites}
    UNION ALL SELECT 'names', count(DISTINCT (dataset_id, n)) FROM {sites}
    UNION ALL SELECT 'matrix', count(DISTINCT (q, n, d, t)) FROM {sites}""")
def hash_bytes(t: Tables):
    # Equal values of each type give equal bytes and different ones do not.
    rows = t.sites.selectExpr("q", "n", "dataset_id", "d > 0.05 AS flag", "array(dataset_id, cast(n AS string)) AS names", MATRIX)
    kinds = [
        H.content_hash(rows, [c]).agg(F.count_distinct("hash").alias("hashes")).select(F.lit(c).alias("kind"), "hashes")
        for c in rows.columns
    ]
    return reduce(DataFrame.unionAll, kinds)


@query("id_from_hash", f"SELECT id, concat('PO_', substr(sha256({CANONICAL}), 1, 25)) AS new_id FROM {{po}}")
def id_from_hash(t: Tables):
    hashed = H.content_hash(t.po, HASHED, mode="neutral")
    return hashed.select("id", H.id_from_hash("hash", "PO").alias("new_id"))


@query("sort_sites", """
    SELECT id, array_to_string([cast(i AS VARCHAR) for i in range(1, n + 1)], ',') AS numbers FROM {sites}""")
def sort_sites(t: Tables):
    # Atoms given from the farthest to the nearest come out in order of x.
    rows = t.sites.selectExpr(
        "id", "transform(sequence(n, 1), i -> array(q * i, d, t)) AS positions", "sequence(n, 1) AS numbers"
    )
    sites = H.sort_sites("positions", "numbers")
    return rows.select("id", F.array_join(sites["number"].cast("array<string>"), ",").alias("numbers"))


@query("structure_hash", """
    SELECT id, min(id) OVER (PARTITION BY q, n, d, t) AS first_id, true AS same_when_reversed, true AS other_cell_differs
    FROM {sites}""")
def structure_hash(t: Tables):
    rows = t.sites.selectExpr(
        "id", MATRIX, "sequence(1, n) AS numbers", "reverse(transform(sequence(1, n), i -> array(q * i, d, t))) AS back",
        "sequence(n, 1) AS back_numbers", "array(array(1D, 0D, 0D)) AS cell", "array(array(2D, 0D, 0D)) AS other",
        "array(true, true, true) AS pbc",
    )
    rows = H.structure_hash(rows, "h", "numbers", "cell", "pbc", "matrix")
    rows = H.structure_hash(rows, "reversed", "back_numbers", "cell", "pbc", "back")
    rows = H.structure_hash(rows, "moved", "numbers", "other", "pbc", "matrix")
    hashes = rows.select(
        "id", F.col("h").alias("hash"), (F.col("h") == F.col("reversed")).alias("same_when_reversed"),
        (F.col("h") != F.col("moved")).alias("other_cell_differs"),
    )
    return same_hash(hashes).drop("hash")


@query("force_norms", """
    SELECT id, round(list_avg([sqrt(q * i * q * i + d * d + t * t) for i in range(1, n + 1)]), 6) AS mean_force_norm,
           round(list_max([sqrt(q * i * q * i + d * d + t * t) for i in range(1, n + 1)]), 6) AS max_force_norm
    FROM {sites}""")
def force_norms(t: Tables):
    rows = S.force_norms(t.sites.selectExpr("id", MATRIX), "matrix")
    return rows.select(
        "id", F.round("mean_force_norm", 6).alias("mean_force_norm"),
        F.round("max_force_norm", 6).alias("max_force_norm"),
    )


def with_cell(t: Tables) -> DataFrame:
    return t.co.withColumn("cell", L.parse_list("cell", "array<double>", "fail"))


@query("pbc_from_cell", """
    SELECT id, starts_with(cell, '[[0.0') = false AS any_axis, starts_with(cell, '[[0.0') = false AS x_axis,
           false AS y_axis FROM {co}""")
def pbc_from_cell(t: Tables):
    axis = S.pbc_from_cell("cell", mode="axis")
    return with_cell(t).select(
        "id", S.pbc_from_cell("cell")[2].alias("any_axis"), axis[0].alias("x_axis"), axis[1].alias("y_axis")
    )


@query("dimension_types", """
    SELECT id, CASE WHEN starts_with(cell, '[[0.0') THEN '0,0,0' ELSE '1,1,1' END AS dimension_types FROM {co}""")
def dimension_types(t: Tables):
    dims = S.dimension_types(S.pbc_from_cell("cell")).cast("array<string>")
    return with_cell(t).select("id", F.array_join(dims, ",").alias("dimension_types"))


@query("nperiodic_dimensions", """
    SELECT id, CASE WHEN starts_with(cell, '[[0.0') THEN 0 ELSE 1 END AS nperiodic_dimensions FROM {co}""")
def nperiodic_dimensions(t: Tables):
    dims = S.dimension_types(S.pbc_from_cell("cell", mode="axis"))
    return with_cell(t).select("id", S.nperiodic_dimensions(dims).alias("nperiodic_dimensions"))


KCAL, MOL, HARTREE = U.FACTORS["kcal"], U.FACTORS["mol"], U.HARTREE


def converted(value: str) -> str:
    """SQL: a value of the ``po`` view in eV."""
    return (
        f"CASE energy_unit WHEN 'eV' THEN {value} WHEN 'hartree' THEN {value} * {HARTREE!r}::DOUBLE "
        f"ELSE {value} * {KCAL!r}::DOUBLE / {MOL!r}::DOUBLE END"
    )


ENERGY_UNITS = {c: "energy_unit" for c in ("free_energy", "potential_energy", "energy_reference")}


@query("convert_energy", f"""
    SELECT id, round({converted('free_energy')}, 4) AS free_energy,
           round({converted('potential_energy')}, 4) AS potential_energy FROM {{po}}""")
def convert_energy(t: Tables):
    rows = U.convert_energy(t.po, ["free_energy", "potential_energy"], ENERGY_UNITS, on_error="fail")
    return rows.select(
        "id", F.round("free_energy", 4).alias("free_energy"),
        F.round("potential_energy", 4).alias("potential_energy"),
    )


@query("convert_reference_energy", f"""
    SELECT id, CASE WHEN dataset_id NOT IN ('DS_000001_0', 'DS_000004_0')
                    THEN round({converted('energy_reference')}, 6) END AS energy_reference FROM {{po}}""")
def convert_reference_energy(t: Tables):
    rows = U.convert_reference_energy(
        t.po, ["energy_reference"], ["DS_000001_0", "DS_000004_0"], ENERGY_UNITS
    )
    return rows.select("id", F.round("energy_reference", 6).alias("energy_reference"))


@query("add_reference", "SELECT id, potential_energy + coalesce(energy_reference, 0) AS energy FROM {po}")
def add_reference(t: Tables):
    rows = U.add_reference(t.po, {"potential_energy": "energy_reference"})
    return rows.select("id", F.col("potential_energy").alias("energy"))


@query("convert_array", f"""
    SELECT id, n, round(CASE n % 3 WHEN 0 THEN x WHEN 1 THEN x * {HARTREE!r}::DOUBLE / {U.BOHR!r}::DOUBLE
                        ELSE x * {KCAL!r}::DOUBLE / {MOL!r}::DOUBLE END, 4) AS x
    FROM (SELECT id, n, q + (n - 1) * d AS x FROM {{sites}})""")
def convert_array(t: Tables):
    unit = "CASE n % 3 WHEN 0 THEN 'eV/angstrom' WHEN 1 THEN 'hartree/bohr' ELSE 'kcal/mol/angstrom' END AS unit"
    rows = U.convert_array(t.sites.selectExpr("id", numbers(), unit), "text", "unit", U.FORCE_STANDARD)
    x = F.aggregate("text", F.lit(0.0), lambda s, r: s + r[0])
    return rows.select("id", F.size("text").alias("n"), F.round(x, 4).alias("x"))


@query("per_atom_to_total", """
    SELECT p.id, CASE WHEN p.energy_per_atom THEN p.potential_energy * c.nsites ELSE p.potential_energy END AS energy
    FROM {po} p JOIN {co} c ON c.id = p.configuration_id""")
def per_atom_to_total(t: Tables):
    rows = t.po.join(t.co.select(F.col("id").alias("configuration_id"), "nsites"), "configuration_id")
    rows = U.per_atom_to_total(rows, {"potential_energy": "energy_per_atom"})
    return rows.select("id", F.col("potential_energy").alias("energy"))


@query("choose_energy", "SELECT id, coalesce(free_energy, potential_energy) AS energy FROM {po}")
def choose_energy(t: Tables):
    return U.choose_energy(t.po).select("id", "energy")


@query("trim_path", """
    SELECT id, regexp_replace(metadata_path, '^/mnt/blobs/(data/)?', 'data/') AS metadata_path FROM {co}""")
def trim_path(t: Tables):
    return t.co.select("id", N.trim_path("metadata_path", "/mnt/blobs").alias("metadata_path"))


@query("id_prefix", "SELECT id, substr(id, 1, 6) AS prefix FROM {po}")
def id_prefix(t: Tables):
    return t.po.select("id", N.id_prefix("id").alias("prefix"))


@query("number_from_name", "SELECT id, CASE WHEN n > 1 THEN cast(partkey AS INTEGER) END AS number FROM {sites}")
def number_from_name(t: Tables):
    names = F.array(
        F.lit("other__file_7__config_1"),
        F.concat(F.lit("train__file_"), F.when(F.col("n") > 1, F.col("partkey").cast("string")).otherwise("x"),
                 F.lit("__config_3")),
    )
    number = N.number_from_name(names, "train", "train__file_", "__config")
    return t.sites.select("id", number.alias("number"))


@query("normalize_name", """
    SELECT p_partkey AS key, concat('a_b', replace(p_name, ' ', '_'), '_', p_brand, '_') AS name FROM part""")
def normalize_name(t: Tables):
    raw = F.concat(F.lit("a@b"), F.translate("p_name", " ", "/"), F.lit("("), "p_brand", F.lit(")"))
    return t.part.select(F.col("p_partkey").alias("key"), N.normalize_name(raw).alias("name"))


@query("display_name", "SELECT o_orderkey AS key, replace(o_orderpriority, '-', ' ') AS name FROM orders")
def display_name(t: Tables):
    raw = F.translate("o_orderpriority", "-", "_")
    return t.orders.select(F.col("o_orderkey").alias("key"), N.display_name(raw).alias("name"))


# Licenses as they are stored and as cards show them.
LICENSES = {"CC0": "cc0-1.0", "NIST-PD": "unknown", "GPL-3.0-only": "gpl-3.0", "CC-BY-4.0": "cc-by-4.0"}


def pick(value: str, key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(value.split("|")))
    return f"CASE {key} % {len(value.split('|'))} {whens} END"


STORED, SHOWN = "|".join(LICENSES), "|".join(LICENSES.values())


@query("normalize_license", f"SELECT id, {pick(SHOWN, 'group_key')} AS license FROM {{ds}}")
def normalize_license(t: Tables):
    return t.ds.select("id", N.normalize_license(F.expr(pick(STORED, "group_key"))).alias("license"))


@query("citation", """
    SELECT p_partkey AS key,
           concat('Berg, L., and Ring, S. _', p_name, ' ', p_brand, '_. Site, ', cast(1990 + p_size AS VARCHAR),
                  '. https://doi.org/10.1/', cast(p_partkey AS VARCHAR)) AS citation
    FROM part""")
def citation(t: Tables):
    rows = t.part.select(
        F.col("p_partkey").alias("key"),
        F.array(F.lit("Ludwig van der Berg"), F.lit("Sam Ring")).alias("authors"),
        F.concat_ws("_", "p_name", "p_brand").alias("name"), (F.col("p_size") + 1990).alias("year"),
        F.concat(F.lit("10.1/"), "p_partkey").alias("doi"),
    )
    return rows.select("key", N.citation("authors", "name", "year", "doi", "Site").alias("citation"))


@query("present_properties", """
    SELECT dataset_id, CASE WHEN count(energy_reference) = 0 THEN 'formation energy'
                            ELSE 'energy reference, formation energy' END AS properties
    FROM {po} GROUP BY dataset_id""")
def present_properties(t: Tables):
    counts = t.po.groupBy("dataset_id").agg(
        F.count("energy_reference").alias("energy_reference_count"),
        F.lit(0).alias("adsorption_energy_count"),
        F.count("formation_energy").alias("formation_energy_count"),
    )
    return counts.select("dataset_id", N.present_properties(counts).alias("properties"))


@query("parse_links", """
    SELECT p_partkey AS key, CASE WHEN p_size % 3 > 0 THEN concat('https://doi.org/', p_brand) END AS publication,
           CASE WHEN p_size % 3 = 1 THEN p_name END AS data
    FROM part""")
def parse_links(t: Tables):
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    data = F.when(F.col("p_size") % 3 == 1, quoted(F.col("p_name"))).otherwise("None")
    text = F.concat(
        F.lit("{'source-publication': "), quoted(F.concat(F.lit("https://doi.org/"), "p_brand")),
        F.lit(", 'source-data': "), data, F.lit(", 'other': None}"),
    )
    links = L.parse_links(F.when(F.col("p_size") % 3 > 0, text).otherwise("not a dictionary"))
    return t.part.select(
        F.col("p_partkey").alias("key"), links["source-publication"].alias("publication"),
        links["source-data"].alias("data"),
    )


@query("ensure_list", """
    SELECT p_partkey AS key, CASE p_size % 3 WHEN 0 THEN concat(p_name, ',', p_brand) WHEN 1 THEN p_name ELSE '' END AS items
    FROM part""")
def ensure_list(t: Tables):
    text = F.when(F.col("p_size") % 3 == 0, L.list_to_text(F.array("p_name", "p_brand"))).when(
        F.col("p_size") % 3 == 1, F.col("p_name")
    )
    return t.part.select(
        F.col("p_partkey").alias("key"), F.array_join(L.ensure_list(text), ",").alias("items")
    )


@query("info_fields", """
    SELECT id, concat('{"method":"', method, '","multiplicity":', cast(multiplicity AS VARCHAR),
                      CASE WHEN energy_unit = 'eV' THEN ',"names":["eV"]' ELSE '' END, '}') AS info
    FROM {po}""")
def info_fields(t: Tables):
    names = F.when(F.col("energy_unit") == "eV", F.array("energy_unit")).otherwise(F.array().cast("array<string>"))
    rows = t.po.withColumn("names", names).withColumn("absent", F.lit(None).cast("double"))
    return rows.select("id", N.info_fields(rows, ["method", "multiplicity", "absent", "names"]).alias("info"))


@query("fill_int_null", """
    SELECT p_partkey AS key, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS metadata_size FROM part""")
def fill_int_null(t: Tables):
    rows = t.part.select(
        F.col("p_partkey").alias("key"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("metadata_size")
    )
    return N.fill_int_null(rows, "metadata_size", 0)
