"""Queries over counts, statistics, duplicates and audits."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattercat.operators import aggregates as A
from mattercat.operators.states import DatasetStates

from .registry import Tables, query

# What standard energies look like once conversion is done; used by statistics.
ENERGY = "coalesce(free_energy, potential_energy)"
STATS = f"""
    SELECT dataset_id, count({ENERGY}) AS energy_count, count(formation_energy) AS formation_energy_count,
           count(*) AS nproperty_objects, avg({ENERGY}) AS energy_mean, var_samp({ENERGY}) AS energy_variance
    FROM {{po}} GROUP BY dataset_id"""


def with_energy(t: Tables) -> DataFrame:
    return t.po.withColumn("energy", F.coalesce("free_energy", "potential_energy"))


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("count_by_prefix", """
    SELECT w.prefix, coalesce(f.n, 0) AS count
    FROM (SELECT concat('PO_', lpad(cast(i AS string), 5, '0')) AS prefix FROM range(0, 1000) r(i)) w
    LEFT JOIN (SELECT substr(id, 1, 8) AS prefix, count(*) AS n FROM {po} GROUP BY 1) f ON f.prefix = w.prefix""")
def count_by_prefix(t: Tables):
    return A.count_by_prefix(t.po, "PO_", length=8, lo=0, hi=999)


@query("dataset_energy_stats", f"""
    SELECT dataset_id, round(energy_mean, 4) AS energy_mean, round(energy_variance, 1) AS energy_variance
    FROM ({STATS})""")
def dataset_energy_stats(t: Tables):
    return rounded(rounded(A.dataset_energy_stats(with_energy(t)), "energy_mean"), "energy_variance", digits=1)


@query("dataset_property_counts", f"""
    SELECT dataset_id, energy_count, formation_energy_count, nproperty_objects FROM ({STATS})""")
def dataset_property_counts(t: Tables):
    return A.dataset_property_counts(with_energy(t))


# Counts of datasets are declared as 32-bit numbers.
COUNTS = """s.energy_count::INTEGER AS energy_count, s.formation_energy_count::INTEGER AS formation_energy_count,
           s.nproperty_objects::INTEGER AS nproperty_objects"""


@query("recreate_datasets", f"""
    SELECT d.id, d.name, {COUNTS}, round(s.energy_mean, 4) AS energy_mean, round(s.energy_variance, 1) AS energy_variance
    FROM {{ds}} d LEFT JOIN ({STATS}) s ON s.dataset_id = d.id""")
def recreate_datasets(t: Tables):
    columns = [
        "id", "name", "energy_count", "formation_energy_count", "nproperty_objects", "energy_mean",
        "energy_variance",
    ]
    fresh = A.recreate_datasets(t.ds, with_energy(t), columns)
    return rounded(rounded(fresh, "energy_mean"), "energy_variance", digits=1)


# Elements of a structure for the statistics below: two, of fixed shares.
ELEMENTS_SPARK = """
    SELECT id, nsites, if(nsites % 2 = 0, array('H', 'O'), array('C', 'H')) AS elements,
           array(0.25D, 0.75D) AS elements_ratios, nsites % 4 AS nperiodic_dimensions,
           array(cast(nsites % 4 > 0 AS int), cast(nsites % 4 > 1 AS int), cast(nsites % 4 > 2 AS int)) AS dimension_types
    FROM {co}"""


RECALCULATED = f"""
    WITH pairs AS (SELECT m.dataset_id, c.nsites FROM {{member}} m JOIN {{co}} c ON c.id = m.configuration_id),
    sums AS (SELECT dataset_id, count(*)::INTEGER AS nconfigurations, sum(nsites)::INTEGER AS nsites,
                    count(DISTINCT nsites % 4) AS n_dims,
                    sum(CASE WHEN nsites % 2 = 1 THEN 0.25 * nsites ELSE 0 END)::DOUBLE AS c,
                    sum(CASE WHEN nsites % 2 = 0 THEN 0.25 * nsites ELSE 0.75 * nsites END)::DOUBLE AS h,
                    sum(CASE WHEN nsites % 2 = 0 THEN 0.75 * nsites ELSE 0 END)::DOUBLE AS o,
                    count_if(nsites % 2 = 0) AS even FROM pairs GROUP BY dataset_id)
    SELECT d.id, d.name, s.nconfigurations, s.nsites, {COUNTS.replace('s.', 'p.')},
           round(p.energy_mean, 4) AS energy_mean, round(p.energy_variance, 1) AS energy_variance,
           CASE WHEN even = 0 THEN 'C,H' WHEN even = nconfigurations THEN 'H,O' ELSE 'C,H,O' END AS elements,
           round(s.h / s.nsites, 8) AS h_share, s.n_dims AS n_dimensions, coalesce(k.n, 0)::INTEGER AS nconfiguration_sets
    FROM {{ds}} d LEFT JOIN sums s ON s.dataset_id = d.id LEFT JOIN ({STATS}) p ON p.dataset_id = d.id
    LEFT JOIN (SELECT dataset_id, count(*) AS n FROM {{cs_owned}} GROUP BY dataset_id) k ON k.dataset_id = d.id"""


def statistics(fresh: DataFrame) -> DataFrame:
    h = F.element_at("total_elements_ratios", F.array_position("elements", "H").cast("int"))
    return rounded(rounded(fresh, "energy_mean"), "energy_variance", digits=1).select(
        "id", "name", "nconfigurations", "nsites", "energy_count", "formation_energy_count", "nproperty_objects",
        "energy_mean", "energy_variance", F.array_join("elements", ",").alias("elements"), F.round(h, 8).alias("h_share"),
        F.size("dimension_types").cast("long").alias("n_dimensions"), "nconfiguration_sets",
    )


@query("recalculate_dataset", RECALCULATED)
def recalculate_dataset(t: Tables):
    return statistics(A.recalculate_dataset(t.ds, with_energy(t), t.sql(ELEMENTS_SPARK), t.cs_owned))


@query("recalculate_dataset_batches", RECALCULATED)
def recalculate_dataset_batches(t: Tables):
    # The table arrives in four batches that share datasets and structures; old rows are not read again.
    states = DatasetStates(t.spark, t.fresh("states"))
    po, co = with_energy(t), t.sql(ELEMENTS_SPARK)
    for i in range(4):
        states.add(f"batch-{i}", po.filter(F.pmod(F.xxhash64("id"), F.lit(4)) == i), co)
    return statistics(states.rows(t.ds, t.cs_owned))


@query("duplicate_ids", "SELECT id, count(*) AS count FROM {po} GROUP BY id HAVING count(*) > 1")
def duplicate_ids(t: Tables):
    return A.duplicate_ids(t.po)


def listed(t: Tables) -> DataFrame:
    """``po`` with two list columns to merge."""
    return t.po.select(
        "id", F.array("dataset_id").alias("dataset_ids"), F.array("configuration_id", "method").alias("names"),
        "method", "multiplicity", "formation_energy", "last_modified",
    )


# Which of two copies with the same time wins: a whole number that both engines can state.
TIE = "multiplicity * 100 + CAST(coalesce(formation_energy, 0) * 100 AS INT)"
MERGED_LISTS = """string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) AS dataset_ids,
           array_to_string(list_sort(list_distinct(list_concat(list(configuration_id), list(method)))), ',') AS names"""


def picked(order: str) -> str:
    """SQL: the plain columns of ``combine_duplicates`` in an order of copies."""
    return f"""first(method ORDER BY last_modified {order}, {TIE} {order}) AS method,
           first(multiplicity ORDER BY last_modified {order}, {TIE} {order}) AS multiplicity,
           first(formation_energy ORDER BY last_modified {order}, {TIE} {order}) FILTER (formation_energy IS NOT NULL) AS formation_energy"""


def as_text(merged: DataFrame) -> DataFrame:
    return merged.select(
        "id", F.array_join("dataset_ids", ",").alias("dataset_ids"),
        F.array_join("names", ",").alias("names"), "method", "multiplicity", "formation_energy",
        F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
    )


@query("combine_duplicates", f"""
    SELECT id, {MERGED_LISTS}, {picked('DESC')}, max(last_modified)::VARCHAR AS last_modified
    FROM {{po}} GROUP BY id""")
def combine_duplicates(t: Tables):
    return as_text(A.combine_duplicates(listed(t), "id", ["dataset_ids", "names"], "last_modified", tie=F.expr(TIE)))


@query("combine_duplicates_first", f"""
    SELECT id, {MERGED_LISTS}, {picked('ASC')}, min(last_modified)::VARCHAR AS last_modified
    FROM {{po}} GROUP BY id""")
def combine_duplicates_first(t: Tables):
    return as_text(A.combine_duplicates(listed(t), "id", ["dataset_ids", "names"], "last_modified", "first", F.expr(TIE)))


@query("combine_duplicates_union", f"""
    SELECT id, {MERGED_LISTS}, string_agg(DISTINCT method, ',' ORDER BY method) AS method,
           string_agg(DISTINCT multiplicity, ',' ORDER BY multiplicity) AS multiplicity,
           count(DISTINCT formation_energy) AS n_energies, count(DISTINCT last_modified) AS n_times
    FROM {{po}} GROUP BY id""")
def combine_duplicates_union(t: Tables):
    merged = A.combine_duplicates(listed(t), "id", ["dataset_ids", "names"], policy="union")
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    number = lambda c, name: F.greatest(F.size(c), F.lit(0)).cast("bigint").alias(name)
    return merged.select(
        "id", *[joined(c) for c in ("dataset_ids", "names", "method", "multiplicity")],
        number("formation_energy", "n_energies"), number("last_modified", "n_times"))


@query("distinct_dimensions", """
    WITH rows AS (SELECT p.id, p.dataset_id, c.nsites % 4 AS np FROM {po} p JOIN {co} c ON c.id = p.configuration_id)
    SELECT r.id, r.dataset_id, s.dims AS dims, s.n AS n_types
    FROM rows r JOIN (SELECT dataset_id, string_agg(DISTINCT np, ',' ORDER BY np) AS dims,
                             count(DISTINCT np) AS n FROM rows GROUP BY dataset_id) s ON s.dataset_id = r.dataset_id""")
def distinct_dimensions(t: Tables):
    co = t.sql(ELEMENTS_SPARK).select(
        F.col("id").alias("configuration_id"), "nperiodic_dimensions", "dimension_types"
    )
    rows = t.po.select("id", "dataset_id", "configuration_id").join(co, "configuration_id")
    return A.distinct_dimensions(rows).select(
        "id", "dataset_id",
        F.array_join(F.col("dataset_nperiodic_dimensions").cast("array<string>"), ",").alias("dims"),
        F.size("dataset_dimension_types").cast("long").alias("n_types"),
    )


@query("distinct_values", "SELECT DISTINCT energy_unit FROM {po}")
def distinct_values(t: Tables):
    return A.distinct_values(t.po, "energy_unit")


@query("value_counts", "SELECT energy_reference, count(*) AS count FROM {po} GROUP BY energy_reference")
def value_counts(t: Tables):
    return A.value_counts(t.po, "energy_reference")


@query("count_where", "SELECT count(*) AS count FROM {po} WHERE formation_energy IS NULL AND multiplicity > 5")
def count_where(t: Tables):
    return A.count_where(t.po, "formation_energy IS NULL AND multiplicity > 5")


@query("distinct_count", "SELECT count(DISTINCT id) AS count FROM {po}")
def distinct_count(t: Tables):
    return A.distinct_count(t.po, "id")


@query("audit_counts", """
    SELECT count(*) AS before, count(*) FILTER (multiplicity > 3) AS after,
           count(*) FILTER (NOT multiplicity > 3) AS difference FROM {po}""")
def audit_counts(t: Tables):
    return A.audit_counts(t.po, t.po.filter("multiplicity > 3"))


@query("changed_rows", """
    SELECT id, free_energy, formation_energy FROM {po} WHERE free_energy IS DISTINCT FROM formation_energy""")
def changed_rows(t: Tables):
    return A.changed_rows(t.po, "free_energy", "formation_energy").select("id", "free_energy", "formation_energy")


@query("missing_numbers", """
    SELECT o_orderkey AS number FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def missing_numbers(t: Tables):
    # Order keys run from 0 without gaps, so their count is the range to check.
    return A.missing_numbers(
        t.lineitem.select(F.col("l_orderkey").alias("number")), "number", t.orders.count()
    )
