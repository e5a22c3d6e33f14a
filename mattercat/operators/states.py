"""Mergeable statistics of datasets: what new rows add is found from new rows alone.

A state is a small table per dataset: counts, mean and sum of squared deviations of the
energy, and site-weighted element shares. States of disjoint rows add up, so a dataset
grows by merging the state of its new properties with the stored one. Structures count once
per dataset, so the pairs (dataset, structure) already counted are kept too: new
properties are held against these narrow pairs, not against old rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from .joins import attach_stats

TABLES = ("properties", "structures", "members")
FEW = 1000  # datasets named in a filter, so that files without them are skipped


def property_state(po: DataFrame, energy: str = "energy") -> DataFrame:
    """Rows, values of each counted property, and number, mean and squared deviations of the energy, per dataset."""
    present = [p for p in S.COUNTED_PROPERTIES if p in po.columns]
    value = F.col(energy).cast("double")
    return po.groupBy("dataset_id").agg(
        *[F.count(p).alias(f"{p}_count") for p in present], F.count("*").alias("nproperty_objects"),
        F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"),
    )


def merge_property_states(*states: DataFrame) -> DataFrame:
    """The state of all rows together. Deviations are moved to the common mean, so nothing cancels."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states)
    alike = Window.partitionBy("dataset_id")
    mean = F.sum(F.col("n") * F.col("mean")).over(alike) / F.nullif(F.sum("n").over(alike), F.lit(0))
    counts = [c for c in rows.columns if c.endswith("_count")]
    return rows.withColumn("__mean", mean).groupBy("dataset_id").agg(
        *[F.sum(c).alias(c) for c in [*counts, "nproperty_objects", "n"]], F.max("__mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("__mean"), F.lit(2))).alias("m2"),
    ).select(*rows.columns)


def members(po: DataFrame) -> DataFrame:
    """The distinct pairs of dataset and structure."""
    return po.select("dataset_id", "configuration_id").distinct()


def structure_state(pairs: DataFrame, co: DataFrame) -> DataFrame:
    """Per dataset, element and periodicity: site-weighted share, structures and sites.

    ``pairs`` are distinct. A structure stands in one row per element it has, or in one without an element;
    structures and sites are counted in the first of them.
    """
    parts = F.arrays_zip(F.col("elements").alias("element"), F.col("elements_ratios").alias("ratio"))
    sites = pairs.join(
        co.select(
            F.col("id").alias("configuration_id"), "nsites", "nperiodic_dimensions",
            "dimension_types", parts.alias("parts"),
        ),
        "configuration_id",
    ).select("*", F.posexplode_outer("parts").alias("at", "part"))
    # A structure without elements still gives one row, with a null position.
    once = F.coalesce(F.col("at"), F.lit(0)) == 0
    return sites.groupBy(
        "dataset_id", F.col("part.element").alias("element"), "nperiodic_dimensions", "dimension_types"
    ).agg(
        F.sum(F.col("part.ratio") * F.col("nsites")).alias("weight"),
        F.count_if(once).alias("structures"),
        F.sum(F.when(once, F.col("nsites"))).alias("sites"),
    )


def merge_structure_states(*states: DataFrame) -> DataFrame:
    """The state of the structures of all states, which share no pair of dataset and structure."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("dataset_id", "element", "nperiodic_dimensions", "dimension_types").agg(
        *[F.sum(c).alias(c) for c in ("weight", "structures", "sites")])


def energy_and_counts(state: DataFrame) -> DataFrame:
    """The columns of a dataset that follow from its properties."""
    counts = [c for c in state.columns if c.endswith("_count")]
    return state.select(
        "dataset_id", F.when(F.col("n") > 0, F.col("mean")).alias("energy_mean"),
        F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)).alias("energy_variance"), *counts, "nproperty_objects",
    )


def elements_and_sites(state: DataFrame) -> DataFrame:
    """The columns of a dataset that follow from its structures.

    Sets are gathered last, when there is one row per dataset, element and periodicity.
    """
    per_element = state.groupBy("dataset_id", "element").agg(
        *[F.sum(c).alias(c) for c in ("weight", "structures", "sites")],
        F.collect_set("nperiodic_dimensions").alias("nperiodic"),
        F.collect_set("dimension_types").alias("dims"),
    )
    listed = F.array_sort(F.collect_list(
        F.when(F.col("element").isNotNull(), F.struct("element", "weight"))
    ))

    def union(c: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))

    return per_element.groupBy("dataset_id").agg(
        F.sum("structures").alias("nconfigurations"), F.sum("sites").alias("nsites"),
        listed.alias("__listed"), union("nperiodic").alias("nperiodic_dimensions"),
        union("dims").alias("dimension_types"),
    ).select(
        "dataset_id", "nconfigurations", "nsites", "nperiodic_dimensions", "dimension_types",
        F.col("__listed.element").alias("elements"), F.size("__listed").alias("nelements"),
        F.transform("__listed.weight", lambda w: w / F.col("nsites")).alias("total_elements_ratios"),
    )


def as_declared(ds: DataFrame) -> DataFrame:
    """The columns that the declared schema of datasets has in its types; a count that does not fit is an error."""
    declared = {f.name: f.dataType for f in S.DS.fields}
    return ds.select(*[F.col(c).cast(declared[c]).alias(c) if c in declared and ds.schema[c].dataType != declared[c] else F.col(c) for c in ds.columns])


def dataset_rows(ds: DataFrame, properties: DataFrame, structures: DataFrame, cs: DataFrame | None = None) -> DataFrame:
    """Every dataset with its aggregated columns made from states; described columns are kept.

    With ``cs`` comes ``nconfiguration_sets``, the number of its named sets, 0 if it has none.
    """
    rows = attach_stats(attach_stats(ds, energy_and_counts(properties)), elements_and_sites(structures))
    if cs is not None:
        sets = cs.groupBy("dataset_id").agg(F.count_distinct("id").alias("nconfiguration_sets"))
        rows = attach_stats(rows, sets).withColumn("nconfiguration_sets", F.coalesce("nconfiguration_sets", F.lit(0)).cast("int"))
    return as_declared(rows)


class DatasetStates:
    """States of a growing set of tables below a folder that all executors see.

    ``add`` takes a batch of new properties with a name of its own: it is written piece by piece and then
    committed, so a batch that failed is written anew and one that was committed changes nothing.
    ``rows`` reads states only. New properties may belong to structures counted before,
    but a structure does not change: correct one by building its datasets anew.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/committed")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def table(self, name: str) -> DataFrame | None:
        """One of ``TABLES`` over all committed batches; None before the first."""
        paths = [f"{self.folder}/{name}/{b}" for b in self.batches()]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def add(self, batch: str, po: DataFrame, co: DataFrame) -> None:
        """Count a batch of new properties. Of ``co`` only structures new to a dataset take part."""
        if batch in self.batches():
            return
        pairs, known = members(po), self.table("members")
        if known is not None:
            touched = [r[0] for r in pairs.select("dataset_id").distinct().limit(FEW + 1).collect()]
            if len(touched) <= FEW:
                known = known.filter(F.col("dataset_id").isin(*touched))
            pairs = pairs.join(known, ["dataset_id", "configuration_id"], "left_anti")
        where = {t: f"{self.folder}/{t}/{batch}" for t in TABLES}
        # Sorted, so that a later batch reads the pairs of its own datasets only.
        pairs.repartitionByRange("dataset_id", "configuration_id").sortWithinPartitions("dataset_id").write.mode("overwrite").parquet(where["members"])
        new = self.spark.read.schema(pairs.schema).parquet(where["members"])
        property_state(po).write.mode("overwrite").parquet(where["properties"])
        structure_state(new, co).write.mode("overwrite").parquet(where["structures"])
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.folder}/committed/{batch}")

    def rows(self, ds: DataFrame, cs: DataFrame | None = None) -> DataFrame:
        """Every dataset with its statistics, from what was added so far."""
        if not self.batches():
            raise ValueError("no batch was added")
        return dataset_rows(ds, merge_property_states(self.table("properties")), merge_structure_states(self.table("structures")), cs)
