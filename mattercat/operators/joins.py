"""Joins between the five tables.

All are equi-joins without strategy hints: Catalyst broadcasts a side only when
its measured size is under the threshold. Joins that fetch one row per key deal
out keys that hold too many rows (``lookup_join``); in the others adaptive
execution splits them on the side that keeps its rows. A side that is only looked up, and may repeat its
keys, is reduced to distinct keys first, which combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import scratch, staged
from .edits import drop_columns, rename_prefixed
from .skew import NO_HOT_KEYS, lookup_join


def merge_po_co(
    po: DataFrame, co: DataFrame, columns: Sequence[str] = tuple(S.MERGED_COLUMNS)
) -> DataFrame:
    """One wide row per property with its structure; rows without a structure go."""
    properties = rename_prefixed(
        drop_columns(po, S.MERGE_DROPPED_PO), "property", S.MERGE_RENAMED
    )
    structures = rename_prefixed(
        drop_columns(co, S.MERGE_DROPPED_CO), "configuration", S.MERGE_RENAMED
    )
    return lookup_join(properties, structures, "configuration_id", "inner").select(*columns)


def flatten_po_co(po: DataFrame, co: DataFrame) -> DataFrame:
    """One wide row per property; rows without a structure stay, with nulls."""
    formulas = [c for c in po.columns if c.startswith("chemical_formula")]
    paths = ["metadata_path", "metadata_size"]
    properties = rename_prefixed(
        drop_columns(po, formulas + paths), "property_object", S.FLAT_SHARED
    )
    structures = rename_prefixed(
        drop_columns(co, paths), "configuration", S.FLAT_SHARED + S.FLAT_PREFIXED_CO
    )
    return lookup_join(properties, structures, "configuration_id")


def attach_dataset(
    rows: DataFrame, ds: DataFrame, cols: Sequence[str] | None = None, hot: dict | None = None
) -> DataFrame:
    """Dataset attributes, each prefixed ``dataset_``, on every row of the dataset.

    ``hot`` as in ``lookup_join``.
    """
    chosen = ds if cols is None else ds.select("id", *[c for c in cols if c != "id"])
    return lookup_join(rows, rename_prefixed(chosen, "dataset"), "dataset_id", hot=hot)


def attach_nsites(po: DataFrame, co: DataFrame) -> DataFrame:
    """The number of sites of each property's structure. Reads two columns of ``co``."""
    sites = co.select(F.col("id").alias("configuration_id"), "nsites")
    return lookup_join(po, sites, "configuration_id")


def attach_stats(ds: DataFrame, stats: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Fresh aggregates in place of the dataset's own; datasets without rows get null."""
    fresh = stats.withColumnRenamed(key, "id")
    old = [c for c in fresh.columns if c != "id" and c in ds.columns]
    return ds.drop(*old).join(fresh, "id", "left")


def rows_for_duplicates(df: DataFrame, dup_ids: DataFrame, key: str = "id") -> DataFrame:
    """All rows whose id is a repeated one."""
    return df.join(dup_ids.select(key), key, "left_semi")


def sets_to_map(cs_co_map: DataFrame, set_ids: DataFrame) -> DataFrame:
    """Mapping rows of the chosen sets."""
    chosen = set_ids.select(F.col("id").alias("configuration_set_id"))
    return cs_co_map.join(chosen, "configuration_set_id", "left_semi")


def has_sets(ds: DataFrame, cs: DataFrame) -> DataFrame:
    """``(id, has_sets)`` for every dataset."""
    owners = cs.select(F.col("dataset_id").alias("__owner")).distinct()
    return ds.join(owners, F.col("id") == F.col("__owner"), "left").select(
        "id", F.col("__owner").isNotNull().alias("has_sets")
    )


def remap_ids(
    df: DataFrame, id_map: DataFrame, replace: dict[str, str], key: str = "id", how: str = "inner",
    hot: dict | None = NO_HOT_KEYS,
) -> DataFrame:
    """Take columns from an old-to-new table: ``{column: column of id_map}``.

    ``id_map`` has one row per old id in ``key``. Rows it does not name go, or
    stay as they are with ``how='left'``. ``hot`` as in ``lookup_join``: ids have no
    hot values, foreign keys may.
    """
    new = id_map.select(
        key, F.lit(True).alias("__mapped"), *[F.col(n).alias(f"__{c}") for c, n in replace.items()]
    )
    joined = lookup_join(df, new, key, how, hot)
    mapped = F.col("__mapped").isNotNull()
    values = {
        c: F.when(mapped, F.col(f"__{c}")).otherwise(F.col(c)) if how == "left" and c in df.columns
        else F.col(f"__{c}")
        for c in replace
    }
    added = [c for c in replace if c not in df.columns]
    return joined.withColumns(values).select(*df.columns, *added)


def remap_foreign_key(
    df: DataFrame, id_map: DataFrame, fk: str = "configuration_id", new: str = "new_id",
    how: str = "inner",
) -> DataFrame:
    """Point a foreign key at the new ids of ``id_map(id, new_id)``."""
    keyed = id_map.select(F.col("id").alias(fk), F.col(new))
    return remap_ids(df, keyed, {fk: new}, key=fk, how=how, hot=None)


class MapError(ValueError):
    """Id maps that lead nowhere; ``ids`` are some of those concerned."""

    def __init__(self, what: str, ids: list):
        super().__init__(f"{what}: {', '.join(map(str, ids))}")
        self.ids = ids


def collapse_maps(*maps: DataFrame, old: str = "id", new: str = "new_id", named: int = 20) -> DataFrame:
    """One map ``(old, new)`` from several whose steps may follow each other: every old id with its last new one.

    The steps of all maps are one set of pointers, and each round lets every pointer jump over
    the one it points to, so ``n`` steps take ``log2 n`` rounds. Repeated steps count once and an id
    mapped to itself is no step. An id with two different new ids is a fork, and steps that come back
    to their start are a cycle: both are errors that name ids. Steps with a null are left out.
    """
    pairs = reduce(DataFrame.unionAll, [m.select(F.col(old).alias("old"), F.col(new).alias("new")) for m in maps])
    pairs = staged(pairs.filter("old <> new").distinct(), "steps")
    forks = pairs.groupBy("old").agg(F.count("*").alias("n")).filter("n > 1").orderBy("old").limit(named).collect()
    if forks:
        raise MapError("ids with several new ids", [r["old"] for r in forks])
    steps, rounds = pairs.count(), 0
    while True:
        ahead = pairs.select(F.col("old").alias("at"), F.col("new").alias("further"))
        moved = pairs.join(ahead, F.col("new") == F.col("at"), "left")
        with scratch(pairs.sparkSession) as keep:
            after = keep(moved.select("old", F.coalesce("further", "new").alias("new"), F.col("at").isNotNull().alias("moved")), "steps")
        still = after.filter("moved")
        if not still.take(1):
            return pairs.select(F.col("old").alias(old), F.col("new").alias(new))
        if 1 << rounds > steps:
            # All chains have ended by now. After as many steps as there are, a pointer ends on a cycle.
            ids = still.select("new").distinct().orderBy("new").limit(named).collect()
            raise MapError("ids on a cycle", [r["new"] for r in ids])
        pairs, rounds = after.select("old", "new"), rounds + 1


def anti_missing_children(
    parent: DataFrame, child: DataFrame, fk: str, key: str = "id"
) -> DataFrame:
    """Parents no child refers to; ``fk`` may be an id or a list of ids."""
    refs = child.select(
        F.explode(fk).alias(key) if child.schema[fk].dataType.typeName() == "array"
        else F.col(fk).alias(key)
    )
    return parent.join(refs.distinct(), key, "left_anti")


def anti_orphans(child: DataFrame, parent: DataFrame, fk: str, key: str = "id") -> DataFrame:
    """Children whose parent is gone. A child without a reference counts as an orphan."""
    return child.join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def copy_closure(
    ds_ids: DataFrame, po: DataFrame, co: DataFrame, target_co: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """What must be copied for some datasets: their ``po``, and the ``co`` these
    need and the target lacks."""
    properties = po.join(ds_ids.select(F.col("id").alias("dataset_id")), "dataset_id", "left_semi")
    needed = properties.select(F.col("configuration_id").alias("id")).distinct()
    structures = co.join(needed, "id", "left_semi").join(
        target_co.select("id"), "id", "left_anti"
    )
    return properties, structures


def anti_already_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The work list without what is done."""
    return work.join(done.select(key).distinct(), key, "left_anti")
