"""Duplicates, removals, set maps and merged array tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lists import list_explode, list_remove, parse_list
from ..operators.aggregates import audit_counts, combine_duplicates, duplicate_ids
from ..operators.edits import filter_nonempty_list, filter_not_in, select_ordered, typed_table
from ..operators.joins import merge_po_co, rows_for_duplicates
from ..operators.sets import append_rows
from ..session import staged


def repair_duplicates(
    df: DataFrame, list_cols: Sequence[str], key: str = "id", order: str | None = "last_modified",
    policy: str = "latest", tie: Column | None = None,
) -> DataFrame:
    """The table with one row per id; rows of repeated ids are merged.

    Only repeated ids go through the merge; all other rows pass an anti join. The
    repeated ids are written first, so that they are found once and their size is
    known: while they are few, no join moves the table itself. ``policy`` (latest or first) and
    ``tie`` are those of ``combine_duplicates``.
    """
    if policy == "union":
        raise ValueError("rows that are not repeated stay as they are, so columns can't become lists")
    repeated = staged(duplicate_ids(df, key), "repeated-ids")
    merged = combine_duplicates(rows_for_duplicates(df, repeated, key), key, list_cols, order, policy, tie)
    single = df.join(repeated.select(key), key, "left_anti")
    return append_rows(select_ordered(single, df.columns), merged)


def build_set_map(co: DataFrame, sets_col: str = "configuration_set_ids") -> DataFrame:
    """``cs_co_map`` from the set ids each structure lists."""
    listed = filter_nonempty_list(co, sets_col)
    if isinstance(co.schema[sets_col].dataType, T.StringType):
        listed = listed.withColumn(sets_col, parse_list(sets_col, "string"))
    pairs = list_explode(listed, "id", sets_col, "configuration_id", "configuration_set_id")
    return pairs.select("configuration_set_id", "configuration_id")


def build_arrays(po: DataFrame, co: DataFrame, schema: T.StructType) -> DataFrame:
    """Merged property-and-structure rows with every list typed, in the target schema."""
    present = [f.name for f in schema.fields]
    merged = merge_po_co(po, co, present)
    return typed_table(merged, schema, "fail").to(schema)


def purge_datasets(
    tables: dict[str, DataFrame], dataset_ids: Sequence[str]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without some datasets, and an audit ``(table, before, after, difference)``.

    Structures lose the ids and go when none is left; sets go with their dataset,
    and their mapping rows with them.
    """
    out = {}
    if "ds" in tables:
        out["ds"] = filter_not_in(tables["ds"], "id", dataset_ids, keep_null=True)
    if "po" in tables:
        out["po"] = filter_not_in(tables["po"], "dataset_id", dataset_ids, keep_null=True)
    if "co" in tables:
        out["co"] = list_remove(tables["co"], "dataset_ids", list(dataset_ids))
    if "cs" in tables:
        gone = tables["cs"].filter(F.col("dataset_id").isin(*dataset_ids))
        out["cs"] = filter_not_in(tables["cs"], "dataset_id", dataset_ids, keep_null=True)
        if "cs_co_map" in tables:
            ids = gone.select(F.col("id").alias("configuration_set_id"))
            out["cs_co_map"] = tables["cs_co_map"].join(ids, "configuration_set_id", "left_anti")
    audits = [
        audit_counts(tables[name], kept).select(F.lit(name).alias("table"), "*")
        for name, kept in out.items()
    ]
    return out, append_rows(*audits)
