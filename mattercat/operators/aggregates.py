"""Counts, dataset statistics, duplicates and audits.

Every aggregate here combines on the map side first, so a dataset or id holding a
third of all rows reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.names import id_prefix
from ..session import staged
from .joins import attach_stats
from .skew import NO_HOT_KEYS, hot_keys, lookup_join
from .states import (
    as_declared, dataset_rows, energy_and_counts, members, property_state, structure_state,
)


def count_by_prefix(
    df: DataFrame, head: str, col: str = "id", length: int = 6, lo: int = 100, hi: int = 999
) -> DataFrame:
    """Rows per id prefix for every prefix ``head + lo`` .. ``head + hi``, zeros included."""
    found = df.groupBy(id_prefix(col, length).alias("prefix")).agg(F.count("*").alias("n"))
    digits = length - len(head)
    number = F.lpad(F.col("id").cast("string"), digits, "0")
    wanted = df.sparkSession.range(lo, hi + 1).select(F.concat(F.lit(head), number).alias("prefix"))
    return (
        wanted.join(found, "prefix", "left")
        .select("prefix", F.coalesce("n", F.lit(0)).alias("count"))
        .orderBy("prefix")
    )


def dataset_energy_stats(po: DataFrame) -> DataFrame:
    """Mean and sample variance of the energy per dataset."""
    return po.groupBy("dataset_id").agg(
        F.avg("energy").alias("energy_mean"), F.var_samp("energy").alias("energy_variance"))


def dataset_property_counts(po: DataFrame) -> DataFrame:
    """Non-null values of each counted property the table has, and rows, per dataset."""
    present = [p for p in S.COUNTED_PROPERTIES if p in po.columns]
    return po.groupBy("dataset_id").agg(
        *[F.count(p).alias(f"{p}_count") for p in present], F.count("*").alias("nproperty_objects"))


def recreate_datasets(
    ds: DataFrame, po: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Statistics columns of ``ds`` made anew from ``po``, in one pass over it, in their declared types."""
    fresh = as_declared(attach_stats(ds, energy_and_counts(property_state(po))))
    return fresh.select(*columns) if columns else fresh


def recalculate_dataset(ds: DataFrame, po: DataFrame, co: DataFrame, cs: DataFrame | None = None) -> DataFrame:
    """Every aggregated column of every dataset made anew; described columns are kept.

    The meaning of four columns follows from their names: ``nconfigurations`` is the
    number of distinct structures, ``nsites`` their sites, ``elements`` the sorted
    union of their elements and ``total_elements_ratios`` each element's share of
    all sites, in the order of ``elements``. With ``cs`` comes ``nconfiguration_sets``.
    Columns have the declared types. ``DatasetStates`` gives the same rows for tables that grow.
    """
    return dataset_rows(ds, property_state(po), structure_state(members(po), co), cs)


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Ids seen more than once, with their counts."""
    return df.groupBy(key).agg(F.count("*").alias("count")).filter(F.col("count") > 1)


POLICIES = ("latest", "first", "union")


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns; maps, which have no order, count as sorted entries."""
    def cell(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.MapType):
            return F.array_sort(F.map_entries(f.name))
        return F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name)

    return F.xxhash64(*[cell(f) for f in df.schema.fields])


def winning_rows(
    df: DataFrame, key: str, columns: Sequence[str], order: str | None, tie: Column | None, newest: bool
) -> DataFrame:
    """``(key, __w0, __w1, ...)``: for each column the hash of the row that its value is taken from.

    Runs over key, order, tie, hash and null flags alone, as fixed-width hash aggregates:
    first the best order of each column, then the best tie and at last the
    largest hash among the rows that reached it. Copies of a row are one row here, and a hot key
    is dealt over tasks, so its rows never meet in one.
    """
    levels = [*([F.col(order)] if order else []), *([] if tie is None else [tie]), row_hash(df)]
    named = [c.alias(f"__l{i}") for i, c in enumerate(levels)]
    flags = [F.col(c).isNotNull().alias(f"__f{i}") for i, c in enumerate(columns)]
    narrow = staged(df.select(key, *named, *flags).distinct(), "versions")
    hot = hot_keys(narrow, key) if len(levels) > 1 else NO_HOT_KEYS
    best: DataFrame | None = None
    for n in range(len(levels)):
        rows = narrow if best is None else lookup_join(narrow, best, key, "inner", hot)
        better = F.max if newest or n == len(levels) - 1 else F.min

        def reached(i: int, n: int = n) -> Column:
            met = F.col(f"__f{i}")
            for earlier in range(n):
                met = met & F.col(f"__l{earlier}").eqNullSafe(F.col(f"__b{earlier}_{i}"))
            return met

        earlier = [F.first(f"__b{m}_{i}", True).alias(f"__b{m}_{i}") for m in range(n) for i in range(len(columns))]
        found = [better(F.when(reached(i), F.col(f"__l{n}"))).alias(f"__b{n}_{i}") for i in range(len(columns))]
        best = rows.groupBy(key).agg(*earlier, *found)
    return staged(best.select(key, *[F.col(f"__b{len(levels) - 1}_{i}").alias(f"__w{i}") for i in range(len(columns))]), "winners")


def merged_lists(df: DataFrame, key: str, list_cols: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """``(key, *list_cols)``: the sorted distinct elements of each list column over all rows of a key.

    Lists of plain values are laid side by side and gathered by one aggregate, which combines before the
    shuffle, so a much-copied id sends only each task's distinct elements. A list that is null in every row stays
    null. Null elements go, or with ``keep_nulls`` come once, before all others.
    """
    plain, alike = [], {}
    for c in list_cols:
        kind = df.schema[c].dataType.elementType
        # Sets tell apart -0.0 and 0.0 inside of nested values, and take no text with a collation.
        nested = isinstance(kind, (T.ArrayType, T.StructType)) or "collate" in kind.simpleString()
        alike.setdefault(kind.simpleString(), []).append(c) if nested else plain.append(c)
    parts = [_merged_alike(df, key, columns, keep_nulls) for columns in alike.values()]
    if plain:
        parts.append(_merged_plain(df, key, plain, keep_nulls))
    return reduce(lambda a, b: a.join(b, key, "full"), parts).select(key, *list_cols)


def _merged_plain(df: DataFrame, key: str, list_cols: Sequence[str], keep_nulls: bool) -> DataFrame:
    """``merged_lists`` for columns of plain values: a row for each place in the lists, with what each has there."""
    kinds = [df.schema[c].dataType.elementType for c in list_cols]
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in list_cols])
    # One row at least, which tells empty lists from null ones.
    last = F.greatest(F.lit(0), *[F.size(c) - 1 for c in list_cols])
    side = df.filter(some).select(key, *list_cols, F.explode(F.sequence(F.lit(0), last)).alias("__at")).select(
        key, *[F.get(c, F.col("__at")).alias(f"__e{i}") for i, c in enumerate(list_cols)],
        *[F.col(c).isNotNull().alias(f"__l{i}") for i, c in enumerate(list_cols)],
        *[(F.col("__at") < F.size(c)).alias(f"__s{i}") for i, c in enumerate(list_cols) if keep_nulls],
    )

    def gathered(i: int, name: str) -> Column:
        item = F.col(f"__e{i}")
        if isinstance(kinds[i], (T.FloatType, T.DoubleType)):
            # Sets hold NaN once for each row, and -0.0 beside 0.0.
            number = F.when(~F.isnan(item), item + F.lit(0.0).cast(kinds[i]))
            nan = F.when(F.max(F.isnan(item)), F.array(F.lit(float("nan")).cast(kinds[i]))).otherwise(F.array().cast(T.ArrayType(kinds[i])))
            items = F.concat(F.array_sort(F.collect_set(number)), nan)
        else:
            items = F.array_sort(F.collect_set(item))
        if keep_nulls:
            null = F.max(F.col(f"__s{i}") & item.isNull())
            items = F.when(null, F.concat(F.array(F.lit(None)), items)).otherwise(items)
        return F.when(F.max(f"__l{i}"), items).alias(name)

    return side.groupBy(key).agg(*[gathered(i, c) for i, c in enumerate(list_cols)])


def _merged_alike(df: DataFrame, key: str, list_cols: Sequence[str], keep_nulls: bool) -> DataFrame:
    """``merged_lists`` for columns of one type, elements deduplicated as rows before they are collected."""
    tagged = F.array(*[
        F.struct(F.lit(i).alias("which"), F.col(c).alias("items")) for i, c in enumerate(list_cols)
    ])
    # An empty list leaves one row without a position, a null list none.
    elements = (
        df.select(key, F.explode(tagged).alias("t")).filter("t.items is not null")
        .select(key, "t.which", F.posexplode_outer("t.items").alias("at", "item"))
        .select(key, "which", F.col("at").isNotNull().alias("some"), "item").distinct()
    )

    def gathered(i: int, name: str) -> Column:
        own = F.col("which") == i
        items = F.array_sort(F.collect_list(F.when(own, F.col("item"))))
        if keep_nulls:
            null = F.count_if(own & F.col("some") & F.col("item").isNull()) > 0
            items = F.when(null, F.concat(F.array(F.lit(None)), items)).otherwise(items)
        return F.when(F.count_if(own) > 0, items).alias(name)

    return elements.groupBy(key).agg(*[gathered(i, c) for i, c in enumerate(list_cols)])


def combine_duplicates(
    df: DataFrame, key: str, list_cols: Sequence[str], order: str | None = None, policy: str = "latest",
    tie: Column | None = None, keep_nulls: bool = False,
) -> DataFrame:
    """One row per id: list columns merged, others by ``policy``.

    ``latest`` takes of each other column the value that is not null from the row with the largest
    ``order``, ``first`` from the one with the smallest. Rows without an order come last
    for both. Among rows of equal order the larger ``tie`` (the smaller with ``first``) decides, an
    expression over the row, and then the larger hash of the row, so that a result repeats and
    columns that tie come from one row. ``union`` turns every other column into the list of its
    distinct values and merges that like a list column.

    Winners are chosen over narrow rows with hash aggregates; wide rows meet only the few that
    win, and copies of those are one. List elements are sorted and distinct; null elements go, or
    come once with ``keep_nulls``. Ids are not null.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {', '.join(POLICIES)}, not {policy!r}")
    plain = [c for c in df.columns if c != key and c not in list_cols]
    if policy == "union":
        listed = df.withColumns({c: F.when(F.col(c).isNotNull(), F.array(c)) for c in plain})
        rows = df.select(key).distinct()
        return rows.join(merged_lists(listed, key, [*list_cols, *plain], keep_nulls), key, "left").select(*df.columns)
    if not plain:
        rows = df.select(key).distinct()
    else:
        best = winning_rows(df, key, plain, order, tie, policy == "latest")
        wins = [F.col(f"__w{i}") for i in range(len(plain))]
        chosen = lookup_join(df.select(key, *plain, row_hash(df).alias("__h")), best, key, "inner").filter(
            F.col("__h").isin(*wins))
        # At most one row per column, whatever the number of copies.
        own = F.struct("__h", *plain)
        taken = chosen.groupBy(key, *wins).agg(F.collect_set(own).alias("__rows"))

        def value(win: Column, name: str) -> Column:
            return F.get(F.filter("__rows", lambda r: r["__h"] == win), F.lit(0))[name].alias(name)

        rows = taken.select(key, *[value(win, c) for win, c in zip(wins, plain)])
        # Ids whose columns are null in every row win nothing.
        nothing = best.filter(F.coalesce(*wins).isNull()).select(key, *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in plain])
        rows = rows.unionByName(nothing)
    if not list_cols:
        return rows.select(*df.columns)
    return rows.join(merged_lists(df, key, list_cols, keep_nulls), key, "left").select(*df.columns)


def distinct_dimensions(rows: DataFrame, key: str = "dataset_id") -> DataFrame:
    """The periodicities that occur in a dataset, on each of its rows.

    The few kinds per dataset are written first, so that their size is known: the
    join then leaves wide rows where they are unless there are very many datasets.
    """
    kinds = rows.select(key, "nperiodic_dimensions", "dimension_types").distinct()
    seen = kinds.groupBy(key).agg(
        F.array_sort(F.collect_set("nperiodic_dimensions")).alias("dataset_nperiodic_dimensions"),
        F.array_sort(F.collect_set("dimension_types")).alias("dataset_dimension_types"),
    )
    return rows.join(staged(seen, "dimensions"), key, "left")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(col).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(col).agg(F.count("*").alias("count"))


def count_where(df: DataFrame, predicate: str | Column, out: str = "count") -> DataFrame:
    """Number of rows for which a predicate holds."""
    matched = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.agg(F.count_if(matched).alias(out))


def distinct_count(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Number of distinct non-null values."""
    return df.agg(F.count_distinct(col).alias(out))


def audit_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after a change, and the difference, from one job."""
    sides = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return sides.agg(
        total("b").alias("before"), total("a").alias("after"),
        (total("b") - total("a")).alias("difference"),
    )


def changed_rows(df: DataFrame, old_col: str, new_col: str) -> DataFrame:
    """Rows whose old and new value differ; null and null are equal."""
    return df.filter(~F.col(old_col).eqNullSafe(F.col(new_col)))


def missing_numbers(df: DataFrame, col: str, n: int) -> DataFrame:
    """Numbers in ``0 .. n-1`` that the data lacks."""
    wanted = df.sparkSession.range(n).withColumnRenamed("id", col)
    return wanted.join(df.select(F.col(col).cast("long")).distinct(), col, "left_anti")
