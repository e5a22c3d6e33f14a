"""Projections, filters and edits of rows and columns.

Parquet tables have no update in place: an edit is a projection whose result is
written to a new table and promoted with ``publish_swap``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lists import parse_list
from ..session import staged

SHORT_LIST = 1000  # longer value lists become a join


def rename_prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Prefix the chosen columns (all when not given) with an entity name."""
    chosen = df.columns if cols is None else [c for c in cols if c in df.columns]
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in chosen})


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*cols)


def select_ordered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The final column order."""
    return df.select(*cols)


def typed_table(df: DataFrame, schema: T.StructType, on_error: str = "keep_null") -> DataFrame:
    """Every text-list column to the array type the schema declares, in one projection.

    Columns the schema does not name pass through; scalar columns are cast.
    """
    declared = {f.name: f.dataType for f in schema.fields}

    def typed(field: T.StructField) -> Column:
        wanted = declared.get(field.name, field.dataType)
        if isinstance(wanted, T.ArrayType) and isinstance(field.dataType, T.StringType):
            element = wanted.elementType.simpleString()
            return parse_list(field.name, element, on_error).alias(field.name)
        return F.col(field.name).cast(wanted).alias(field.name)

    return df.select(*[typed(f) for f in df.schema.fields])


def typed_table_with_account(
    df: DataFrame, schema: T.StructType, key: str = "id", on_error: str = "keep_null"
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``typed_table``, the cells that could not be read, and their number per list column.

    The table is written once; its write counts the cells and takes their text along, so nothing is
    parsed or scanned twice. Cells come as ``(key, column, text)``. Each becomes null, or an
    empty list with ``on_error='empty'``.
    """
    if on_error not in ("keep_null", "empty"):
        raise ValueError(f"on_error is keep_null or empty, not {on_error!r}")
    declared = {f.name: f.dataType for f in schema.fields}
    texts = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and isinstance(declared.get(f.name), T.ArrayType)
    ]
    lists = {c: parse_list(c, declared[c].elementType.simpleString(), "keep_null").alias(f"__typed_{c}") for c in texts}
    rows = df.select("*", *lists.values())
    lost = {c: F.col(c).isNotNull() & F.col(f"__typed_{c}").isNull() for c in texts}
    cells = F.array_compact(F.array(*[
        F.when(lost[c], F.struct(F.lit(c).alias("column"), F.col(c).alias("text"))) for c in texts
    ])) if texts else F.lit(None).cast("array<struct<column: string, text: string>>")

    def typed(field: T.StructField) -> Column:
        if field.name in lists:
            found = F.col(f"__typed_{field.name}")
            return (F.when(lost[field.name], F.array().cast(declared[field.name])).otherwise(found) if on_error == "empty" else found).alias(field.name)
        return F.col(field.name).cast(declared.get(field.name, field.dataType)).alias(field.name)

    observation = Observation()
    counts = [F.count_if(lost[c]).alias(c) for c in texts] or [F.count("*").alias("__rows")]
    rows = rows.observe(observation, *counts).select(*[typed(f) for f in df.schema.fields], cells.alias("__cells"))
    written = staged(rows, "typed")
    unreadable = written.filter(F.size("__cells") > 0).select(F.col(key), F.inline("__cells"))
    return written.drop("__cells"), unreadable, {c: observation.get[c] for c in texts}


def filter_eq(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    """Rows where ``col`` equals (or differs from) a value; null matches neither."""
    return df.filter(F.col(col) != value if negate else F.col(col) == value)


def filter_not_in(
    df: DataFrame, col: str, values: Sequence | DataFrame, keep_null: bool = False
) -> DataFrame:
    """Drop rows whose value is in a list, and rows without a value unless ``keep_null``.

    A null in the list drops nothing, however long the list is. Long lists, and lists
    that are themselves tables, are anti joined.
    """
    rows = df if keep_null else df.filter(F.col(col).isNotNull())
    if not isinstance(values, DataFrame):
        values = [v for v in values if v is not None]
        if len(values) <= SHORT_LIST:
            return rows.filter(F.col(col).isNull() | ~F.col(col).isin(*values)) if values else rows
        field = T.StructType([T.StructField(col, df.schema[col].dataType)])
        values = df.sparkSession.createDataFrame([(v,) for v in values], field)
    # A null never equals anything, so the anti join keeps it.
    return rows.join(values.toDF(col).distinct(), col, "left_anti")


def filter_member(df: DataFrame, list_col: str, value) -> DataFrame:
    """Rows whose list holds exactly ``value`` (not a longer id that contains it)."""
    if not isinstance(df.schema[list_col].dataType, T.StringType):
        return df.filter(F.array_contains(list_col, value))
    if re.fullmatch(r"[\w.-]+", value):
        # A plain id stands in the text as it is: the scan can drop most rows
        # before any list is parsed.
        df = df.filter(F.contains(F.col(list_col), F.lit(value)))
    return df.filter(F.array_contains(parse_list(list_col, "string"), value))


def filter_nonempty_list(df: DataFrame, list_col: str) -> DataFrame:
    """Rows whose list is neither null nor empty, be it text or an array."""
    if isinstance(df.schema[list_col].dataType, T.StringType):
        return df.filter(F.col(list_col).isNotNull() & (F.translate(list_col, " ", "") != "[]"))
    return df.filter(F.size(list_col) > 0)


def filter_sql(df: DataFrame, predicate: str) -> DataFrame:
    """Rows for which a SQL predicate holds."""
    return df.filter(predicate)


def update_where(df: DataFrame, predicate: str | Column, col: str, value) -> DataFrame:
    """Set ``col`` to a constant where the predicate holds; other rows keep theirs."""
    matched = F.expr(predicate) if isinstance(predicate, str) else predicate
    dtype = df.schema[col].dataType
    return df.withColumn(col, F.when(matched, F.lit(value).cast(dtype)).otherwise(F.col(col)))


def update_from_map(df: DataFrame, map_df: DataFrame, key: str, col: str) -> DataFrame:
    """Set ``col`` by key from a two-column table ``(key, col)``; unmapped rows keep theirs."""
    new = map_df.select(F.col(key).alias("__key"), F.col(col).alias("__new"))
    joined = df.join(new, F.col(key) == F.col("__key"), "left")
    return joined.withColumn(col, F.coalesce("__new", col)).select(*df.columns)


def update_computed(
    df: DataFrame, ids_df: DataFrame, key: str, exprs: dict[str, Column]
) -> DataFrame:
    """Recompute some columns for the ids in ``ids_df``; other rows keep theirs.

    The computed value replaces the old one even when it is null. One join marks
    the rows, so the costly expressions run only where they are wanted.
    """
    marked = df.join(
        ids_df.select(F.col(key).alias("__key")).distinct(), F.col(key) == F.col("__key"), "left"
    )
    chosen = F.col("__key").isNotNull()
    new = {c: F.when(chosen, e).otherwise(F.col(c)) for c, e in exprs.items()}
    return marked.withColumns(new).select(*df.columns)


def delete_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Delete rows for which the predicate holds; where it is null they stay."""
    matched = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(matched, F.lit(False)))


def add_column(df: DataFrame, name: str, dtype: str | T.DataType, value=None) -> DataFrame:
    """A new typed column, null or constant."""
    return df.withColumn(name, F.lit(value).cast(dtype))


def drop_table_column(df: DataFrame, name: str) -> DataFrame:
    """Take a stored column away; it is an error if it is not there."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r}")
    return df.drop(name)


def cast_timestamp(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Text, or a number of nanoseconds, to a timestamp of microseconds."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.LongType):
        value = F.timestamp_micros(F.expr(f"`{col}` div 1000"))
    elif fmt:
        value = F.to_timestamp(col, fmt)
    else:
        value = F.col(col).cast("timestamp")
    return df.withColumn(col, value)


def stamp_modified(df: DataFrame, col: str = "last_modified") -> DataFrame:
    """Set the modification time to now, in whole seconds."""
    return df.withColumn(col, F.date_trunc("second", F.current_timestamp()))


def set_multiplicity(po: DataFrame, dataset_id: str, value: int) -> DataFrame:
    """Set the multiplicity of one dataset's rows."""
    return update_where(po, F.col("dataset_id") == dataset_id, "multiplicity", value)
