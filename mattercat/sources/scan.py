"""Scans: tables, id selections and id lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet path (anything with a slash)."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet folder, with a declared schema if given."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only the named columns; the scan reads no others."""
    return df.select(*cols)


def scan_id_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Rows whose key starts with ``prefix``; reaches the Parquet scan as a pushed filter."""
    return df.filter(F.col(col).startswith(prefix))


def scan_id_list(df: DataFrame, ids_df: DataFrame, on: str) -> DataFrame:
    """Rows whose id is in a list of any length: one semi join, no batches."""
    return df.join(ids_df.select(on).distinct(), on, "left_semi")


def scan_by_dataset(df: DataFrame, dataset_id: str, col: str = "dataset_id") -> DataFrame:
    """All rows of one dataset."""
    return df.filter(F.col(col) == dataset_id)


def scan_dataset_and_prefix(df: DataFrame, dataset_id: str, col: str, prefix: str) -> DataFrame:
    """Rows of one dataset whose key starts with ``prefix``; both filters are pushed."""
    return df.filter((F.col("dataset_id") == dataset_id) & F.col(col).startswith(prefix))


def scan_csv_ids(spark: SparkSession, path: str, col: str = "id") -> DataFrame:
    """Id list from CSV files with a header. Everything is read as text."""
    return spark.read.option("header", True).csv(path).select(col)


def scan_text_ids(
    spark: SparkSession, path: str, start: int = 0, stop: int | None = None, header: bool = True
) -> DataFrame:
    """Ids ``start:stop`` of a text list, in line order: ``(position, id)``.

    Lines are trimmed, blank ones dropped, the first comma-separated field kept and
    the header line of the list skipped. Positions come from per-split row counts,
    so no task sees the whole list; the window below runs over one row per split.
    """
    lines = (
        spark.read.text(path)
        .select(F.trim("value").alias("line"), "_metadata.file_path", "_metadata.file_block_start")
        .filter(F.col("line") != "")
        .withColumn("at", F.monotonically_increasing_id())
    )
    split = ["file_path", "file_block_start"]
    totals = lines.groupBy(*split).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *split, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    position = F.col("offset") + F.col("at") - F.col("first") - F.lit(1 if header else 0)
    ids = lines.join(offsets, split).select(
        position.alias("position"), F.split_part("line", F.lit(","), F.lit(1)).alias("id")
    )
    ids = ids.filter(F.col("position") >= start)
    return ids if stop is None else ids.filter(F.col("position") < stop)


def rows_to_df(
    spark: SparkSession, rows: DataFrame | Iterable, schema: T.StructType
) -> DataFrame:
    """Rows under a declared schema; whole numbers that arrive as floats are cast back.

    ``rows`` is a DataFrame whose types drifted, or a short list of rows typed in
    by hand. Null stays null; NaN in a whole-number column, which is how a null
    comes out of a float detour, becomes null.
    """
    whole = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
    if not isinstance(rows, DataFrame):
        drifted = T.StructType([
            T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, whole) else f.dataType, True)
            for f in schema.fields
        ])
        rows = spark.createDataFrame(
            [tuple(float(v) if isinstance(f.dataType, whole) and v is not None else v
                   for v, f in zip(row, schema.fields)) for row in rows],
            drifted,
        )
    types = {f.name: f.dataType for f in rows.schema.fields}

    def restored(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, whole) and isinstance(types[field.name], (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        return value.cast(field.dataType).alias(field.name)

    return rows.select(*[restored(f) for f in schema.fields])
