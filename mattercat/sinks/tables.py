"""Catalog tables and small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from ..sources.scan import scan_table

TABLES = ("ds", "cs", "co", "po", "cs_co_map")


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    """Write a catalog table; ``mode`` is errorifexists, overwrite or append."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the target's order and types; missing nullable ones come as null."""
    return df.to(schema)


def copy_table(
    spark: SparkSession, src: str, dst: str, mode: str = "errorifexists", path: str | None = None
) -> None:
    """Copy a whole table in one job."""
    save_table(scan_table(spark, src), dst, mode, path)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog has the table."""
    return spark.catalog.tableExists(name)


def create_or_append(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create the table the first time, append afterwards."""
    exists = table_exists(df.sparkSession, name)
    save_table(df, name, "append" if exists else "errorifexists", None if exists else path)


def size_partitions(n: int, rule: str = "rows") -> int:
    """Output partitions for ``n`` rows, a number the dataset row already holds.

    ``rows``: one per 100,000. ``steps``: 2 for small, 4 above 10,000 and one per
    50,000, at least 8, above 100,000.
    """
    if rule == "rows":
        return max(1, n // 100_000)
    if rule != "steps":
        raise ValueError(f"rule is rows or steps, not {rule!r}")
    if n > 100_000:
        return max(8, n // 50_000)
    return 4 if n > 10_000 else 2


def write_clustered(
    df: DataFrame, name: str, sorted_cols: Sequence[str], carry_cols: Sequence[str] | None = None,
    mode: str = "overwrite", path: str | None = None,
) -> None:
    """A copy of a table sorted by other columns, so that point reads skip row groups.

    Range bounds also use a hash of the row, so a sort key that holds very many
    rows is cut over several partitions and each is still sorted by the key.
    """
    cols = list(df.columns) if carry_cols is None else [*sorted_cols, *carry_cols]
    rows = df.select(*cols)
    spread = F.xxhash64(*cols)
    ranged = rows.repartitionByRange(*[F.col(c) for c in sorted_cols], spread)
    save_table(ranged.sortWithinPartitions(*sorted_cols), name, mode, path)


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, mode: str = "overwrite", path: str | None = None
) -> None:
    """A copy hashed and sorted by ``key`` on disk.

    Two tables bucketed alike, such as ``po`` and ``co`` by structure id, join
    without moving either. A key with very many rows makes one large bucket; for
    such tables the shuffled join, which can be cut, is the better one.
    """
    writer = df.repartition(buckets, key).write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def publish_swap(
    spark: SparkSession, date: str, names: Sequence[str] = TABLES, suffix: str = "_tmp",
    schema: str | None = None,
) -> None:
    """Retire each ``t`` to ``t_<date>`` and promote each ``t_tmp`` to ``t``.

    Nothing is renamed when a table to promote is missing or a retired name is taken. Each
    table is promoted right after the old one is retired; if a rename fails, those
    done are undone, last first.
    """
    full = lambda t: f"{schema}.{t}" if schema else t
    absent = [t for t in names if not table_exists(spark, full(f"{t}{suffix}"))]
    taken = [t for t in names if table_exists(spark, full(f"{t}_{date}"))]
    if absent or taken:
        raise ValueError(f"cannot publish: nothing to promote for {absent}, already retired {taken}")
    done: list[tuple[str, str]] = []

    def rename(old: str, new: str) -> None:
        spark.sql(f"ALTER TABLE {full(old)} RENAME TO {full(new)}")
        done.append((old, new))

    try:
        for t in names:
            if table_exists(spark, full(t)):
                rename(t, f"{t}_{date}")
            rename(f"{t}{suffix}", t)
    except Exception:
        for old, new in reversed(done):
            spark.sql(f"ALTER TABLE {full(new)} RENAME TO {full(old)}")
        raise


def export_counts_csv(df: DataFrame, path: str, most: int = 1_000_000) -> None:
    """A small result, such as counts per prefix, as one CSV file with a header; more than ``most`` rows are an error."""
    rows = staged(df, "counts")
    if rows.count() > most:
        raise ValueError(f"more than {most} rows would go through one task")
    rows.repartition(1).write.option("header", True).csv(path)


def export_text_list(df: DataFrame, col: str, path: str) -> None:
    """One value per line; a long list stays spread over files."""
    df.select(F.col(col).cast("string")).filter(F.col(col).isNotNull()).write.text(path)
