"""Sorts, limits and row choices; an order is always given, so results repeat."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged

BINS = 1024  # of a histogram, counted in one pass
CHUNK = 6    # bytes of a text that are one number
SHRUNK = 4   # times fewer rows are worth writing


def order_by(df: DataFrame, col: str, desc: bool = False) -> DataFrame:
    """Global sort by one column.

    Ties are ordered by a hash of the row, so that a value held by very many rows
    is sorted by several tasks, and the order repeats.
    """
    return df.orderBy(F.col(col).desc() if desc else F.col(col).asc(), F.xxhash64(*df.columns))


def _codes(df: DataFrame, order: Sequence[str], begin: Callable[[str | None], int]) -> Iterator[tuple[Column, bool]]:
    """Numbers that order rows like ``order`` and a hash of the row, most significant first, each with whether it is whole.

    Nulls come first. A text is cut in groups of six bytes, a floating-point number comes as its class
    and its value. A type that has no such numbers ends the list: what is open then has to be sorted.
    ``begin`` is called before each column, and before the hash with none; of a text it gives the most bytes.
    """
    for name in order:
        kind, col, longest = df.schema[name].dataType, F.col(name), begin(name)
        yield F.when(col.isNull(), 0).otherwise(1).cast("bigint"), True
        if isinstance(kind, T.StringType):
            for at in range(1, longest + 1, CHUNK):
                part = F.substring(col.cast("binary"), at, CHUNK)
                # One digit in front, so that the end of a text comes before a zero byte.
                digits = F.rpad(F.hex(part), 2 * CHUNK, "0")
                yield F.coalesce(F.conv(digits, 16, 10).cast("bigint") * (CHUNK + 1) + F.octet_length(part), F.lit(0)), True
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            yield F.coalesce(col.cast("bigint"), F.lit(0)), True
        elif isinstance(kind, T.DateType):
            yield F.coalesce(F.unix_date(col).cast("bigint"), F.lit(0)), True
        elif isinstance(kind, T.TimestampType):
            yield F.coalesce(F.unix_micros(col), F.lit(0)), True
        elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            value, top = col.cast("double"), F.lit(float("inf"))
            yield F.when(F.isnan(value), 3).when(value == top, 2).when(value == -top, 0).otherwise(1).cast("bigint"), True
            finite = ~F.isnan(value) & (F.abs(value) != top)
            yield F.coalesce(F.when(finite, value), F.lit(0.0)), False
        else:
            return
    begin(None)
    yield F.xxhash64(*df.columns), True


def _text_ends(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """From one pass over a text column: its first and last value and null, as rows, and the most bytes.

    All texts share the bytes these two share, so a number of ``_codes`` is least and largest here, if those before it are constant.
    """
    data = F.col(name).cast("binary")
    count, there, low, high, longest = df.agg(
        F.count("*"), F.count(name), F.min(data), F.max(data), F.max(F.octet_length(name))).first()
    known = ([low, high] if there else []) + ([None] if there < count else [])
    text = F.explode(F.array(*[F.lit(v if v is None else bytes(v)).cast("binary") for v in known]))
    ends = df.sparkSession.range(0, 1, 1, 1).select(text.alias("text"))
    return ends.select(F.col("text").cast(df.schema[name].dataType).alias(name)), longest or 0


def _below(df: DataFrame, n: int, order: Sequence[str], gather: int) -> tuple[DataFrame, Column, Column, int]:
    """Rows that hold the first ``n``, which of them are surely among these, which are still open, and how many of the open rows are.

    Counts rows by bins of one number after the other. Only the bin that row ``n`` falls into is
    open afterwards and is counted by finer bins, until it holds ``gather`` rows or none are left to tell apart.
    Once the rows up to the end of that bin are ``SHRUNK`` times fewer than those read, they are written and all else is done on them.
    """
    wanted, taken, open_ = n, F.lit(False), F.lit(True)
    ends: DataFrame | None = None
    count = held = df.count()
    storable = "void" not in df.schema.simpleString()  # a column of nulls alone has no type to write

    def begin(name: str | None) -> int:
        nonlocal ends
        ends, longest = None, 0
        if name is not None and isinstance(df.schema[name].dataType, T.StringType):
            ends, longest = _text_ends(df.filter(open_), name)
        return longest

    if count <= n:
        return df, F.lit(True), F.lit(False), 0
    for code, whole in _codes(df, order, begin):
        while True:
            if count <= gather:
                return df, taken, open_, n
            low, high = (df.filter(open_) if ends is None else ends).select(code.alias("c")).agg(F.min("c"), F.max("c")).first()
            if low == high:
                break
            if whole:
                # The number may be any long, so differences are taken as decimals.
                width = -(-(high - low + 1) // BINS)
                number = F.floor((code.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("int")
            else:
                # The difference of two doubles may be beyond the largest one; halves are not.
                part = 1.0 if math.isfinite(high - low) else 0.5
                share = (code * part - low * part) / (high * part - low * part)
                number = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
            bins = df.filter(open_).groupBy(number.alias("bin")).agg(F.count("*").alias("n")).orderBy("bin").collect()
            for found in bins:
                if found["n"] > n:
                    break
                n -= found["n"]
            else:
                return df, taken | open_, F.lit(False), 0
            if n == 0 and found["bin"] == bins[0]["bin"]:
                return df, taken, F.lit(False), 0
            upto = taken | (open_ & (number <= found["bin"]))
            taken, open_ = taken | (open_ & (number < found["bin"])), open_ & (number == found["bin"])
            ends, count = None, found["n"]
            if storable and (wanted - n + count) * SHRUNK <= held:
                df, held = staged(df.filter(upto), "nearest"), wanted - n + count
            if n == 0:
                return df, taken, F.lit(False), 0
            if len(bins) == 1:
                break
    return df, taken, open_, n


def limit_rows(df: DataFrame, n: int, order: Sequence[str], gather: int = 1000) -> DataFrame:
    """The first ``n`` rows under an order, as a test table; the rows come in no stated order.

    Nulls come first. Ties are ordered by a hash of the row, so the choice repeats. Up to ``gather`` rows are
    a top-k, of which each task sends as many to one. For more, row ``n`` is found by counting:
    a histogram of the order, then one of the bin that holds it, and so on, over the columns
    of the order alone; once few rows are left of the table, they are written and only they are read.
    All rows below are then taken, and of the last ``gather`` or fewer the first ones. Only rows that no number
    tells apart, such as equal ones, are sorted. All ways give the same rows.
    """
    ordering = [*order, F.xxhash64(*df.columns)]
    if n <= gather:
        return df.orderBy(*ordering).limit(n)
    df, taken, open_, rest = _below(df, n, order, gather)
    chosen = df.filter(taken)
    if not rest:
        return chosen
    last = df.filter(open_)
    return chosen.unionAll(last.orderBy(*ordering).limit(rest) if rest <= gather else _cut_sorted(last, rest, ordering))


def _cut_sorted(df: DataFrame, n: int, ordering: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows cut from the sorted table, written once.

    A row's place is the rows of the files before its own plus its index in the file, so no task gathers ``n`` rows.
    """
    ordered = staged(df.orderBy(*ordering), "sorted", maxRecordsPerFile=0)
    name = F.col("_metadata.file_name")
    # part-<task>-<job>.c<file of the task>.<codec>.parquet
    part = F.regexp_extract(name, r"part-(\d+)", 1).cast("int")
    file = F.coalesce(F.regexp_extract(name, r"[.-]c(\d+)\.", 1).cast("int"), F.lit(0))
    numbered = ordered.select("*", F.struct(part, file, name).alias("__file"), F.col("_metadata.row_index").alias("__at"))
    earlier = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("__file").agg(F.count("*").alias("__n")).select(
        "__file", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    placed = numbered.join(offsets, "__file").filter(F.col("__before") + F.col("__at") < n)
    return placed.select(*df.columns)


def nth_by_size(ds: DataFrame, n: int, size: str = "nconfigurations", key: str = "id") -> DataFrame:
    """The n-th dataset (from 0) when sorted by size, ties by key."""
    return ds.orderBy(size, key).offset(n).limit(1)


def first_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row, the first under an order."""
    return df.orderBy(*order).limit(1)


def reverse_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows in reverse order; ties as in ``order_by``."""
    return df.orderBy(*[F.col(c).desc() for c in order], F.xxhash64(*df.columns))
