"""Names, paths, licenses, citations and other text of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lists import as_column


def trim_path(col: Column | str, mount: str) -> Column:
    """``<mount>/data/x`` and ``<mount>/MD/x`` to paths below ``data``; others unchanged."""
    path = as_column(col)
    cut = lambda prefix: F.concat(F.lit("data"), F.substr(path, F.lit(len(prefix) + 1)))
    return (
        F.when(path.startswith(f"{mount}/MD"), cut(mount))
        .when(path.startswith(f"{mount}/data"), cut(f"{mount}/data"))
        .otherwise(path)
    )


def id_prefix(col: Column | str, n: int = 6) -> Column:
    """The first ``n`` characters of an id."""
    return F.substring(as_column(col), 1, n)


def number_from_name(names: Column | str, marker: str, start: str, end: str) -> Column:
    """The whole number between ``start`` and ``end`` in the first name holding ``marker``."""
    marked = F.filter(as_column(names), lambda n: F.contains(n, F.lit(marker)))
    name = F.try_element_at(marked, F.lit(1))
    number = F.split_part(F.replace(name, F.lit(start), F.lit("")), F.lit(end), F.lit(1))
    return number.try_cast("int")


def normalize_name(col: Column | str) -> Column:
    """``( ) @ / +`` become ``_`` so that the name can be a folder."""
    return F.translate(as_column(col), "()@/+", "_____")


def display_name(col: Column | str) -> Column:
    """Underscores become spaces."""
    return F.translate(as_column(col), "_", " ")


def normalize_license(col: Column | str) -> Column:
    """The license key a dataset card takes."""
    lower = F.lower(as_column(col))
    return (
        F.when(lower == "nist-pd", "unknown")
        .when(lower == "cc0", "cc0-1.0")
        .otherwise(F.replace(lower, F.lit("-only"), F.lit("")))
    )


def _cited(author: Column) -> Column:
    parts = F.split(author, " ")
    given = F.filter(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: (p != "") & ~((F.left(p, F.lit(1)) == F.lower(F.left(p, F.lit(1))))
                                & (F.left(p, F.lit(1)) != F.upper(F.left(p, F.lit(1))))),
    )
    initials = F.transform(given, lambda p: F.concat(F.left(p, F.lit(1)), F.lit(".")))
    return F.concat(F.element_at(parts, -1), F.lit(", "), F.array_join(initials, " "))


def citation(
    authors: Column | str, name: Column | str, year: Column | str, doi: Column | str, site: str
) -> Column:
    """``Family, F. M., and Family, G. _Name_. Site, year. https://doi.org/x``.

    The last word of an author is the family name; given names that start in lower
    case (``van``, ``de``) are left out.
    """
    cited = F.transform(as_column(authors), _cited)
    last = F.concat(F.lit("and "), F.element_at(cited, -1))
    listed = F.when(
        F.size(cited) > 1, F.concat(F.slice(cited, 1, F.size(cited) - 1), F.array(last))
    ).otherwise(cited)
    absent = F.lit("None")
    return F.concat(
        F.array_join(listed, ", "), F.lit(" _"), display_name(name), F.lit(f"_. {site}, "),
        F.coalesce(as_column(year).cast("string"), absent), F.lit(". https://doi.org/"),
        F.coalesce(as_column(doi), absent),
    )


def present_properties(df: DataFrame) -> Column:
    """Readable names of the numeric ``*count`` columns that are not zero, in column order."""
    counts = [
        f.name for f in df.schema.fields
        if f.name.endswith("count") and isinstance(f.dataType, T.NumericType)
    ]
    shown = [
        F.when(F.col(c) != 0, F.lit(c.replace("_count", "").replace("_", " "))) for c in counts
    ]
    return F.array_join(F.array_compact(F.array(*shown)), ", ") if shown else F.lit("")


def info_fields(df: DataFrame, cols: Sequence[str]) -> Column:
    """The named columns as one JSON object without nulls and empty lists."""
    fields = []
    for name in cols:
        if name not in df.columns:
            continue
        value = F.col(name)
        if isinstance(df.schema[name].dataType, T.ArrayType):
            value = F.when(F.size(name) > 0, value)
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields))


def fill_int_null(df: DataFrame, col: str, value: int | None = None) -> DataFrame:
    """Nulls of a whole-number column to ``value``; unchanged without one."""
    return df if value is None else df.withColumn(col, F.coalesce(col, F.lit(value)))
