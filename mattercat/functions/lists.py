"""Lists kept as text: parsing, printing, joining and editing.

Source tables keep lists as the text a Python list prints (``"[[0.0, nan]]"``,
``"['it\\'s', None]"``). Nothing here evaluates that text; it is brought to JSON
and read by ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens that print differently in the source text and in JSON.
TOKENS = {
    "double": {"None": "null", "nan": "NaN", "inf": "Infinity"},
    "int": {"None": "null"},
    "bigint": {"None": "null"},
    "boolean": {"None": "null", "True": "true", "False": "false"},
}

# One quoted string, in either quote style, or the token None.
QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
HEX_ESCAPE = r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _leaf(element: str) -> str:
    while element.startswith("array<"):
        element = element[len("array<"):-1]
    return element


def _parse_strings(text: Column) -> Column:
    escaped = F.when(
        F.contains(text, F.lit(r"\x")), F.regexp_replace(text, HEX_ESCAPE, r"$1\\u00$2")
    ).otherwise(text)
    token = F.transform(
        F.regexp_extract_all(escaped, F.lit(f"{QUOTED}|None"), F.lit(0)),
        lambda t: F.when(t != "None", F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>")[0]),
    )
    # Only text holding None needs the token-wise reading; the parsed list decides
    # between the two so that None inside a quoted string stays text.
    return F.when(
        F.contains(text, F.lit("None")), F.when(text.rlike(r"(?s)^\s*\[.*\]\s*$"), token)
    ).otherwise(F.from_json(escaped, "array<string>"))


def parse_list(
    col: Column | str, element: str, on_error: str = "keep_null"
) -> Column:
    """Text to ``array<element>``; ``element`` is a type text such as ``array<double>``.

    ``on_error`` says what unreadable text becomes: ``keep_null``, ``fail`` (the
    job stops; trailing text after the list counts as unreadable) or ``empty``
    (also for null).
    """
    text = as_column(col)
    target = f"array<{element}>"
    if _leaf(element) == "string":
        parsed = _parse_strings(text)
        outside_quotes = F.regexp_replace(text, QUOTED, "")
    else:
        json = text
        for printed, token in TOKENS[_leaf(element)].items():
            json = F.replace(json, F.lit(printed), F.lit(token))
        parsed = F.from_json(json, target)
        if _leaf(element) != "boolean":
            # Every token above holds an n; most lists of numbers hold none.
            parsed = F.when(F.contains(text, F.lit("n")), parsed).otherwise(F.from_json(text, target))
        outside_quotes = text
    if on_error == "keep_null":
        return parsed
    if on_error == "empty":
        return F.coalesce(parsed, F.array().cast(target))
    if on_error != "fail":
        raise ValueError(f"on_error is keep_null, fail or empty, not {on_error!r}")
    balanced = F.length(F.replace(outside_quotes, F.lit("["), F.lit(""))) == F.length(
        F.replace(outside_quotes, F.lit("]"), F.lit(""))
    )
    message = F.concat(F.lit("not a list: "), F.substring(text, 1, 100))
    return F.coalesce(
        F.when(balanced, parsed),
        F.when(text.isNotNull(), F.raise_error(message).cast(target)),
    )


def parse_matrix(col: Column | str, width: int = 3) -> Column:
    """Text of numbers to rows of ``width`` numbers, whatever the inner brackets say.

    Brackets are dropped and the numbers cut into rows, which repairs lists whose
    inner brackets are damaged. A count that does not divide stops the job.
    """
    text = F.translate(as_column(col), "[] ", "")
    numbers = F.transform(F.split(text, ","), lambda x: x.cast("double"))

    def rows(flat: Column) -> Column:
        count = (F.size(flat) / width).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.slice(flat, i * width + 1, width)
        )
        return F.when(F.size(flat) % width == 0, cut).otherwise(
            F.raise_error(F.lit(f"number count is not a multiple of {width}")).cast("array<array<double>>")
        )

    # The outer one-element transform binds the number list once per row.
    bound = F.transform(F.array(numbers), rows)[0]
    empty = F.array().cast("array<array<double>>")
    return F.when(text == "", empty).when(text.isNotNull(), bound)


def _quoted(text: Column) -> Column:
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", r"\n"), ("\r", r"\r"), ("\t", r"\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit(r"\'")), F.lit("'"))
    only_single = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(only_single, double).otherwise(single)


def _printed(value: Column, element: str) -> Column:
    if element.startswith("array<"):
        return list_to_text(value, element[len("array<"):-1])
    if element == "string":
        return _quoted(value)
    if element == "boolean":
        return F.initcap(value.cast("string"))
    if element == "double":
        return F.when(F.isnan(value), F.lit("nan")).otherwise(
            F.replace(value.cast("string"), F.lit("Infinity"), F.lit("inf"))
        )
    return value.cast("string")


def list_to_text(col: Column | str, element: str = "string", empty_as_null: bool = False) -> Column:
    """``array<element>`` to the text form that ``parse_list`` reads back."""
    values = as_column(col)
    shown = F.transform(values, lambda v: F.coalesce(_printed(v, element), F.lit("None")))
    text = F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
    return F.when(F.size(values) > 0, text) if empty_as_null else text


def concat_chunks(
    df: DataFrame, prefix: str, n: int, out: str, element: str = "array<double>",
    overflow: bool = False,
) -> DataFrame:
    """Join ``prefix_00`` .. ``prefix_<n-1>`` into one list column ``out``.

    Chunks may be text or lists; null chunks are skipped. With ``overflow`` the
    layout is: all in chunk 00, or, once chunk 01 is filled, in chunks 01 onward.
    """
    names = [f"{prefix}_{i:02d}" for i in range(n)]
    types = {f.name: f.dataType for f in df.schema.fields}
    chunks = [
        parse_list(name, element) if isinstance(types[name], T.StringType) else F.col(name)
        for name in names
    ]
    joined = F.flatten(F.array_compact(F.array(*(chunks[1:] if overflow else chunks))))
    if overflow:
        joined = F.when(F.col(names[1]).isNull(), chunks[0]).otherwise(joined)
    return df.withColumn(out, joined).drop(*names)


def list_distinct(col: Column | str) -> Column:
    """Drop repeats; the first of each stays where it was."""
    return F.array_distinct(as_column(col))


def list_remove(df: DataFrame, col: str, values: list[str], drop_empty: bool = True) -> DataFrame:
    """Take ``values`` out of a list column; rows that lose their last element go away.

    Lists may be arrays or text, and keep that form. Rows whose list was null or empty
    before, and elements that are null, stay.
    """
    if not values:
        return df
    gone = F.array(*[F.lit(v) for v in values])
    is_text = isinstance(df.schema[col].dataType, T.StringType)
    items = parse_list(col, "string") if is_text else F.col(col)
    left = F.filter(items, lambda x: x.isNull() | ~F.array_contains(gone, x))
    lost = F.coalesce(F.size(left) < F.size(items), F.lit(False))
    new = list_to_text(left, "string") if is_text else left
    emptied = lost & (F.size(left) == 0)
    kept = df.filter(~emptied) if drop_empty else df
    return kept.withColumn(col, F.when(lost, new).otherwise(F.col(col)))


def list_explode(df: DataFrame, key: str, list_col: str, key_out: str, value_out: str) -> DataFrame:
    """Two-column mapping, one row per element."""
    return df.select(F.col(key).alias(key_out), F.explode(list_col).alias(value_out))


def ensure_list(col: Column | str) -> Column:
    """Text list to a list, other text to a one-element list, null to an empty list."""
    text = as_column(col)
    return F.coalesce(
        parse_list(text, "string"),
        F.when(text.isNotNull(), F.array(text)),
        F.array().cast("array<string>"),
    )


LINKS = "struct<`source-publication`: string, `source-data`: string, other: string>"


def parse_links(col: Column | str) -> Column:
    """Dictionary text to a struct of links; unreadable text gives null links."""
    text = as_column(col)
    # None as a value, i.e. after a colon; None inside quotes is followed by text.
    json = F.regexp_replace(text, r":\s*None\s*(?=[,}])", ": null")
    return F.from_json(json, LINKS)
