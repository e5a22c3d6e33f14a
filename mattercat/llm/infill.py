"""Fill-in-the-middle: documents cut in three and put together in another order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, small_slices

# One match keeps 20 or more bytes for each repetition, so longer texts are matched in
# runs of this many units, each starting where the one before ended.
RUN = 1 << 18
FIXED = "n long, form string, prefix_end long, middle_end long, output binary"


def unit_ends(text: str, whole: regex.Pattern, run: regex.Pattern) -> list[int]:
    """Where each unit of a text ends: the repeated captures of one full match."""
    if len(text) <= RUN:
        match = whole.fullmatch(text)
        if match is None:
            raise ValueError("the units do not cover the whole text")
        return match.ends(1)
    ends: list[int] = []
    while not ends or ends[-1] < len(text):
        found = run.match(text, ends[-1] if ends else 0).ends(1)
        if not found:
            raise ValueError("the units do not cover the whole text")
        ends += found
    return ends


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Refuse marks that could be found across the border of a mark and a text."""
    if len(set(sentinels)) < 3 or "" in sentinels:
        raise ValueError("three different, non-empty sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if (a in b and a != b) or any(a.endswith(b[:k]) for k in range(1, len(b)) if k <= len(a)):
                raise ValueError(f"the end of {a!r} could be taken for the start of {b!r}")


def infill(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = ".", seed: int = 1,
    rate: int = 90, suffix_first: int = 20, sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
) -> DataFrame:
    """Each document with its middle moved to the end: ``(doc_id, text, n, form, prefix_end, middle_end, output)``.

    ``unit`` is a regular expression; a text is ``n`` units, matched left to right. The
    cuts, the share ``rate`` (in 100) that is transformed, and the share ``suffix_first``
    of those that is ``spm`` and not ``psm`` come from four 32-bit groups of the SHA-256
    of ``seed:doc_id``. ``prefix_end`` and ``middle_end`` are code points, null in plain
    form. ``output`` is plain text, or marks and parts in the order of the form.

    Null text is empty; an empty text and one that holds a mark is plain. A null
    doc_id hashes as no characters; repeated rows give repeated results. Bytes that are not
    UTF-8 count as one code point each and stay as they are. Texts of any length are
    matched whole, those above ``RUN`` characters in runs. Other columns are dropped,
    whatever their names; an empty table gives no rows.
    """
    check_sentinels(sentinels)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    group = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), *group)
    p, s, m = sentinels

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = regex.compile(f"({unit})*", regex.DOTALL)
        run = regex.compile(f"({unit}){{0,{RUN}}}+", regex.DOTALL)
        for batch in small_slices(batches, "text"):
            found = []
            h = [batch.column(f"h{i}").to_pylist() for i in (1, 2, 3, 4)]
            for raw, h1, h2, h3, h4 in zip(byte_texts(batch.column("text")), *h):
                t = raw.decode("utf-8", "surrogateescape")
                ends = unit_ends(t, whole, run)
                n = len(ends)
                if not t or h3 % 100 >= rate or any(x in t for x in sentinels):
                    found.append((n, "plain", None, None, raw))
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = (ends[k - 1] if k else 0 for k in (low, high))
                if h4 % 100 < suffix_first:
                    form, out = "spm", f"{s}{t[b:]}{p}{t[:a]}{m}{t[a:b]}"
                else:
                    form, out = "psm", f"{p}{t[:a]}{s}{t[b:]}{m}{t[a:b]}"
                found.append((n, form, a, b, out.encode("utf-8", "surrogateescape")))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            names = ["n", "form", "prefix_end", "middle_end", "output"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(transform, f"doc_id {kind}, {FIXED}").withColumn("output", F.col("output").cast("string"))


def restored(
    output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")
) -> Column:
    """The document that an ``output`` of ``infill`` was made from, by its form."""
    p, s, m = sentinels
    out, psm = F.col(output), F.col(form) == "psm"

    def between(first: str, last: str) -> Column:
        return F.substring_index(F.substring_index(out, first, -1), last, 1)

    prefix = F.when(psm, between(p, s)).otherwise(between(p, m))
    suffix = F.when(psm, between(s, m)).otherwise(between(s, p))
    return F.when(F.col(form) == "plain", out).otherwise(F.concat(prefix, F.substring_index(out, m, -1), suffix))
