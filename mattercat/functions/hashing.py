"""Content hashes, structure hashes and the ids that follow from them.

The published hash is SHA-512 over the little-endian bytes of the values, printed
as one decimal number. 512-bit decimals and raw bytes of doubles are beyond the
built-in functions, so this is the one place that runs Python: an Arrow UDF whose
buffers are cut by numpy. Null rules and the sorting of atoms stay in Catalyst.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from hashlib import sha512

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lists import as_column

ROUNDING = 16  # decimals kept of site positions in a structure hash

# The UDF below travels with its helpers, so that workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _is_list(kind: pa.DataType) -> bool:
    return pa.types.is_list(kind) or pa.types.is_large_list(kind)


def _is_text(kind: pa.DataType) -> bool:
    return pa.types.is_string(kind) or pa.types.is_large_string(kind)


def _fixed_width(values: pa.Array, decimals: int | None) -> tuple[bytes, int]:
    """All values as one byte string, and the bytes each takes."""
    if pa.types.is_floating(values.type):
        numbers = values.to_numpy(zero_copy_only=False).astype("<f8")
        if decimals is not None:
            numbers = np.round(numbers, decimals)
        return numbers.tobytes(), 8
    if values.null_count:
        raise ValueError("a list of whole numbers or booleans holds a null")
    numbers = values.to_numpy(zero_copy_only=False)
    if pa.types.is_boolean(values.type):
        return numbers.astype("u1").tobytes(), 1
    return numbers.astype("<i8").tobytes(), 8


def hash_bytes(column: pa.Array, decimals: int | None = None) -> list[bytes | None]:
    """The bytes each row of a column adds to a hash; None where it adds nothing.

    Text gives UTF-8, numbers 8 bytes, booleans 1, lists the bytes of their leaves
    in order, lists of text the fixed-width form numpy gives them. Null and the
    text ``[]`` add nothing.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if _is_text(kind):
        return [None if v is None or v == "[]" else v.encode() for v in column.to_pylist()]
    present = column.is_valid().to_numpy(zero_copy_only=False)
    if not _is_list(kind):
        filled = column.fill_null(False if pa.types.is_boolean(kind) else 0)
        data, width = _fixed_width(filled, decimals)
        bounds = np.arange(len(column) + 1)
    else:
        bounds, leaves = column.offsets.to_numpy(), column.values
        while _is_list(leaves.type):
            bounds, leaves = leaves.offsets.to_numpy()[bounds], leaves.values
        if _is_text(leaves.type):
            return [None if v is None else np.array(v).tobytes() for v in column.to_pylist()]
        data, width = _fixed_width(leaves, decimals)
    ends = (bounds * width).tolist()
    return [
        data[start:end] if there else None
        for start, end, there in zip(ends[:-1], ends[1:], present.tolist())
    ]


def _decimal_hashes(columns: Sequence[pa.Array], decimals: Sequence[int | None]) -> pa.Array:
    parts = [hash_bytes(column, d) for column, d in zip(columns, decimals)]
    out = []
    for row in zip(*parts):
        digest = sha512()
        for piece in row:
            if piece is not None:
                digest.update(piece)
        out.append(str(int.from_bytes(digest.digest(), "big")))
    return pa.array(out, pa.string())


def _hash_udf(decimals: tuple[int | None, ...]):
    @F.arrow_udf("string")
    def hashed(*columns: pa.Array) -> pa.Array:
        return _decimal_hashes(columns, decimals)

    return hashed


def hash_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns, if the table has all of them; a missing one would change every hash unseen."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"hash columns {missing} are missing; name the columns to hash")
    return list(columns)


def content_hash(
    df: DataFrame, cols: Sequence[str], out: str = "hash", mode: str = "parity"
) -> DataFrame:
    """Hash of the named columns, taken in name order; nulls are skipped.

    ``parity`` gives the published decimal SHA-512 over bytes. ``neutral`` gives
    SHA-256 over the values as text joined by ``|``: any SQL engine can rebuild
    it, and it runs without Python.
    """
    names = sorted(cols)
    if mode == "neutral":
        texts = [
            F.when(F.col(n).cast("string") != "[]", F.col(n).cast("string")) for n in names
        ]
        return df.withColumn(out, F.sha2(F.concat_ws("|", *texts), 256))
    if mode != "parity":
        raise ValueError(f"mode is parity or neutral, not {mode!r}")
    return df.withColumn(out, _hash_udf((None,) * len(names))(*[F.col(n) for n in names]))


def sort_sites(positions: Column | str, numbers: Column | str) -> Column:
    """Atoms ordered by x, then y, then z: ``array<struct<pos, at, number>>``.

    Atoms at the same place keep their given order (``at``).
    """
    place, number = as_column(positions), as_column(numbers)
    at = F.sequence(F.lit(1), F.size(place))
    sites = F.transform(
        F.arrays_zip(place.alias("pos"), at.alias("at"), number.alias("number")),
        lambda s: F.struct(s["pos"].alias("pos"), s["at"].alias("at"), s["number"].alias("number")),
    )
    return F.when(F.size(place) > 0, F.array_sort(sites))


def structure_hash(
    df: DataFrame, out: str = "structure_hash", numbers: str = "atomic_numbers",
    cell: str = "cell", pbc: str = "pbc", positions: str = "positions", mode: str = "parity",
) -> DataFrame:
    """Hash of a structure that does not depend on the order of its atoms.

    Null where there are no positions.
    """
    sites = df.withColumn("__sites", sort_sites(positions, numbers))
    ordered = [F.col("__sites.number"), F.col(cell), F.col(pbc), F.col("__sites.pos")]
    if mode == "neutral":
        value = F.sha2(F.concat_ws("|", *[F.to_json(c) for c in ordered]), 256)
    else:
        value = _hash_udf((None, None, None, ROUNDING))(*ordered)
    return sites.withColumn(out, F.when(F.col("__sites").isNotNull(), value)).drop("__sites")


def id_from_hash(col: Column | str, prefix: str) -> Column:
    """``PREFIX_`` and the first 25 digits of the hash."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(as_column(col), 1, 25))
