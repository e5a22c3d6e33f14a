"""Correct the periodicity of structures, and every id that follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.hashing import content_hash, hash_columns, id_from_hash, structure_hash
from ..functions.structures import dimension_types, nperiodic_dimensions, pbc_from_cell
from ..operators.joins import remap_foreign_key
from ..session import staged


def rehashed(
    co: DataFrame, mode: str = "parity", columns: Sequence[str] = S.CO_HASH_COLUMNS
) -> DataFrame:
    """``co`` with ``new_id``, ``new_hash`` and ``new_struct_hash`` from its content."""
    hashed = content_hash(co, hash_columns(co, columns), "new_hash", mode)
    hashed = structure_hash(hashed, "new_struct_hash", mode=mode)
    return hashed.withColumn("new_id", id_from_hash("new_hash", "CO"))


def fix_pbc_and_rehash(
    co: DataFrame, po: DataFrame, mode: str = "parity",
    po_hash_columns: Sequence[str] = tuple(S.PO_HASH_COLUMNS),
    co_hash_columns: Sequence[str] = tuple(S.CO_HASH_COLUMNS),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(co, po, map)`` with periodicity from the cell and new hashes and ids.

    Old and new id stand on the same row of ``co``, so its own ids change without a
    join. That table is written to the shared folder once, since hashing is the
    costly part, and the map ``(id, new_id, new_hash, new_struct_hash)`` is four of
    its columns. Only the foreign key of ``po`` needs a join.
    """
    fixed = co.withColumn("pbc", pbc_from_cell("cell"))
    fixed = fixed.withColumn("dimension_types", dimension_types("pbc"))
    fixed = fixed.withColumn("nperiodic_dimensions", nperiodic_dimensions("dimension_types"))
    both = staged(rehashed(fixed, mode, co_hash_columns), "rehashed-structures")
    mapping = both.select("id", "new_id", "new_hash", "new_struct_hash")

    new = {"id": "new_id", "hash": "new_hash", "structure_hash": "new_struct_hash"}
    new_co = both.withColumns({old: F.col(c) for old, c in new.items()}).drop(*new.values())
    moved = remap_foreign_key(po, mapping)
    hashed = content_hash(moved, hash_columns(moved, po_hash_columns), "hash", mode)
    new_po = hashed.withColumn("id", id_from_hash("hash", "PO"))
    return new_co, new_po, mapping
