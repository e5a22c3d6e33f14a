"""From properties in their own units to standard energies, forces and stress."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .. import schemas as S
from ..functions.hashing import content_hash, hash_columns, id_from_hash
from ..functions.units import (
    FORCE_STANDARD, STRESS_STANDARD, add_reference, choose_energy, convert_array,
    convert_energy, convert_reference_energy, per_atom_to_total,
)
from ..operators.aggregates import recreate_datasets
from ..operators.joins import attach_nsites
from ..session import staged

REFERENCED = ["potential_energy", "free_energy", "adsorption_energy", "atomization_energy", "formation_energy"]


def _suffixed(names: list[str], suffix: str) -> dict[str, str]:
    return {n: f"{n}{suffix}" for n in names}


@dataclass
class Layout:
    """Which columns hold energies, their units, references and per-atom flags."""

    energies: list[str] = field(default_factory=lambda: REFERENCED + ["electronic_band_gap"])
    references: dict[str, str] = field(default_factory=lambda: _suffixed(REFERENCED, "_reference"))
    per_atom: dict[str, str] = field(default_factory=lambda: _suffixed(REFERENCED, "_per_atom"))
    units: dict[str, str] = field(default_factory=dict)
    arrays: dict[str, tuple] = field(default_factory=lambda: {
        "atomic_forces": FORCE_STANDARD, "cauchy_stress": STRESS_STANDARD,
    })
    null_datasets: tuple[str, ...] = ()
    hash_columns: list[str] = field(default_factory=lambda: list(S.PO_HASH_COLUMNS))

    def unit_of(self, col: str) -> str:
        return self.units.get(col, f"{col}_unit")


def standard_values(po: DataFrame, co: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Energies as totals in eV, references added, arrays converted, helper columns dropped."""
    lay = layout or Layout()
    references = sorted(set(lay.references.values()))
    units = {c: lay.unit_of(c) for c in [*lay.energies, *references]}
    out = convert_energy(po, lay.energies, units)
    out = convert_reference_energy(out, references, lay.null_datasets, units)
    out = add_reference(out, lay.references)
    for col, standard in lay.arrays.items():
        out = convert_array(out, col, lay.unit_of(col), standard)
    out = out.drop(*references, *units.values(), *[lay.unit_of(c) for c in lay.arrays])
    out = attach_nsites(out, co)
    out = per_atom_to_total(out, lay.per_atom)
    return choose_energy(out.drop("nsites", *lay.per_atom.values()))


def standardize_properties(
    po: DataFrame, co: DataFrame, ds: DataFrame, layout: Layout | None = None
) -> tuple[DataFrame, DataFrame]:
    """Standard properties under new hashes and ids, and datasets with fresh statistics.

    Every column of ``layout.hash_columns`` must be there, so that an id never depends on
    what a table happens to have; name other columns in the layout where it has fewer.

    The old hash is kept in ``old_hash`` where there was one. The properties are
    written to the shared folder once; statistics then read only their columns.
    """
    lay = layout or Layout()
    values = standard_values(po, co, lay)
    if "hash" in values.columns:
        values = values.withColumnRenamed("hash", "old_hash")
    columns = hash_columns(values, lay.hash_columns)
    hashed = content_hash(values, columns)
    properties = staged(hashed.withColumn("id", id_from_hash("hash", "PO")), "standard-properties")
    return properties, recreate_datasets(ds, properties)
