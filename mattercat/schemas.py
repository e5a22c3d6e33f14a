"""Declared schemas of the five tables and the fixed column lists of their joins.

``co`` structures, ``po`` properties calculated on a structure within a dataset,
``ds`` datasets, ``cs`` named subsets of a dataset, ``cs_co_map`` subset members.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the tables, with their types.
STRING, INT, DOUBLE, BOOL, TIME = (
    T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)
MATRIX = T.ArrayType(T.ArrayType(DOUBLE))


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


PO = _schema(
    id=STRING, hash=STRING, last_modified=TIME, configuration_id=STRING, dataset_id=STRING,
    multiplicity=INT, metadata_id=STRING, metadata_path=STRING, metadata_size=INT,
    software=STRING, method=STRING, chemical_formula_hill=STRING, energy=DOUBLE,
    atomic_forces=MATRIX, cauchy_stress=MATRIX, cauchy_stress_volume_normalized=BOOL,
    electronic_band_gap=DOUBLE, electronic_band_gap_type=STRING, formation_energy=DOUBLE,
    adsorption_energy=DOUBLE, atomization_energy=DOUBLE, energy_above_hull=DOUBLE,
    max_force_norm=DOUBLE, mean_force_norm=DOUBLE,
)

CO = _schema(
    id=STRING, hash=STRING, last_modified=TIME, dataset_ids=T.ArrayType(STRING),
    chemical_formula_hill=STRING, chemical_formula_reduced=STRING,
    chemical_formula_anonymous=STRING, elements=T.ArrayType(STRING),
    elements_ratios=T.ArrayType(DOUBLE), atomic_numbers=T.ArrayType(INT), nsites=INT,
    nelements=INT, nperiodic_dimensions=INT, cell=MATRIX, dimension_types=T.ArrayType(INT),
    pbc=T.ArrayType(BOOL), names=T.ArrayType(STRING), labels=T.ArrayType(STRING),
    metadata_id=STRING, metadata_path=STRING, metadata_size=INT, structure_hash=STRING,
    positions=MATRIX,
)

DS = _schema(
    id=STRING, hash=STRING, name=STRING, authors=T.ArrayType(STRING), description=STRING,
    elements=T.ArrayType(STRING), nelements=INT, nproperty_objects=INT, nconfigurations=INT,
    nsites=INT, adsorption_energy_count=INT, atomic_forces_count=INT,
    atomization_energy_count=INT, cauchy_stress_count=INT, electronic_band_gap_count=INT,
    energy_count=INT, energy_mean=DOUBLE, energy_variance=DOUBLE, formation_energy_count=INT,
    last_modified=TIME, dimension_types=T.ArrayType(T.ArrayType(INT)),
    nperiodic_dimensions=T.ArrayType(INT), publication_year=STRING,
    total_elements_ratios=T.ArrayType(DOUBLE), license=STRING, links=STRING, doi=STRING,
    extended_id=STRING,
)

CS = _schema(id=STRING, name=STRING, description=STRING, dataset_id=STRING)

CS_CO_MAP = _schema(configuration_set_id=STRING, configuration_id=STRING)


def as_text(schema: T.StructType) -> T.StructType:
    """The layout in which every list column is kept as text."""
    return T.StructType([
        T.StructField(f.name, STRING if isinstance(f.dataType, T.ArrayType) else f.dataType, True)
        for f in schema.fields
    ])


# Columns whose content decides an id, in the order they are hashed.
PO_HASH_COLUMNS = [
    "adsorption_energy", "atomic_forces", "atomization_energy", "cauchy_stress",
    "cauchy_stress_volume_normalized", "chemical_formula_hill", "configuration_id",
    "dataset_id", "electronic_band_gap", "electronic_band_gap_type", "energy",
    "formation_energy", "metadata_id", "method", "software",
]
CO_HASH_COLUMNS = ["atomic_numbers", "cell", "metadata_id", "pbc", "positions"]

# The merged property-and-structure row, in its published order.
MERGED_COLUMNS = [
    "property_id", "property_hash", "last_modified", "dataset_id", "multiplicity",
    "software", "method", "energy", "atomic_forces", "cauchy_stress",
    "cauchy_stress_volume_normalized", "electronic_band_gap", "electronic_band_gap_type",
    "formation_energy", "adsorption_energy", "atomization_energy", "max_force_norm",
    "mean_force_norm", "energy_above_hull", "configuration_id", "configuration_hash",
    "structure_hash", "cell", "positions", "pbc", "chemical_formula_hill",
    "chemical_formula_reduced", "chemical_formula_anonymous", "elements",
    "elements_ratios", "atomic_numbers", "nsites", "nelements", "nperiodic_dimensions",
    "dimension_types", "names", "labels", "property_metadata_path",
    "configuration_metadata_path",
]
MERGE_RENAMED = ["id", "hash", "metadata_path"]
MERGE_DROPPED_PO = ["chemical_formula_hill", "metadata_id", "metadata_size"]
MERGE_DROPPED_CO = ["last_modified", "dataset_ids", "metadata_id", "metadata_size"]



def _merged() -> T.StructType:
    """Types of the merged row: those of the property, or of the structure where only that has the column."""
    po, co = ({f.name: f.dataType for f in schema.fields} for schema in (PO, CO))
    types = {
        **{c: t for c, t in co.items() if c not in MERGE_DROPPED_CO}, **{c: t for c, t in po.items() if c not in MERGE_DROPPED_PO},
        **{f"property_{c}": po[c] for c in MERGE_RENAMED}, **{f"configuration_{c}": co[c] for c in MERGE_RENAMED},
    }
    return _schema(**{c: types[c] for c in MERGED_COLUMNS})


MERGED = _merged()

# Properties counted per dataset.
COUNTED_PROPERTIES = [
    "adsorption_energy", "atomic_forces", "atomization_energy", "cauchy_stress",
    "electronic_band_gap", "energy", "formation_energy",
]

# The flat export, row columns first, then dataset columns.
FLAT_ROW_COLUMNS = [
    "chemical_formula_hill", "chemical_formula_reduced", "chemical_formula_anonymous",
    "atomic_numbers", "elements", "elements_ratios", "nelements", "nsites", "cell",
    "positions", "pbc", "dimension_types", "nperiodic_dimensions", "structure_hash",
    "multiplicity", "software", "method", "adsorption_energy", "atomic_forces",
    "atomization_energy", "cauchy_stress", "cauchy_stress_volume_normalized",
    "electronic_band_gap", "electronic_band_gap_type", "energy", "formation_energy",
    "max_force_norm", "mean_force_norm", "property_object_metadata",
    "property_object_metadata_id", "property_object_last_modified", "property_object_hash",
    "property_object_id", "configuration_metadata", "configuration_metadata_id",
    "configuration_labels", "configuration_names", "configuration_dataset_ids",
    "configuration_last_modified", "configuration_hash", "configuration_id",
]
FLAT_DATASET_COLUMNS = [
    "dataset_name", "dataset_authors", "dataset_description", "dataset_elements",
    "dataset_nelements", "dataset_nproperty_objects", "dataset_nconfigurations",
    "dataset_nsites", "dataset_adsorption_energy_count", "dataset_atomic_forces_count",
    "dataset_atomization_energy_count", "dataset_cauchy_stress_count",
    "dataset_electronic_band_gap_count", "dataset_energy_count", "dataset_energy_mean",
    "dataset_energy_variance", "dataset_formation_energy_count", "dataset_last_modified",
    "dataset_dimension_types", "dataset_nperiodic_dimensions", "dataset_publication_year",
    "dataset_total_elements_ratios", "dataset_license", "dataset_links", "dataset_doi",
    "dataset_hash", "dataset_id", "dataset_extended_id",
]
FLAT_SHARED = ["id", "hash", "metadata", "metadata_id", "last_modified"]
FLAT_PREFIXED_CO = ["labels", "names", "dataset_ids"]

# What the text-frame export carries in a frame's comment line.
FRAME_INFO_COLUMNS = [
    "dataset_id", "multiplicity", "software", "method", "energy", "cauchy_stress",
    "cauchy_stress_volume_normalized", "electronic_band_gap", "electronic_band_gap_type",
    "formation_energy", "adsorption_energy", "atomization_energy", "max_force_norm",
    "mean_force_norm", "energy_above_hull", "property_id", "configuration_id", "names",
    "labels",
]
