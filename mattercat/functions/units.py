"""Unit conversion to eV, angstrom and what follows from them.

A unit text such as ``kcal/mol/angstrom`` is read inside the plan into steps
(multiply or divide by a factor), so conversion is a narrow projection: no join,
no Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lists import parse_list

# CODATA 2014, SI.
LIGHT_SPEED = 299792458.0
MU_0 = 4.0e-7 * math.pi
PLANCK = 6.626070040e-34
CHARGE = 1.6021766208e-19
ELECTRON_MASS = 9.10938356e-31
AVOGADRO = 6.022140857e23
ATOMIC_MASS = 1.660539040e-27

EPS_0 = 1 / MU_0 / LIGHT_SPEED**2
H_BAR = PLANCK / (2 * math.pi)
HARTREE = ELECTRON_MASS * CHARGE**3 / 16 / math.pi**2 / EPS_0**2 / H_BAR**2
BOHR = 4e10 * math.pi * EPS_0 * H_BAR**2 / ELECTRON_MASS / CHARGE**2
PASCAL = (1 / CHARGE) / 1e30
KILOJOULE = 1000.0 / CHARGE
# The unit of time in which eV, angstrom and the atomic mass unit are 1.
SECOND = 1e10 * math.sqrt(CHARGE / ATOMIC_MASS)

FACTORS = {
    "eV": 1.0, "J": 1 / CHARGE, "C": 1 / CHARGE,
    "m": 1e10, "kg": 1 / ATOMIC_MASS, "s": SECOND, "second": SECOND, "fs": 1e-15 * SECOND, "A": 1 / CHARGE / SECOND,
    "alpha": CHARGE**2 / (4 * math.pi * EPS_0) / H_BAR / LIGHT_SPEED, "invcm": 100 * LIGHT_SPEED * PLANCK / CHARGE,
    "hartree": HARTREE, "Hartree": HARTREE, "Ha": HARTREE,
    "rydberg": 0.5 * HARTREE, "Rydberg": 0.5 * HARTREE, "Ry": 0.5 * HARTREE,
    "kJ": KILOJOULE, "kcal": 4.184 * KILOJOULE, "mol": AVOGADRO,
    "angstrom": 1.0, "Angstrom": 1.0, "Ang": 1.0, "nm": 10.0,
    "bohr": BOHR, "Bohr": BOHR,
    "Pascal": PASCAL, "GPa": 1e9 * PASCAL, "bar": 1e5 * PASCAL,
    "kbar": 1e5 * PASCAL * 1000, "kilobar": 1e5 * PASCAL * 1000,
    "debye": 1.0 / 1e11 / CHARGE / LIGHT_SPEED, "Debye": 1.0 / 1e11 / CHARGE / LIGHT_SPEED,
}

ENERGY_STANDARD = ("eV",)
FORCE_STANDARD = ("eV/angstrom", "eV/angstrom^3")
STRESS_STANDARD = ("eV/angstrom^3",)

# Unit texts that are converted by plain arithmetic; any other is read in the plan.
COMMON = (
    "hartree", "Hartree", "Ha", "rydberg", "Rydberg", "Ry", "kcal/mol", "kJ/mol",
    "hartree/bohr", "Hartree/Bohr", "rydberg/bohr", "kcal/mol/angstrom", "kJ/mol/nm",
    "eV/angstrom", "eV/angstrom^3", "kbar", "kilobar", "GPa", "bar", "hartree/bohr^3",
)
STEP = r"[*/]?[A-Za-z]+(?:\^-?[0-9]+)?"
UNIT = r"^[A-Za-z]+(\^-?[0-9]+)?([*/][A-Za-z]+(\^-?[0-9]+)?)*$"

# The conversions are written as SQL text: it is one call to the JVM per column,
# where the same tree built node by node takes hundreds.


def _double(value: float) -> str:
    return f"{value!r}D"


def unit_steps(unit: str, on_error: str = "fail") -> str:
    """SQL: the text of column ``unit`` to ``array<struct<divide, factor>>``, in reading order.

    An exponent belongs to the unit it stands on. Unknown or unreadable units stop
    the job, or give null with ``on_error='null'``.
    """
    table = ", ".join(f"'{name}', {_double(factor)}" for name, factor in FACTORS.items())
    factor = f"try_element_at(map({table}), regexp_extract(t, '[A-Za-z]+', 0))"
    exponent = "regexp_extract(t, '-?[0-9]+$', 0)"
    steps = (
        f"transform(regexp_extract_all(`{unit}`, r'{STEP}', 0), t -> struct(startswith(t, '/') AS divide, "
        f"if({exponent} = '', {factor}, pow({factor}, try_cast({exponent} AS int))) AS factor))"
    )
    usable = (
        f"CASE WHEN `{unit}` RLIKE r'{UNIT}' AND NOT exists({steps}, s -> s.factor IS NULL) THEN {steps} END"
    )
    if on_error == "null":
        return usable
    return f"coalesce({usable}, raise_error(concat('unknown unit: ', coalesce(`{unit}`, 'null'))))"


def _known(value: str, unit: str) -> str:
    """SQL: ``value`` times and over the factors of a common unit, in the order it names them."""
    for divide, name, exponent in re.findall(r"([*/]?)([A-Za-z]+)(?:\^(-?[0-9]+))?", unit):
        factor = FACTORS[name] ** int(exponent or 1)
        if factor != 1.0:
            value = f"{value} {'/' if divide == '/' else '*'} {_double(factor)}"
    return value


def _standard_sql(value: str, unit: str, standard: Sequence[str], on_error: str, nested: bool) -> str:
    """SQL: column ``value`` by the unit of its row; ``nested`` for rows of numbers."""
    def each(number: str) -> str:
        return f"transform(`{value}`, r -> transform(r, x -> {number}))" if nested else number

    x = "x" if nested else f"`{value}`"
    named = ", ".join(f"'{u}'" for u in standard)
    whens = [f"WHEN `{unit}` IN ({named}) THEN `{value}`"] + [
        f"WHEN `{unit}` = '{u}' THEN {each(_known(x, u))}" for u in COMMON if u not in standard
    ]
    # The one-element list binds the steps once per row, not once per number.
    stepped = each(f"aggregate(steps, {x}, (acc, s) -> if(s.divide, acc / s.factor, acc * s.factor))")
    other = f"transform(array({unit_steps(unit, on_error)}), steps -> {stepped})[0]"
    return f"CASE WHEN `{value}` IS NOT NULL THEN CASE {' '.join(whens)} ELSE {other} END END"


def to_standard(
    col: str, unit: str, standard: Sequence[str] = ENERGY_STANDARD, on_error: str = "fail"
) -> Column:
    """A number column in the units of another column to the standard unit; null stays null."""
    return F.expr(_standard_sql(col, unit, standard, on_error, nested=False))


def convert_energy(
    df: DataFrame, cols: Sequence[str], unit_cols: dict[str, str] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Energies to eV. The unit of ``c`` is in ``c_unit`` unless ``unit_cols`` says otherwise."""
    units = unit_cols or {}
    return df.withColumns({
        c: to_standard(c, units.get(c, f"{c}_unit"), on_error=on_error) for c in cols
    })


def convert_reference_energy(
    df: DataFrame, cols: Sequence[str], null_datasets: Sequence[str] = (),
    unit_cols: dict[str, str] | None = None, dataset_col: str = "dataset_id",
    on_error: str = "fail",
) -> DataFrame:
    """Reference energies to eV; null for datasets whose references are known to be wrong."""
    units = unit_cols or {}
    void = F.col(dataset_col).isin(*null_datasets) if null_datasets else F.lit(False)
    # Unknown dataset: the value is kept.
    void = F.coalesce(void, F.lit(False))
    return df.withColumns({
        c: F.when(~void, to_standard(c, units.get(c, f"{c}_unit"), on_error=on_error))
        for c in cols
    })


def add_reference(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Add its reference energy to each energy, where there is one: ``{energy: reference}``."""
    return df.withColumns({
        c: F.when(F.col(ref).isNotNull(), F.col(c) + F.col(ref)).otherwise(F.col(c))
        for c, ref in cols.items()
    })


def convert_array(
    df: DataFrame, col: str, unit_col: str, standard: Sequence[str], on_error: str = "fail"
) -> DataFrame:
    """Forces or stress (text or n x 3 numbers) to the standard unit; null becomes empty."""
    is_text = df.schema[col].dataType.simpleString() == "string"
    # A column of its own, so that the text is read once.
    rows = df.withColumn("__values", parse_list(col, "array<double>", "fail") if is_text else F.col(col))
    converted = F.expr(_standard_sql("__values", unit_col, standard, on_error, nested=True))
    empty = F.array().cast("array<array<double>>")
    return rows.withColumn(col, F.when(F.size("__values") > 0, converted).otherwise(empty)).drop("__values")


def per_atom_to_total(df: DataFrame, cols: dict[str, str], nsites: str = "nsites") -> DataFrame:
    """Multiply by the number of sites where the per-atom flag is true: ``{energy: flag}``."""
    return df.withColumns({
        c: F.when(F.col(flag), F.col(c) * F.col(nsites)).otherwise(F.col(c))
        for c, flag in cols.items()
    })


def choose_energy(
    df: DataFrame, preferred: str = "free_energy", other: str = "potential_energy",
    out: str = "energy",
) -> DataFrame:
    """One energy column: the free energy, else the potential energy."""
    return df.withColumn(out, F.coalesce(preferred, other)).drop(preferred, other)
