"""Functions of a structure: periodicity and force norms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lists import as_column


def pbc_from_cell(cell: Column | str, mode: str = "cell") -> Column:
    """Periodic axes from the cell.

    ``cell``: all three are periodic when any entry is non-zero. ``axis``: each
    axis is periodic when its own vector is non-zero.
    """
    vectors = as_column(cell)
    nonzero = lambda vector: F.exists(vector, lambda x: x != 0)
    if mode == "axis":
        return F.transform(vectors, nonzero)
    if mode != "cell":
        raise ValueError(f"mode is cell or axis, not {mode!r}")
    return F.when(vectors.isNotNull(), F.array_repeat(F.exists(vectors, nonzero), 3))


def dimension_types(pbc: Column | str) -> Column:
    """1 for a periodic axis, 0 otherwise."""
    return F.transform(as_column(pbc), lambda p: p.cast("int"))


def nperiodic_dimensions(dims: Column | str) -> Column:
    """Number of periodic axes."""
    return F.aggregate(as_column(dims), F.lit(0), lambda total, d: total + d)


def force_norms(
    df: DataFrame, col: str, mean: str = "mean_force_norm", maximum: str = "max_force_norm"
) -> DataFrame:
    """Mean and largest Euclidean norm of n x 3 forces; null without forces.

    A force that is not three numbers wide stops the job.
    """
    def norm(force: Column) -> Column:
        length = F.sqrt(F.aggregate(force, F.lit(0.0), lambda s, x: s + x * x))
        wrong = F.raise_error(F.lit("a force is not three numbers wide")).cast("double")
        return F.when(F.size(force) == 3, length).otherwise(wrong)

    return (
        df.withColumn("__norms", F.transform(col, norm))
        .withColumns({
            mean: F.when(
                F.size("__norms") > 0,
                F.aggregate("__norms", F.lit(0.0), lambda s, x: s + x) / F.size("__norms"),
            ),
            maximum: F.array_max("__norms"),
        })
        .drop("__norms")
    )
