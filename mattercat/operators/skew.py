"""Look-up joins that stay even when one key holds a large share of the rows.

Adaptive execution cuts an oversized shuffle partition, but every cut reads the
whole partition of the other side again. With a third of a huge table on one key
that is far too much, so such keys are found first and dealt over many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 5_000_000  # rows of one key that one task may take
SKETCH_ITEMS = 1024        # any key above about 1/750 of all rows is found
MOST_KEYS = 256            # keys dealt out; what is below them is for adaptive execution
MERGERS = 256              # sketches are merged by this many tasks, then by one


NO_HOT_KEYS: dict = {}


def hot_keys(df: DataFrame, key: str, rows_per_task: int | None = None) -> dict:
    """``{key value: parts}`` for the keys with more rows than one task should take.

    One pass over one column with a frequent-items sketch per task; null counts as
    a value. At most ``MOST_KEYS`` values come to the driver. Counts are estimates:
    they decide where rows go, never which rows there are.
    """
    limit = rows_per_task or ROWS_PER_TASK
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {SKETCH_ITEMS})").alias("sketch")
    )
    # Grouped, so that an empty table has no group and not an empty sketch.
    top = sketches.groupBy(F.lit(1)).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {SKETCH_ITEMS}), {MOST_KEYS})").alias("top")
    ).first()
    return {row["item"]: -(-row["count"] // limit) for row in (top and top["top"]) or [] if row["count"] > limit}


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: dict | None = None
) -> DataFrame:
    """Join many rows of ``left`` to the one row of ``right`` with their key.

    Rows of a hot key are dealt into parts by their place in the input, so that equal rows and
    columns of any type are dealt too, and its one row on the
    right is repeated for each part. Rows without a key are dealt alike. ``how`` is
    left or inner. Pass ``hot`` if the hot keys are known, or ``NO_HOT_KEYS``; otherwise
    they are looked for now, in a job of its own over the key column.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    known = {k: parts for k, parts in hot.items() if k is not None}
    dtype = left.schema[key].dataType

    def parts(column: Column) -> Column:
        table = F.create_map(*[x for k, n in known.items() for x in (F.lit(k).cast(dtype), F.lit(n))])
        of_key = F.try_element_at(table, column) if known else F.lit(None).cast(T.IntegerType())
        return F.coalesce(of_key, F.lit(1))

    of_row = F.when(F.col(key).isNull(), F.lit(hot.get(None, 1))).otherwise(parts(F.col(key)))
    part = F.when(of_row > 1, F.pmod(F.xxhash64(F.monotonically_increasing_id()), of_row)).otherwise(0).cast("int")
    every = F.explode(F.sequence(F.lit(0), parts(F.col(key)) - 1))
    dealt = left.withColumn("__part", part)
    return dealt.join(right.withColumn("__part", every), [key, "__part"], how).drop("__part")
