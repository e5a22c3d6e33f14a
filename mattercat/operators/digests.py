"""Which rows of a large table differ from its copy, found down a tree of digests.

A digest of a set of rows is their number and the sum of their 64-bit row hashes. Sums do
not depend on order or layout, and those of parts add up to that of the whole. The tree has one
level per length of id prefix: two tables are compared at its top, and only below
prefixes that differ. What is left are short lists of ids; equal tables end at the top.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import staged
from .aggregates import row_hash

LENGTHS = (0, 5, 7, 9)  # of the prefixes of each level; 0 is the whole table
NAMED = 500             # prefixes that are named in a filter, so that files without them are skipped
HALF = (1 << 32) - 1


def content_hash_of(df: DataFrame, content: Sequence[str] | None = None) -> Column:
    """The row hash over the named columns, or all of them by name, whatever their order."""
    return row_hash(df.select(*sorted(df.columns if content is None else content)))


def _sums(hashed: Column | str) -> list[Column]:
    """Count and hash sum, in two halves: a sum of 32-bit halves fits a long for two billion rows of a leaf."""
    h = F.col(hashed) if isinstance(hashed, str) else hashed
    zero = F.lit(0)
    return [
        F.count("*").alias("n"), F.coalesce(F.sum(F.shiftrightunsigned(h, 32).cast("decimal(19,0)")), zero).alias("high"),
        F.coalesce(F.sum(h.bitwiseAND(F.lit(HALF)).cast("decimal(19,0)")), zero).alias("low"),
    ]


def table_digest(df: DataFrame, content: Sequence[str] | None = None) -> tuple:
    """Count and hash sums of all rows, in one pass over the content."""
    return tuple(df.agg(*_sums(content_hash_of(df, content))).first())


def observed_digest(df: DataFrame, content: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The table with its digest taken along: read it from the observation once the table is written.

    ``tuple(observation.get.values())`` is then what ``table_digest`` gives, without a scan of its own.
    """
    observation = Observation()
    return df.observe(observation, *_sums(content_hash_of(df, content))), observation


def digest_tree(
    df: DataFrame, key: str = "id", lengths: Sequence[int] = LENGTHS, content: Sequence[str] | None = None
) -> DataFrame:
    """``(level, prefix, n, high, low)`` for each prefix of ``key`` of each length; a null key has prefix ``''``.

    One pass over the content makes the longest prefixes; shorter ones are sums of these. With ``content``
    of an id and a stored hash, two columns are all that is read.
    """
    if list(lengths) != sorted(set(lengths)):
        raise ValueError("lengths of prefixes go up")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    leaves = df.select(F.substring(text, 1, lengths[-1]).alias("prefix"), content_hash_of(df, content).alias("h"))
    leaves = staged(leaves.groupBy("prefix").agg(*_sums("h")), "leaves")
    levels = [
        leaves.groupBy(F.substring("prefix", 1, length).alias("prefix")).agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
        for length in lengths[:-1]
    ]
    kinds = ["prefix", F.col("n").cast("bigint").alias("n"), *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("high", "low")]]
    return reduce(DataFrame.unionAll, [
        level.select(F.lit(i).alias("level"), *kinds) for i, level in enumerate([*levels, leaves])])


def differing_prefixes(before: DataFrame, after: DataFrame, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """``(prefix, n_before, n_after)``: the longest prefixes whose digests differ between two trees.

    Each level is compared only below the prefixes that differ above it.
    """
    found: DataFrame | None = None
    for i, length in enumerate(lengths):
        sides = []
        for tree in (before, after):
            rows = tree.filter(F.col("level") == i)
            if found is not None:
                above = found.select(F.col("prefix").alias("above"))
                rows = rows.join(above, F.substring("prefix", 1, lengths[i - 1]) == F.col("above"), "left_semi")
            sides.append(rows)
        a, b = sides[0].alias("a"), sides[1].alias("b")
        same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "high", "low")])
        found = staged(a.join(b, "prefix", "full").filter(~same).select(
            "prefix", F.coalesce("a.n", F.lit(0)).alias("n_before"), F.coalesce("b.n", F.lit(0)).alias("n_after")), "differing")
        if not found.take(1):
            return found
    return found


def changed_ids(
    before: DataFrame, after: DataFrame, key: str = "id", lengths: Sequence[int] = LENGTHS, content: Sequence[str] | None = None
) -> DataFrame:
    """``(key, n_before, n_after)``: ids whose rows are not the same in both tables, with their rows in each.

    A changed row counts in both; an id that is only in one has 0 in the other. Repeated rows count as often
    as they occur; null is an id like any other. Rows are compared by 64-bit hashes of ``content``, by default
    all columns by name. Only rows below differing prefixes are read a second time.
    """
    trees = [staged(digest_tree(t, key, lengths, content), "tree") for t in (before, after)]
    prefixes = differing_prefixes(*trees, lengths).select("prefix")
    named = [r["prefix"] for r in prefixes.limit(NAMED + 1).collect()]
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))

    def below(df: DataFrame, side: int) -> DataFrame:
        own = F.substring(text, 1, lengths[-1])
        if not named:
            rows = df.limit(0)
        elif len(named) <= NAMED:
            # A range of ids lets readers skip files and row groups; null ids have the empty prefix.
            least = F.lit(False) if min(named) else F.col(key).isNull()
            rows = df.filter(least | (F.col(key).cast("string") >= min(named))).filter(own.isin(*named))
        else:
            rows = df.join(prefixes.withColumnRenamed("prefix", "__prefix"), own == F.col("__prefix"), "left_semi")
        counted = [F.lit(1 - side).alias("b"), F.lit(side).alias("a")]
        return rows.select(F.col(key), content_hash_of(df, content).alias("h"), *counted)

    rows = below(before, 0).unionAll(below(after, 1))
    # Per id and row first, so that rows that are the same on both sides cancel out.
    counts = rows.groupBy(key, "h").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    per_id = counts.groupBy(key).agg(
        F.sum("b").alias("n_before"), F.sum("a").alias("n_after"), F.count_if(F.col("a") != F.col("b")).alias("n_other"))
    return per_id.filter("n_other > 0").select(key, "n_before", "n_after")
