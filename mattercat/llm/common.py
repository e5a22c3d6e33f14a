"""Shared helpers: staged tables, Arrow batches as Python values, components of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mattercat.session import scratch, staged

__all__ = ["staged", "scratch", "small_slices", "byte_texts", "only", "forest", "components"]

SLICE_BYTES = 1 << 20  # text that a worker unpacks at a time


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names; everything else, whatever it is called, goes.

    ``only(df, doc_id="id", text="body")`` gives ``(doc_id, text)``.
    """
    return df.select(*[df[name].alias(alias) for alias, name in columns.items()])


def small_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut where ``column`` holds about ``SLICE_BYTES`` of text.

    A row is never cut: a text longer than that comes alone.
    """
    for batch in batches:
        sizes = np.array([x or 0 for x in pa.compute.binary_length(batch.column(column)).to_pylist()], "i8")
        part = np.cumsum(sizes) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for first, last in zip(edges, edges[1:]):
            if last > first:
                yield batch.slice(first, last - first)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return [x or b"" for x in column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(node, root)`` that join the same nodes as the given links; roots are smallest."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left):]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def components(links: DataFrame) -> DataFrame:
    """Every linked node with the smallest node it can reach: ``(node, component)``.

    ``links`` holds two columns of longs, in any order and with repeats; nodes
    without a link are not returned. Alternates the large-star and small-star steps:
    each node hands its larger, then its smaller neighbours to the smallest one, until
    all links end in the smallest node of their component. Each step's minima and links
    are written to the shared folder: sizes are known to the next joins, so a node with
    very many links is split by adaptive execution, and a lost executor costs one step.
    """
    spark, (a, b) = links.sparkSession, links.columns[:2]
    with scratch(spark) as keep:
        pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
        pairs, state = staged(pairs, "links"), None
        while True:
            now = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
            if now == state or not now["n"]:
                nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
                return keep(nodes.union(pairs.select("v", "v").distinct()), "components")
            state = now
            with scratch(spark) as next_links:
                both = pairs.union(pairs.select("v", "u"))
                least = staged(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "stars")
                large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                large = staged(large.filter("u <> v").distinct(), "links")
                least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
                small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                pairs = next_links(small.union(least.select("u", "m")).distinct(), "links")
