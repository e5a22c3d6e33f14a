"""Near-duplicate texts by SimHash fingerprints and a self-join of their binary trie.

Fingerprints are compared as paths of a binary trie. The join starts from pairs of
subtrees and walks down both at once: at every level each side takes its 0 or its 1
branch, a pair that takes different ones has one more differing bit, and a pair beyond
the error budget goes at once, with all the leaves below it. What is left at the bottom
are exactly the pairs of fingerprints within the budget.

Equal fingerprints are one leaf, so thousands of copies cost one row. A leaf has at
most ``C(64, 1) + C(64, 2)`` others within two bits, however large its group is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, components, forest, only, small_slices, staged

LEAVES = 1 << 16  # fingerprints a subtree of the routing level should hold
FRONTIER = 1 << 18  # node pairs a walk widens at a time


def shingle_hashes(text: bytes, words: int, seed: int) -> np.ndarray:
    """XXH64 of each ``words``-word shingle of an ASCII-lower-cased text, repeats included.

    Words are runs of bytes other than the six ASCII white spaces. A text with fewer
    words has one shingle, its whole word sequence; one without words has none.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, "u8")
    line = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), "i8", len(parts)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    n = max(1, len(parts) - words + 1)
    stops = ends[min(words, len(parts)) - 1:]
    hashed = xxhash.xxh64_intdigest
    return np.fromiter(
        (hashed(line[i:j], seed) for i, j in zip(starts[:n].tolist(), stops.tolist())), "u8", n
    )


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half the hashes; 0 without hashes."""
    ones = np.zeros(64, "i8")
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i: i + (1 << 14)].astype(">u8").view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """Another 64 bits for each hash (multiply and shift); table 0 keeps the hash itself."""
    if not table:
        return hashes
    x = (hashes ^ np.uint64(table * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, lanes: int = 1) -> DataFrame:
    """``(doc_id, lane_0 .. lane_n)``: ``lanes`` independent 64-bit SimHash numbers of each text.

    ``docs`` holds ``doc_id`` and ``text``. Null and empty texts have fingerprint 0. A
    text of any length is one row of one task and is read whole; its shingles pass
    through in blocks. Bits of the signed longs are those of the unsigned numbers.
    """
    names = [f"lane_{i}" for i in range(lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            found = np.zeros((batch.num_rows, lanes), "u8")
            for row, text in enumerate(byte_texts(batch.column("text"))):
                hashes = shingle_hashes(text, words, seed)
                for lane in range(lanes):
                    found[row, lane] = majority(mixed(hashes, lane))
            columns = [pa.array(found[:, i].astype("i8")) for i in range(lanes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names)
    return docs.select("doc_id", "text").mapInArrow(run, shape)


def trie_pairs(left: np.ndarray, right: np.ndarray, bits: int, depth: int, spent: int, budget: int,
               same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of positions ``(i, j)`` with at most ``budget`` differing bits.

    ``left`` and ``right`` are sorted fingerprints of ``bits`` bits below two nodes of
    level ``depth`` whose paths differ in ``spent`` bits. With ``same`` both are one
    subtree and each pair comes once, with ``i < j``; else all pairs come. Equal
    fingerprints are leaves of their own that may pair.
    """
    if not len(left) or not len(right) or spent > budget:
        return
    # A node is a range of leaves: (first, last) of either side.
    stack = [(depth, np.array([[0, len(left), 0, len(right)]], "i8"), np.array([spent], "i4"))]
    while stack:
        level, nodes, used = stack.pop()
        if len(nodes) > FRONTIER:
            half = len(nodes) // 2
            stack += [(level, nodes[half:], used[half:]), (level, nodes[:half], used[:half])]
            continue
        single = (nodes[:, 1] - nodes[:, 0] == 1) & (nodes[:, 3] - nodes[:, 2] == 1)
        if level == bits:
            for a0, a1, b0, b1 in nodes[~single].tolist():
                # All leaves of either node are equal fingerprints.
                for i in range(a0, a1):
                    first = max(b0, i + 1) if same else b0
                    yield np.full(max(0, b1 - first), i), np.arange(first, max(first, b1))
            i, j = nodes[single, 0], nodes[single, 2]
            keep = i < j if same else np.ones(len(i), bool)
            yield i[keep], j[keep]
            continue
        if single.any():
            # One leaf on either side: the bits that are left are added at once.
            i, j, before = nodes[single, 0], nodes[single, 2], used[single]
            rest = (left[i] ^ right[j]) & np.uint64((1 << (bits - level)) - 1)
            keep = before + np.bitwise_count(rest) <= budget
            if same:
                keep &= i < j
            yield i[keep], j[keep]
            nodes, used = nodes[~single], used[~single]
            if not len(nodes):
                continue
        bit = np.uint64(1 << (bits - level - 1))

        def middle(side: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
            """Where the 1 branch of each node begins."""
            path = side[first] & ~(bit | (bit - np.uint64(1)))
            return np.clip(np.searchsorted(side, path | bit), first, last)

        a0, a1, b0, b1 = nodes.T
        am, bm = middle(left, a0, a1), middle(right, b0, b1)
        branches = [(a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)]
        kept_nodes, kept_used = [], []
        for c0, c1, d0, d1, step in branches:
            now = used + step
            keep = (c1 > c0) & (d1 > d0) & (now <= budget)
            if same:
                keep &= c0 < d1 - 1  # some i < j is left
                keep &= ~((c0 >= d1) | ((step == 1) & (c0 > d0)))  # the mirror image comes once
            kept_nodes.append(np.stack([c0[keep], c1[keep], d0[keep], d1[keep]], axis=1))
            kept_used.append(now[keep])
        nodes, used = np.concatenate(kept_nodes), np.concatenate(kept_used)
        if len(nodes):
            stack.append((level + 1, nodes, used))


def near_paths(depth: int, budget: int) -> list[int]:
    """All paths of ``depth`` bits with at most ``budget`` bits set."""
    return [
        sum(1 << k for k in places)
        for n in range(min(budget, depth) + 1) for places in combinations(range(depth), n)
    ]


def trie_links(leaves: DataFrame, tables: list[int], bits: int, budget: int, lanes: int,
               most: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that join the same leaves as all pairs within the budget do.

    ``leaves`` holds ``leaf`` (a long) and ``lane_0 .. lane_n``. Each table of ``tables``
    takes ``bits`` bits of the lanes from that bit on as its fingerprint, and pairs its
    leaves within ``budget`` differing bits. With ``most`` a pair is linked only if at most
    so many bits of all lanes differ.

    The trie is cut at a level where a subtree holds about ``LEAVES`` leaves. A leaf goes
    to every pair of subtrees of its own whose paths differ within the budget; each pair
    of subtrees is one group, walked by one task. A task returns a forest of what it
    found instead of all pairs; that keeps every component.
    """
    names = [f"lane_{i}" for i in range(lanes)]
    sent = names if most is not None else []  # only what a task needs besides the fingerprint
    total = leaves.count()
    depth = min(bits, max(0, math.ceil(math.log2(max(1, total / LEAVES)))))
    paths = near_paths(depth, budget)

    def table_bits(table: int) -> F.Column:
        lane, shift = divmod(table, 64)
        if shift + bits > 64:
            raise ValueError("a table must lie within one lane")
        return F.shiftrightunsigned(names[lane], 64 - shift - bits).bitwiseAND(F.lit(-1 if bits == 64 else (1 << bits) - 1))

    rows = leaves.select(
        "leaf", *names,
        F.explode(F.array(*[F.struct(F.lit(i).alias("t"), table_bits(t).alias("f")) for i, t in enumerate(tables)])).alias("x"),
    ).select("leaf", *sent, "x.t", "x.f")
    own = F.shiftrightunsigned("f", bits - depth) if depth else F.lit(0).cast("long")
    rows = rows.withColumn("own", own)
    other = F.explode(F.transform(F.lit(paths).cast("array<bigint>"), lambda p: F.col("own").bitwiseXOR(p)))
    routed = rows.withColumn("other", other).select(
        "leaf", *sent, "t", "f", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).alias("second"),
    )

    def run(group: pa.Table) -> pa.Table:
        f = group.column("f").to_numpy().astype("u8")
        leaf = group.column("leaf").to_numpy()
        lane = np.stack([group.column(n).to_numpy().astype("u8") for n in sent], axis=1) if sent else None
        second = group.column("second").to_numpy(zero_copy_only=False)
        p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
        one, two = np.flatnonzero(~second), np.flatnonzero(second)
        one = one[np.argsort(f[one], kind="stable")]
        two = one if p == q else two[np.argsort(f[two], kind="stable")]
        a = b = np.zeros(0, "i8")
        for i, j in trie_pairs(f[one], f[two], bits, depth, (p ^ q).bit_count(), budget, p == q):
            x, y = one[i], two[j]
            if most is not None:
                near = np.bitwise_count(lane[x] ^ lane[y]).sum(axis=1, dtype="i8") <= most
                x, y = x[near], y[near]
            a, b = np.concatenate([a, leaf[x]]), np.concatenate([b, leaf[y]])
            if len(a) > FRONTIER:
                a, b = forest(a, b)
        a, b = forest(a, b)
        return pa.table({"a": pa.array(a, "int64"), "b": pa.array(b, "int64")})

    return routed.groupBy("t", "p", "q").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42,
                    budget: int = 2) -> DataFrame:
    """Documents linked by fingerprints that differ in at most ``budget`` of 64 bits.

    Returns ``(doc_id, fingerprint, component_id)``: 16 hex digits, and the smallest
    doc_id that can be reached, its own included. Null, empty and wordless texts have
    fingerprint zero and are linked like any other. Repeated rows give repeated rows;
    rows whose doc_id is null keep a null component and link nothing. An empty table
    gives no rows. Other columns, whatever their names, are not read.
    """
    prints = staged(fingerprints(only(docs, doc_id=doc_id, text=text), words, seed), "simhash")
    leaves = staged(prints.filter("doc_id is not null").groupBy("lane_0").agg(F.min("doc_id").alias("leaf")), "leaves")
    found = components(trie_links(leaves, [0], 64, budget, 1))
    roots = staged(leaves.join(found, leaves.leaf == found.node, "left").select(
        "lane_0", F.coalesce("component", "leaf").alias("component_id")), "roots")
    return prints.join(roots, "lane_0", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("lane_0"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
