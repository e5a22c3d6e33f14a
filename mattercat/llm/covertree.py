"""Near-duplicate vectors by a dual traversal of cover trees.

On unit vectors a cosine of at least ``c`` is a distance of at most ``sqrt(2 - 2 c)``. A
cover tree holds nested nets: every level halves the radius, every vector lies within
that radius of a node, and a node of one level is a node of all finer ones. Two nodes
further apart than the limit plus both covering radii hold no pair, so the traversal
drops them with everything below; what reaches the leaves is compared in full.

The coarsest level is fitted on a bounded sample; every vector then belongs to its
nearest node there (a cell). Bounds use the radius really measured over all vectors of a
cell, so the sample decides about speed, never about results. Cells are cut into chunks
of bounded size, each chunk has the finer levels of its own, and each pair of chunks
whose cells may hold a pair is one task.

A traversal starts from the nodes that are narrow enough for their bound to drop vectors at
right angles; wider ones are opened at once. All pairs of starting nodes are held against the
bound as matrix products in single precision, with room for its rounding; what is near is
decided in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, forest, only, staged

SAMPLE = 4096  # vectors the coarsest level is fitted on
CELLS = 1024  # nodes of that level at most
CHUNK = 8192  # vectors of a chunk, up to WIDER times as many where there are over SIDE chunks
SIDE = 16
WIDER = 4
MOST_TASKS = 1024  # of a stage
RADII = (1.0, 0.5, 0.25)  # of the levels below the cells
START = 0.25  # radius of a node that a traversal starts from, at most
BLOCK = 1 << 21  # distances held at a time
TILE = 1024  # nodes of either side that are compared by one matrix product
HEADS = 256  # vectors that are tried as nodes of a net by one matrix product
SLACK = 1e-9  # for rounding, added to every bound


def unit(raw: list[bytes], kind: str = "<f8") -> np.ndarray:
    """Unit vectors in double precision from the bytes of their components, of numpy type ``kind``."""
    x = np.frombuffer(b"".join(raw), kind).astype("f8").reshape(len(raw), -1)
    # Scaled first, so that very large and very small components neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))


def spread(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` positions, each the furthest from those before it: nested nets of falling radius."""
    chosen, far = [0], distances(x @ x[0])
    while len(chosen) < min(most, len(x)):
        at = int(far.argmax())
        if far[at] <= SLACK:
            break
        chosen.append(at)
        far = np.minimum(far, distances(x @ x[at]))
    return np.array(chosen)


def net(x: np.ndarray, members: np.ndarray, radius: float) -> np.ndarray:
    """For each of ``members`` the position of its node in a net of ``radius``; the first member is a node.

    Members become nodes in their order, unless an earlier node covers them, and belong to the first node that does.
    """
    node = np.full(len(members), -1)
    left = np.arange(len(members))
    points = x[members]
    while len(left):
        tried = min(HEADS, len(left))
        near = points[left[:tried]] @ points[left].T >= 1 - radius * radius / 2
        covered, heads = np.zeros(tried, bool), []
        for k in range(tried):
            if not covered[k]:
                heads.append(k)
                covered |= near[k, :tried]
        near = near[heads]
        near[np.arange(len(heads)), heads] = True
        held = near.any(axis=0)
        node[left[held]] = members[left[np.array(heads)[near.argmax(axis=0)[held]]]]
        left = left[~held]
    return node


def levels(x: np.ndarray) -> np.ndarray:
    """The node of every vector at each of ``RADII``, as positions; nets are nested."""
    found = np.zeros((len(RADII), len(x)), "i8")
    groups = [np.arange(len(x))]
    for level, radius in enumerate(RADII):
        finer = []
        for members in groups:
            if len(members) == 1:
                found[level:, members] = members
                continue
            node = net(x, members, radius)
            found[level, members] = node
            order = np.argsort(node, kind="stable")
            cuts = np.flatnonzero(np.diff(node[order])) + 1
            for part in np.split(members[order], cuts):
                # The node itself comes first, so that it is one at the finer level too.
                head = found[level, part[0]]
                finer.append(np.concatenate([[head], part[part != head]]))
        groups = finer
    return found


class Tree:
    """Vectors sorted so that the members of every node of every level are a range."""

    def __init__(self, x: np.ndarray, chain: np.ndarray):
        order = np.lexsort(chain[::-1])
        back = np.empty(len(order), "i8")
        back[order] = np.arange(len(order))
        self.order, self.x = order, x[order]
        self.rough = self.x.astype("f4")
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # centre, radius, first, last
        for level in chain[:, order]:
            first = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
            last = np.concatenate([first[1:], [len(level)]])
            centre = back[level[first]]
            apart = distances(np.einsum("ij,ij->i", self.x, self.x[np.repeat(centre, last - first)]))
            self.nodes.append((centre, np.maximum.reduceat(apart, first), first, last))
        leaf = np.arange(len(order))
        self.nodes.append((leaf, np.zeros(len(order)), leaf, leaf + 1))
        # Children of a node: a range of the nodes of the next level.
        self.children = []
        for (_, _, first, last), (_, _, below, _) in zip(self.nodes, self.nodes[1:]):
            self.children.append((np.searchsorted(below, first), np.searchsorted(below, last)))

    def starts(self) -> list[np.ndarray]:
        """For each level the nodes that a traversal starts from; every vector is below just one of them.

        These are the coarsest nodes of a radius up to ``START``; a node of one vector is its leaf.
        """
        found, open_ = [], np.arange(len(self.nodes[0][0]))
        for (_, radius, first, last), (below, upto) in zip(self.nodes, self.children):
            alone = last[open_] - first[open_] == 1
            narrow = ~alone & (radius[open_] <= START)
            found.append(open_[narrow])
            leaves = first[open_[alone]]
            wide = open_[~alone & ~narrow]
            open_ = spans(below[wide], upto[wide])
            found.append(leaves)
        return [*found[::2], np.sort(np.concatenate([open_, *found[1::2]]))]


def spans(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``first:last``, one range after another."""
    size = last - first
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def crossed(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the ranges ``a0:a1`` and ``b0:b1`` of each row, in blocks of about ``BLOCK / 64``."""
    size = (a1 - a0) * (b1 - b0)
    part = np.cumsum(size) // (BLOCK // 64)
    for rows in np.split(np.arange(len(size)), np.flatnonzero(np.diff(part)) + 1):
        row = np.repeat(rows, size[rows])
        k = np.arange(len(row)) - np.repeat(np.cumsum(size[rows]) - size[rows], size[rows])
        wide = (b1 - b0)[row]
        for i in range(0, len(row), BLOCK // 64):
            s = slice(i, i + BLOCK // 64)
            yield a0[row[s]] + k[s] // wide[s], b0[row[s]] + k[s] % wide[s]


def dual(left: Tree, right: Tree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of positions in both trees' sorted vectors with a cosine of at least ``cosine``."""
    limit = math.sqrt(2 - 2 * cosine) + SLACK
    leaf = len(RADII)

    def near(la: int, a: np.ndarray, lb: int, b: np.ndarray) -> np.ndarray:
        (ca, ra, _, _), (cb, rb, _, _) = left.nodes[la], right.nodes[lb]
        dots = np.einsum("ij,ij->i", left.x[ca[a]], right.x[cb[b]])
        return dots >= cosine if la == lb == leaf else distances(dots) <= limit + ra[a] + rb[b]

    def down(la: int, a: np.ndarray, lb: int, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs below pairs of nodes, of levels ``la`` and ``lb``, that passed the bound; the coarser side is opened first."""
        if la == lb == leaf:
            yield a, b
            return
        a0, a1 = (side[a] for side in left.children[la]) if la <= lb else (a, a + 1)
        b0, b1 = (side[b] for side in right.children[lb]) if lb <= la else (b, b + 1)
        na, nb = la + (la <= lb), lb + (lb <= la)
        for i, j in crossed(a0, a1, b0, b1):
            kept = near(na, i, nb, j)
            if kept.any():
                yield from down(na, i[kept], nb, j[kept])

    # Rounding of a product of two unit vectors in single precision, with room.
    room = SLACK + 4 * (left.x.shape[1] + 8) * 2.0**-24

    def rough(la: int, a: np.ndarray, lb: int, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of starting nodes that may be near, by tiles; a tile's bound is that of its widest nodes."""
        (ca, ra, _, _), (cb, rb, _, _) = left.nodes[la], right.nodes[lb]
        for i in range(0, len(a), TILE):
            some, radius = left.rough[ca[a[i: i + TILE]]], ra[a[i: i + TILE]].max()
            for j in range(0, len(b), TILE):
                bound = limit + radius + rb[b[j: j + TILE]].max()
                dots = some @ right.rough[cb[b[j: j + TILE]]].T
                at = np.flatnonzero(dots >= np.float32((1 - bound * bound / 2 if bound < 2 else -2) - room))
                for k in range(0, len(at), BLOCK // 64):
                    row, col = np.divmod(at[k: k + BLOCK // 64], dots.shape[1])
                    yield a[i + row], b[j + col]

    for la, a in enumerate(left.starts()):
        for lb, b in enumerate(right.starts()):
            for i, j in rough(la, a, lb, b):
                kept = near(la, i, lb, j)
                if kept.any():
                    yield from down(la, i[kept], lb, j[kept])


def search(leaves: DataFrame, cosine: float, kind: str = "<f8") -> DataFrame:
    """``(a, b, n)`` over ``leaves`` (``leaf``, ``copies``, ``x`` as bytes of numbers of numpy type ``kind``).

    Rows without ``b`` say that ``a`` links with ``n`` other vectors in one pair of chunks,
    copies counted; rows with ``b`` are links that join the same leaves as all links do.
    """
    spark = leaves.sparkSession
    total = leaves.count()
    # Each row goes to all chunks it may meet, so their number grows slower than that of the rows.
    most = max(CHUNK, min(total // SIDE, WIDER * CHUNK))
    head = leaves.orderBy(F.xxhash64("leaf")).limit(SAMPLE).select("x").collect()
    sample = unit([r["x"] for r in head], kind) if head else np.zeros((1, 1))
    centres = sample[spread(sample, max(1, min(CELLS, total // most)))]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            dots = unit(batch.column("x").to_pylist(), kind) @ centres.T
            cell = dots.argmax(axis=1)
            apart = distances(dots[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype("i4")), pa.array(apart)], [*batch.schema.names, "cell", "apart"])

    placed = staged(leaves.mapInArrow(assign, "leaf bigint, copies bigint, x binary, cell int, apart double"), "cells")
    # One row per node of the sample's net: at most CELLS.
    cells = {r["cell"]: (-(-r["n"] // most), r["r"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("r")).collect()}
    chunks = spark.createDataFrame([(c, n) for c, (n, _) in cells.items()] or [(0, 1)], "cell int, chunks int")
    dealt = placed.join(F.broadcast(chunks), "cell").withColumn("chunk", F.pmod(F.xxhash64("leaf"), F.col("chunks")).cast("int"))

    def grow(group: pa.Table) -> pa.Table:
        group = group.select(["cell", "chunk", "leaf", "copies", "x"])
        x, leaf = unit(group.column("x").to_pylist(), kind), group.column("leaf").to_numpy()
        for k, nodes in enumerate(levels(x)):
            group = group.append_column(f"c{k}", pa.array(leaf[nodes]))
        return group

    names = [f"c{k}" for k in range(len(RADII))]
    fields = "cell int, chunk int, leaf bigint, copies bigint, x binary"
    # The work of a group is far more than its bytes say, so adaptive execution must not put groups together.
    apiece = lambda df, groups, *keys: df.repartition(max(1, min(2 * groups, MOST_TASKS)), *keys).groupBy(*keys)
    dealt = dealt.select("cell", "chunk", "leaf", "copies", "x")
    grown = staged(apiece(dealt, sum(n for n, _ in cells.values()), "cell", "chunk").applyInArrow(
        grow, fields + "".join(f", {n} bigint" for n in names)), "nets")

    # Pairs of cells within reach of each other: at most CELLS squared over two, from bounded data.
    limit = math.sqrt(2 - 2 * cosine) + SLACK
    apart = distances(np.clip(centres @ centres.T, -1, 1))
    near = [(p, q) for p in cells for q in cells if p <= q and apart[p, q] <= limit + cells[p][1] + cells[q][1] + 2 * SLACK]
    pairs = sum(cells[p][0] * cells[q][0] if p < q else cells[p][0] * (cells[p][0] + 1) // 2 for p, q in near)
    near = spark.createDataFrame(near or [(-1, -1)], "p int, q int")
    reach = near.select(F.col("p").alias("cell"), F.col("q").alias("other")).union(near.filter("p <> q").select("q", "p"))
    reach = reach.join(chunks.select(F.col("cell").alias("other"), F.col("chunks").alias("others")), "other")
    # Each row goes to the pairs of chunks that its own is part of; the broadcast side has at most CELLS squared rows.
    own, other = F.struct("cell", "chunk"), F.struct(F.col("other").alias("cell"), F.col("chunk_other").alias("chunk"))
    met = grown.join(F.broadcast(reach), "cell").withColumn("chunk_other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    routed = met.select(
        F.least(own, other).alias("p"), F.greatest(own, other).alias("q"), (own > other).alias("second"), "leaf", "copies", "x", *names)

    def meet(group: pa.Table) -> pa.Table:
        same = group.column("p")[0].as_py() == group.column("q")[0].as_py()
        second = group.column("second").to_numpy(zero_copy_only=False)
        sides = []
        for side in (~second,) if same else (~second, second):
            part = group.filter(pa.array(side))
            leaf = part.column("leaf").to_numpy()
            order = np.argsort(leaf)
            chain = np.stack([order[np.searchsorted(leaf[order], part.column(n).to_numpy())] for n in names]) if len(leaf) else np.zeros((len(names), 0), "i8")
            if not len(leaf):
                return pa.table({"a": pa.array([], "int64"), "b": pa.array([], "int64"), "n": pa.array([], "int64")})
            tree = Tree(unit(part.column("x").to_pylist(), kind), chain)
            sides.append((tree, leaf[tree.order], part.column("copies").to_numpy()[tree.order]))
        (one, of_one, n_one), (two, of_two, n_two) = sides[0], sides[-1]
        count_one, count_two = np.zeros(len(of_one), "i8"), np.zeros(len(of_two), "i8")
        a = b = np.zeros(0, "i8")
        for i, j in dual(one, two, cosine):
            if same:
                i, j = i[i != j], j[i != j]
            np.add.at(count_one, i, n_two[j])
            if not same:
                np.add.at(count_two, j, n_one[i])
            a, b = np.concatenate([a, of_one[i]]), np.concatenate([b, of_two[j]])
            if len(a) > BLOCK // 16:
                a, b = forest(a, b)
        a, b = forest(a, b)
        tally = [(of_one, count_one)] + ([] if same else [(of_two, count_two)])
        who = np.concatenate([w[c > 0] for w, c in tally])
        n = np.concatenate([c[c > 0] for _, c in tally])
        return pa.table({
            "a": pa.array(np.concatenate([who, a]), "int64"),
            "b": pa.array([None] * len(who) + b.tolist(), "int64"),
            "n": pa.array(n.tolist() + [None] * len(a), "int64"),
        })

    return apiece(routed, pairs, "p", "q").applyInArrow(meet, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.95,
                 dimension: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row, for links of at least ``cosine``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable by links, its own included, and ``kept`` says whether that is itself.
    Cosines are taken in double precision.

    Vectors that are null, empty, zero or hold a null, NaN or infinity link with nothing,
    as do those of another ``dimension`` (by default the commonest). Equal vectors are worked
    on once and count as copies. Rows with a null vec_id link with nothing and have a null
    component; repeated rows are copies that share their vec_id. An empty table gives no
    rows; other columns are not read.
    """
    base = only(vectors, vec_id=vec_id, embedding=embedding)
    # Single precision stays as it is until it is worked on, which is half the bytes to move.
    single = base.schema["embedding"].dataType == T.ArrayType(T.FloatType(), base.schema["embedding"].dataType.containsNull)
    kind = "<f4" if single else "<f8"
    base = base.withColumn("embedding", F.col("embedding").cast("array<float>" if single else "array<double>"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0)
    rows = base.withColumn("sound", F.coalesce(sound, F.lit(False)))
    if dimension is None:
        size = rows.filter("sound").groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
        dimension = size["d"] if size else 0
    rows = rows.withColumn("key", F.when(F.col("sound") & (F.size("embedding") == dimension), F.col("embedding")))
    rows = staged(rows.select("vec_id", "key"), "vectors")
    leaves = rows.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("leaf"), F.count("*").alias("copies"))
    leaves = staged(leaves, "leaves")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column("key").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("leaf"), batch.column("copies"), pa.array([v.tobytes() for v in values], pa.binary())], ["leaf", "copies", "x"])

    packed = leaves.select("leaf", "copies", "key").mapInArrow(pack, "leaf bigint, copies bigint, x binary")
    found = staged(search(staged(packed, "leaves"), cosine, kind), "near")
    tally = found.filter("b is null").groupBy(F.col("a").alias("leaf")).agg(F.sum("n").alias("n"))
    parts = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "leaf")
    known = leaves.join(tally, "leaf", "left").join(parts, "leaf", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "leaf").alias("component_id"))
    out = rows.join(staged(known, "known"), "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
