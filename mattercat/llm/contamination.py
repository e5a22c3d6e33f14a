"""Test items that leaked into training documents: rare n-gram seeds and local alignment.

Every n-gram of every item is a seed, and all documents are scanned for all seeds. Seeds
that lie close together make a passage. A seed is rare by how few passages have it, and a
passage is aligned with an item if the seeds they share are rare enough together: one
rare seed will do, and so will several common ones, as in a copy that is everywhere.
The alignment (Smith-Waterman over words) scores copies with words replaced, left out or
put in between.

The scan filters by a bitmap of seed hashes, of fixed size however many items there are;
what passes is joined to the seeds themselves. Only passages are shuffled, never documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, small_slices, staged

BITS = 24  # of a hash that index the bitmap: 2 MB
HELD = 250_000  # words a task remembers
MATCH, MISMATCH, GAP = 2, -1, -1


def clean_word(raw: str) -> str:
    """A word without outer punctuation in lower case; empty if nothing is left."""
    word = raw.lower()
    if word.isalnum():
        return word
    first, last = 0, len(word)
    while first < last and not word[first].isalnum():
        first += 1
    while last > first and not word[last - 1].isalnum():
        last -= 1
    return word[first:last]


class Words:
    """Words of texts with a 64-bit hash each; punctuation alone is no word."""

    def __init__(self):
        self.known: dict[str, tuple[str, int]] = {}

    def __call__(self, text: str) -> tuple[list[str], np.ndarray]:
        parts = text.split()
        new = [w for w in set(parts) if w not in self.known]
        if len(self.known) + len(new) > HELD:
            self.known.clear()
            new = set(parts)
        for raw in new:
            word = clean_word(raw)
            self.known[raw] = word, xxhash.xxh64_intdigest(word) if word else 0
        pairs = [self.known[w] for w in parts]
        words = [w for w, _ in pairs if w]
        return words, np.fromiter((h for w, h in pairs if w), "u8", len(words))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words; of all of them if there are fewer, nothing without words."""
    if not len(words):
        return np.zeros(0, "u8")
    n = min(n, len(words))
    found = np.zeros(len(words) - n + 1, "u8")
    for i in range(n):
        found = (found ^ words[i: len(words) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int, int]:
    """The best local alignment: score, matched words, item words spanned, first and last place in the passage.

    A match adds ``MATCH``, a mismatch or a gap in either text takes 1. Of equal scores the
    first in the item, then in the passage wins. The table holds one number for each
    pair of words.
    """
    m, n = len(item), len(passage)
    table = np.zeros((m + 1, n + 1), "i4")
    at = np.arange(n + 1)
    for i in range(m):
        step = np.where(passage == item[i], MATCH, MISMATCH)
        row = np.zeros(n + 1, "i4")
        row[1:] = np.maximum(0, np.maximum(table[i, :-1] + step, table[i, 1:] + GAP))
        # A gap along the passage: the best earlier cell less its distance.
        table[i + 1] = np.maximum(0, np.maximum.accumulate(row - GAP * at) + GAP * at)
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end, last = int(table[i, j]), int(i), int(j)
    matched = 0
    while table[i, j] > 0:
        same = passage[j - 1] == item[i - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
            matched += bool(same)
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, matched, end - int(i), int(j), last


def item_seeds(items: DataFrame, n: int) -> DataFrame:
    """``(item_id, words, seeds)`` of the items that have words; equal items stay apart."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words()
        for batch in small_slices(batches, "text"):
            rows = [(i, *split(t or "")) for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist())]
            rows = [(i, h.view("i8"), np.unique(gram_hashes(h, n)).view("i8")) for i, w, h in rows if w]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], batch.schema.field("item_id").type), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["item_id", "words", "seeds"])

    return items.mapInArrow(run, f"item_id {kind}, words array<bigint>, seeds array<bigint>")


def bitmap(seeds: DataFrame) -> np.ndarray:
    """Which ``BITS``-bit prefixes seed hashes have: gathered as at most ``2**BITS / 64`` numbers."""
    prefix = F.shiftrightunsigned("seed", 64 - BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - BITS}) % 64 as int))")
    rows = seeds.groupBy((prefix / 64).cast("bigint").alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    found = np.zeros((1 << BITS) // 64, "i8")
    for r in rows:
        found[r["at"]] = r["bits"]
    return np.unpackbits(found.view("u1"), bitorder="little")


def passages(docs: DataFrame, known: np.ndarray, shortest: int, n: int, flank: int) -> DataFrame:
    """``(doc_id, first, words, seeds)``: stretches around possible seeds, with ``flank`` words on both sides.

    Seeds at most ``2 * flank`` words apart share a passage, whatever its length. ``shortest`` to ``n``
    are the lengths of seeds: items of fewer than ``n`` words are seeds of their own length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words()
        for batch in small_slices(batches, "text"):
            ids, first, words, seeds = [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                _, hashes = split(text or "")
                at, found = [], []
                for length in range(shortest, n + 1):
                    if len(hashes) >= length:
                        grams = gram_hashes(hashes, length)
                        hit = np.flatnonzero(known[(grams >> np.uint64(64 - BITS)).astype("i8")])
                        at.append(hit)
                        found.append(grams[hit])
                if not at or not (places := np.concatenate(at)).size:
                    continue
                order = np.argsort(places, kind="stable")
                places, grams = places[order], np.concatenate(found)[order]
                for part in np.split(np.arange(len(places)), np.flatnonzero(np.diff(places) > 2 * flank) + 1):
                    start = max(0, int(places[part[0]]) - flank)
                    ids.append(row)
                    first.append(start)
                    words.append(hashes[start: int(places[part[-1]]) + n + flank].view("i8"))
                    seeds.append(np.unique(grams[part]).view("i8"))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(ids, "int64")), pa.array(first, "int64"), pa.array(words, longs), pa.array(seeds, longs)],
                ["doc_id", "first", "words", "seeds"])

    return docs.mapInArrow(run, f"doc_id {kind}, first bigint, words array<bigint>, seeds array<bigint>")


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", n: int = 4, flank: int = 64, rarity: float = math.log(10),
                 similarity: float = 0.5) -> DataFrame:
    """Documents with a passage that aligns with a test item, one row for each such pair.

    ``rarity`` is what the seeds that a passage shares with an item must weigh together, or
    half of what all the item's seeds weigh, if that is less. Returns ``(doc_id, item_id, similarity, matched, first_word, last_word)``: the best
    alignment's score as a share of the item aligned with itself, its matched words and
    its place in words of the document (``last_word`` exclusive). Pairs under ``similarity``
    are left out, and so are documents without a pair.

    Null and empty texts on either side take no part, nor do null doc_ids and item_ids.
    Repeated rows give one pair; equal items one pair each. Empty tables give no rows; other
    columns are not read.
    """
    base = only(docs, doc_id=doc_id, text=text).filter("doc_id is not null and text is not null")
    tests = only(items, item_id=item_id, text=item_text).filter("item_id is not null and text is not null")
    tests = staged(item_seeds(tests, n), "items")
    seeds = staged(tests.select("item_id", F.explode("seeds").alias("seed")), "seeds")
    shortest = tests.agg(F.min(F.least(F.size("words"), F.lit(n)))).first()[0] or n
    found = staged(passages(base, bitmap(seeds), shortest, n, flank).withColumn("passage", F.monotonically_increasing_id()), "passages")
    hits = staged(found.select("passage", F.explode("seeds").alias("seed")).join(seeds.select("seed").distinct(), "seed", "left_semi"), "hits")

    # A seed weighs the more the fewer passages have it: ln(1 + documents / passages).
    often = hits.groupBy("seed").agg(F.count("*").alias("often"))
    weight = F.log1p(F.lit(float(max(1, base.count()))) / F.col("often"))
    rated = staged(seeds.join(often, "seed").select("seed", "item_id", weight.alias("rarity")), "rarity")
    needed = rated.groupBy("item_id").agg(F.least(F.lit(rarity), F.sum("rarity") / 2).alias("needed"))
    pairs = hits.join(rated, "seed").groupBy("passage", "item_id").agg(F.sum("rarity").alias("rarity"))
    pairs = staged(pairs.join(needed, "item_id").filter("rarity >= needed").select("passage", "item_id"), "pairs")
    sided = pairs.join(found.select("passage", "doc_id", "first", "words"), "passage").join(
        tests.select("item_id", F.col("words").alias("item")), "item_id")
    kinds = {f.name: f.dataType.simpleString() for f in sided.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, words, first = batch.column("item"), batch.column("words"), batch.column("first").to_pylist()
            rows = []
            for i in range(batch.num_rows):
                one = item[i].values.to_numpy()
                score, matched, _, start, end = align(one, words[i].values.to_numpy())
                rows.append((score / (MATCH * len(one)), matched, first[i] + start, first[i] + end))
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.float64(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), *columns],
                ["doc_id", "item_id", "similarity", "matched", "first_word", "last_word"])

    aligned = sided.select("doc_id", "item_id", "first", "words", "item").mapInArrow(
        run, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, similarity double, matched bigint, first_word bigint, last_word bigint")
    # Of several passages of a document the best, then the first.
    best = aligned.filter(F.col("similarity") >= similarity).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("first_word")).alias("before"), "matched", "last_word")).alias("b"))
    return best.select("doc_id", "item_id", "b.similarity", "b.matched", (-F.col("b.before")).alias("first_word"), "b.last_word")
