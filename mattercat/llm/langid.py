"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ``order`` bytes with counts of what
follows. A byte costs ``-log2 c / (n + d)`` in the longest context that knows it, where
``n`` counts the context's bytes and ``d`` its different ones; each longer context that
does not know it costs an escape, ``-log2 d / (n + d)``. A byte that no context knows
costs 8 bits more. The counts are frozen after training, so a text's code length is
a sum over its bytes, and the language with the shortest code wins.

All trees share one table of strings: a string of ``k + 1`` bytes is both the byte ``k + 1``
in the context of the ``k`` before it, and a context. Its row holds, for each language,
the complete cost as the former (escapes included) and the escape cost as the latter.
Scoring a byte looks up the longest string; only if no tree has it, shorter ones follow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, only, small_slices, staged

LETTER = re.compile(r"[^\W\d_]")
BLOCK = 1 << 18  # bytes scored at a time
PAD = 10  # the byte that stands before every text


def keys(data: np.ndarray, length: int) -> np.ndarray:
    """The string of ``length`` bytes that ends at each place from ``length - 1`` on, as a number.

    A leading 1 bit keeps strings of different lengths apart.
    """
    found = np.full(len(data) - length + 1, 1 << (8 * length), "u8")
    for i in range(length):
        found |= data[i: len(data) - length + 1 + i].astype("u8") << np.uint64(8 * (length - 1 - i))
    return found


def padded(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer, each after ``order`` pad bytes; first and last place of each."""
    pad = bytes([PAD]) * order
    ends = np.cumsum([len(t) + order for t in texts])
    return np.frombuffer(b"".join(x for t in texts for x in (pad, t)), "u1"), ends - [len(t) for t in texts], ends


def string_counts(docs: DataFrame, order: int) -> DataFrame:
    """``(lang, key, n)``: how often each string of 1 to ``order + 1`` bytes ends in a text of each language.

    Every byte of a padded text ends one string of full length, so tasks count only
    those; each shorter one occurs as often as the full ones that end with it.
    """
    full = order + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            langs = batch.column("lang").to_pylist()
            texts = byte_texts(batch.column("text"))
            for lang in sorted(set(langs)):
                data, first, last = padded([t for t, x in zip(texts, langs) if x == lang], order)
                inside = np.zeros(len(data) + 1, "i4")
                np.add.at(inside, first, 1)
                np.add.at(inside, last, -1)
                inside = np.cumsum(inside)[:-1] > 0
                key, n = np.unique(keys(data, full)[inside[order:]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key), pa.string()), pa.array(key.view("i8")), pa.array(n)], ["lang", "key", "n"])

    found = docs.mapInArrow(run, "lang string, key bigint, n bigint")
    found = staged(found.groupBy("lang", "key").agg(F.sum("n").alias("n")), "strings")
    shorter = F.array(*[
        F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)).bitwiseOR(F.lit(1 << 8 * k)) for k in range(1, full)
    ])
    parts = found.select("lang", F.explode(shorter).alias("key"), "n").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    return found.union(parts) if order else found


@dataclass
class Model:
    """Costs in bits of every kept string: as a byte in context, and as a context that is left."""

    langs: list[str]
    order: int
    key: np.ndarray  # sorted
    cost: np.ndarray  # a row per string, a column per language
    escape: np.ndarray

    def slots(self) -> tuple[np.ndarray, int]:
        """An open-addressed table of rows, at most a quarter full, and the shift of its hash."""
        bits = max(4, int(np.ceil(np.log2(4 * len(self.key) + 1))))
        table, shift = np.full(1 << bits, -1, "i4"), 64 - bits
        at, row = self.hashed(self.key, shift), np.arange(len(self.key), dtype="i4")
        while len(row):
            free = table[at] < 0
            table[at[free]] = row[free]
            lost = table[at] != row
            at, row = (at[lost] + 1) & ((1 << bits) - 1), row[lost]
        return table, shift

    @staticmethod
    def hashed(key: np.ndarray, shift: int) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)).astype("i8")

    def find(self, key: np.ndarray, table: np.ndarray, shift: int) -> np.ndarray:
        """The row of each string, -1 where no tree has it."""
        mask = len(table) - 1
        at = self.hashed(key, shift)
        row = table[at]
        other = np.flatnonzero((row >= 0) & (self.key[row] != key))
        while len(other):
            at[other] = (at[other] + 1) & mask
            row[other] = table[at[other]]
            other = other[(row[other] >= 0) & (self.key[row[other]] != key[other])]
        return row

    def bits(self, key: np.ndarray, table: np.ndarray, shift: int) -> np.ndarray:
        """Code length in every language of the last byte of each string of full length."""
        total = np.zeros((len(key), len(self.langs)), "f4")
        left = np.arange(len(key))
        for length in range(self.order + 1, 0, -1):
            if length <= self.order:
                key = np.uint64(1 << (8 * length)) | (key & np.uint64((1 << (8 * length)) - 1))
            row = self.find(key, table, shift)
            known = row >= 0
            if known.all() and len(left) == len(total):
                return self.cost[row]
            total[left[known]] += self.cost[row[known]]
            left, key = left[~known], key[~known]
            if not len(left):
                return total
            # The context of this length stays behind: its escape, where a tree has it.
            context = np.uint64(1 << (8 * length - 8)) | ((key >> np.uint64(8)) & np.uint64((1 << (8 * length - 8)) - 1))
            behind = self.find(context, table, shift)
            has = behind >= 0
            total[left[has]] += self.escape[behind[has]]
        total[left] += 8
        return total

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text in every language."""
        table, shift = self.table
        data, first, last = padded(texts, self.order)
        sizes = last - first
        places = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        text = np.repeat(np.arange(len(texts)), sizes)
        found = np.zeros((len(texts), len(self.langs)))
        key = keys(data, self.order + 1)[places - self.order]
        for i in range(0, len(places), BLOCK):
            bits, of = self.bits(key[i: i + BLOCK], table, shift), text[i: i + BLOCK]
            new = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            found[of[new]] += np.add.reduceat(bits, new, axis=0, dtype="f8")
        return found

    def __post_init__(self):
        self.table = self.slots()


def build_model(counts: DataFrame, order: int, most: int = 250_000) -> Model:
    """Trees of the ``most`` most frequent strings, summed over languages.

    A string is never more frequent than those inside it, so what is kept is a tree.
    The counts are those of all training texts; ``most`` bounds only what a model
    holds (about 50 bytes a string and language) and what reaches the driver.
    """
    langs = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return Model([], order, np.zeros(0, "u8"), np.zeros((0, 0), "f4"), np.zeros((0, 0), "f4"))
    totals = counts.groupBy("key").agg(F.sum("n").alias("total"))
    if totals.count() > most:
        floor = totals.orderBy(F.desc("total")).limit(most).agg(F.min("total")).first()[0]
        totals = totals.filter(F.col("total") > floor)
    shape = totals.join(counts, "key").groupBy("key").agg(*[
        F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n_{i}") for i, lang in enumerate(langs)])
    rows = shape.toPandas().sort_values("key")
    key = rows["key"].to_numpy().astype("u8")
    n = rows[[f"n_{i}" for i in range(len(langs))]].to_numpy("f8")
    return costs(langs, order, key, n)


def costs(langs: list[str], order: int, key: np.ndarray, n: np.ndarray) -> Model:
    """Costs from counts: ``n`` has a row for each string of the sorted ``key`` and a column per language."""
    one = np.uint64(1)

    def sizes(strings: np.ndarray) -> np.ndarray:
        found = np.zeros(len(strings), "i8")
        for length in range(1, order + 2):
            found[(strings >> np.uint64(8 * length)) == 1] = length
        return found

    def outer(strings: np.ndarray) -> np.ndarray:
        wide = sizes(strings).astype("u8") * np.uint64(8)
        return (one << (wide - np.uint64(8))) | ((strings >> np.uint64(8)) & ((one << (wide - np.uint64(8))) - one))

    # Contexts that are nowhere a string of their own: those that reach before a text.
    extra = np.setdiff1d(outer(key), np.append(key, one))
    order_of = np.argsort(np.concatenate([key, extra]))
    key = np.concatenate([key, extra])[order_of]
    n = np.vstack([n, np.zeros((len(extra), n.shape[1]))])[order_of]
    size = sizes(key)
    wide = size.astype("u8") * np.uint64(8)
    context = outer(key)
    shorter = (one << (wide - np.uint64(8))) | (key & ((one << (wide - np.uint64(8))) - one))
    # What follows each context: counts and different bytes. The empty context is key 1.
    contexts, at = np.unique(context, return_inverse=True)
    total = np.zeros((len(contexts), len(langs)))
    kinds = np.zeros((len(contexts), len(langs)))
    np.add.at(total, at, n)
    np.add.at(kinds, at, (n > 0).astype("f8"))
    seen = kinds > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        leave = np.where(seen, -np.log2(kinds / (total + kinds)), 0)
        direct = np.where(n > 0, -np.log2(n / (total + kinds)[at]), 0)
    cost = np.zeros((len(key), len(langs)))
    for length in range(1, order + 2):
        rows = np.flatnonzero(size == length)
        below = np.full((len(rows), len(langs)), 8.0)
        if length > 1:
            where = np.searchsorted(key, shorter[rows])
            there = (where < len(key)) & (key[np.minimum(where, len(key) - 1)] == shorter[rows])
            below[there] = cost[where[there]]
        cost[rows] = np.where(n[rows] > 0, direct[rows], leave[at[rows]] + below)
    escape = np.zeros((len(key), len(langs)))
    where = np.searchsorted(contexts, key)
    there = (where < len(contexts)) & (contexts[np.minimum(where, len(contexts) - 1)] == key)
    escape[there] = leave[where[there]]
    root = leave[np.searchsorted(contexts, np.uint64(1))] if len(contexts) and contexts[0] == 1 else np.zeros(len(langs))
    key, cost, escape = np.concatenate([[np.uint64(1)], key]), np.vstack([np.full(len(langs), 8.0), cost]), np.vstack([root, escape])
    return Model(langs, order, key, cost.astype("f4"), escape.astype("f4"))


def train(docs: DataFrame, order: int = 4, most: int = 250_000) -> Model:
    """A model of the languages in ``docs`` (``text``, ``lang``); rows without either teach nothing."""
    known = docs.filter("text is not null and lang is not null")
    return build_model(staged(string_counts(known.select("text", "lang"), order), "strings"), order, most)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, bits_per_byte)`` of every whole text.

    ``score`` is the posterior of the chosen language under equal priors, from the exact
    code lengths. Null texts, empty ones and those without a letter are ``und`` with score
    0; so is everything if the model knows no language. Equal code lengths go to the first
    language by name. Repeated rows and null ids stay; other columns are not read.
    """
    docs = only(docs, doc_id=doc_id, text=text)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            lang, score, rate = ["und"] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            raw = byte_texts(batch.column("text"))
            rows = [i for i, t in enumerate(batch.column("text").to_pylist()) if t and LETTER.search(t)]
            if rows and model.langs:
                bits = model.lengths([raw[i] for i in rows])
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(rows)), best]
                odds = np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                for k, i in enumerate(rows):
                    lang[i], score[i], rate[i] = model.langs[best[k]], 1 / odds[k], least[k] / len(raw[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang), pa.array(score), pa.array(rate)],
                ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return docs.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")
