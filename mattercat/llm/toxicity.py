"""Toxic passages by maximum-scoring segments over token log-odds.

Tokens score the logarithm of how much likelier they are in toxic documents, with
counts smoothed by Dirichlet priors proportional to the whole corpus. Scores of ordinary
tokens are slightly below zero, so a run of tokens adds up to much only where toxic ones
are dense. A linear scan finds all maximal segments of a text. How far a segment
exceeds what clean text of that length reaches by chance follows the extreme-value law
``E = K n exp(-lambda S)``; a document's evidence is the sum of ``-ln E`` over its significant
segments, and a logistic curve fitted on training documents turns it into a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, small_slices, staged

STEM = 4  # characters of a stem, the fallback of words too rare to judge
HELD = 250_000  # words a task remembers
BINS = 64  # of evidence, for the logistic curve


def token(raw: str) -> str:
    """A white-space-separated word without outer punctuation, in lower case."""
    word = raw.lower()
    if word.isalnum():
        return word
    first, last = 0, len(word)
    while first < last and not word[first].isalnum():
        first += 1
    while last > first and not word[last - 1].isalnum():
        last -= 1
    return word[first:last]


def features(raw: str) -> tuple[str, ...]:
    """The word and its stem (marked by a leading space); nothing for bare punctuation."""
    word = token(raw)
    return (word, " " + word[:STEM]) if len(word) > STEM else (word,) if word else ()


def token_counts(docs: DataFrame) -> DataFrame:
    """``(feature, toxic, clean)``: in how many documents of either label each feature occurs.

    ``docs`` holds ``text`` and ``toxic`` (1 or 0). Counted once per document, so that a
    text that repeats a word teaches no more than one that has it once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = {}, {}

        def out() -> pa.RecordBatch:
            n = np.array(list(counts.values()), "i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(n[:, 1]), pa.array(n[:, 0])], ["feature", "toxic", "clean"])

        for batch in small_slices(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = set()
                for raw in set((text or "").split()):
                    parts = known.get(raw)
                    if parts is None:
                        parts = known[raw] = features(raw)
                    found.update(parts)
                for feature in found:
                    pair = counts.get(feature)
                    if pair is None:
                        pair = counts[feature] = [0, 0]
                    pair[label] += 1
            if len(known) > HELD:
                known.clear()
            if len(counts) > HELD:
                yield out()
                counts.clear()
        if counts:
            yield out()

    found = docs.select("text", "toxic").mapInArrow(run, "feature string, toxic bigint, clean bigint")
    return found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Model:
    """Scores of telling words and stems, the score of all others, and the calibration."""

    weights: dict[str, float]
    neutral: float
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    curve: tuple[float, float] = (1.0, 0.0)
    known: dict = field(default_factory=dict)

    def scores(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > HELD:
            known.clear()
            new = set(words)
        for raw in new:
            known[raw] = next((self.weights[f] for f in features(raw) if f in self.weights), self.neutral)
        return np.fromiter(map(known.__getitem__, words), "f8", len(words))

    def segments(self, text: str) -> tuple[list[tuple[float, int, int]], int]:
        """Maximal segments ``(sum, first, last)`` in words, last exclusive, and the number of words."""
        words = text.split()
        return maximal_segments(self.scores(words)), len(words)

    def surprise(self, total: float, words: int) -> float:
        """``-ln E`` of a segment: above 0 where less than one such is expected by chance."""
        return self.rate * total - math.log(self.scale * max(words, 1))


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments: disjoint, none can grow or be joined to a better one.

    The scan keeps candidate segments with the sum before and up to their end. A new
    positive run looks for the last candidate that begins lower than it does; it stands
    alone if there is none or that one ends at least as high, else both merge and look on.
    Every merge removes a candidate, so the scan is linear.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple[float, float, int, int, int]] = []  # before, after, first, last, previous lower candidate
    for at in positive.tolist():
        before, after, first = float(sums[at]), float(sums[at + 1]), at
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= after:
                kept.append((before, after, first, at + 1, j))
                break
            before, first = kept[j][0], kept[j][2]
            del kept[j:]
    return [(after - before, first, last) for before, after, first, last, _ in kept]


def telling(counts: DataFrame, toxic: int, clean: int, most: int, prior: float, certainty: float, margin: float) -> list:
    """Rows ``(feature, toxic, clean, weight)`` of the features that tell the classes apart.

    ``toxic`` and ``clean`` are the sums of the counts of all words, so that longer documents
    of one class raise nothing. The log-odds are smoothed by a Dirichlet prior: each class
    gets ``prior`` times the counts of the whole corpus on top. They are drawn towards 0 by
    ``certainty`` standard deviations and by ``margin``, so that features which are rare, or
    only slightly likelier in one class, keep no weight. The ``most`` strongest make up the
    model; the counts behind them are of all training documents.
    """
    added = prior * (F.col("toxic") + F.col("clean"))
    t, c, whole = F.col("toxic") + added, F.col("clean") + added, prior * (toxic + clean)
    delta = F.log(t / (toxic + whole)) - F.log(c / (clean + whole))
    sure = F.abs(delta) - certainty * F.sqrt(1 / t + 1 / c) - margin
    rated = counts.select("feature", "toxic", "clean", (F.signum(delta) * sure).alias("weight"), sure.alias("sure"))
    return rated.filter("sure > 0").orderBy(F.desc("sure"), "feature").limit(most).collect()


def root(scores: list[float], shares: list[float]) -> float:
    """The positive ``x`` with ``sum(share * exp(x * score)) = 1``, for scores with a negative mean."""
    s, p = np.array(scores), np.array(shares)
    low, high = 1e-6, 1.0
    excess = lambda x: float((p * np.exp(np.minimum(700, x * s))).sum()) - 1
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def evidence(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and, for each whole text, ``words``, ``best`` (largest segment sum), ``evidence`` and ``passages``."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    passage = pa.struct([("surprise", pa.float64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            n, best, total, found = [], [], [], []
            for text in batch.column("text").to_pylist():
                segments, words = model.segments(text or "")
                rated = [(model.surprise(s, words), i, j) for s, i, j in segments]
                rated = [x for x in rated if x[0] > 0]
                n.append(words)
                best.append(max((s for s, _, _ in segments), default=0.0))
                total.append(sum(x[0] for x in rated))
                found.append([{"surprise": s, "first": i, "last": j} for s, i, j in rated])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], pa.array(n, "int64"), pa.array(best, "float64"), pa.array(total, "float64"),
                 pa.array(found, pa.list_(passage))], [*keep, "words", "best", "evidence", "passages"])

    return docs.select("text", *keep).mapInArrow(
        run, "".join(f"{k} {kinds[k]}, " for k in keep) + "words bigint, best double, evidence double, "
        "passages array<struct<surprise: double, first: bigint, last: bigint>>")


def logistic(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the logistic curve through weighted bins, by Newton's method."""
    x = np.asarray(x, "f8")
    n, p = positive + negative + 1e-9, positive
    a, b = 1.0, 0.0
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        grad = np.array([((p - n * q) * x).sum() - 1e-2 * a, (p - n * q).sum() - 1e-2 * b])
        w = n * q * (1 - q)
        hess = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5 / max(1e-12, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(a)), float(b)


def train(docs: DataFrame, most: int = 50_000, prior: float = 0.05, certainty: float = 1.64, margin: float = math.log(3)) -> Model:
    """A model of ``docs`` (``text``, ``toxic``); rows whose label is neither 0 nor 1 teach nothing.

    All rows given are counted, and all of them calibrate: ``lambda`` follows from the
    scores of tokens in clean texts, ``K`` from the best segments of all clean texts (its
    likeliest value is their number over the sum of ``n exp(-lambda S)``), and the curve
    from the evidence of all texts, gathered in bins. Without both labels every text
    scores about the share of toxic ones.
    """
    docs = staged(docs.filter("toxic in (0, 1)").select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")), "labelled")
    n = {r["toxic"]: r["n"] for r in docs.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        share = (toxic + 0.01) / (toxic + clean + 1)
        return Model({}, -0.01, curve=(0.0, math.log(share / (1 - share))))
    counts = staged(token_counts(docs), "tokens")
    words = counts.filter(~F.startswith("feature", F.lit(" "))).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    rows = telling(counts, words["toxic"] or 0, words["clean"] or 0, most, prior, certainty, margin) if words["toxic"] and words["clean"] else []
    positive = [r for r in rows if r["weight"] > 0 and not r["feature"].startswith(" ")]
    in_toxic = sum(r["toxic"] for r in positive) / max(1, words["toxic"] or 0)
    in_clean = sum(r["clean"] for r in positive) / max(1, words["clean"] or 0)
    neutral = max(-0.5, min(-0.005, math.log(max(0.5, 1 - in_toxic) / max(0.5, 1 - in_clean))))
    model = Model({r["feature"]: r["weight"] for r in rows}, neutral)
    if not model.weights:
        return Model({}, neutral, curve=(0.0, math.log(toxic / clean)))

    shares = [(r["clean"] + prior * (r["toxic"] + r["clean"])) / words["clean"] for r in rows if not r["feature"].startswith(" ")]
    scores = [r["weight"] for r in rows if not r["feature"].startswith(" ")]
    model.rate = min(4.0, root([*scores, neutral], [*shares, max(0.0, 1 - sum(shares))]))
    best = evidence(docs.filter("toxic = 0"), model, ())
    law = best.agg(F.count("*").alias("n"), F.sum(F.col("words") * F.exp(-model.rate * F.col("best"))).alias("s")).first()
    model.scale = law["n"] / max(1.0, law["s"] or 0.0)
    bins = evidence(docs, model, ("toxic",)).groupBy(F.round(F.log1p("evidence") * BINS / 8).alias("bin")).agg(
        F.sum("toxic").alias("toxic"), F.count("*").alias("n")).orderBy("bin").collect()
    x = np.array([r["bin"] * 8 / BINS for r in bins])
    hits = np.array([float(r["toxic"]) for r in bins])
    model.curve = logistic(x, hits, np.array([float(r["n"]) for r in bins]) - hits)
    return model


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
             most: int = 200_000) -> DataFrame:
    """``(text, toxic)`` of the documents that have a label; of several labels the largest counts.

    The classifier is fitted on about ``most`` labelled documents, drawn evenly by a hash of
    their ids where there are more. So the labels (a few MB) can be sent to the documents,
    and no text is shuffled.
    """
    marks = only(labels, doc_id=doc_id, toxic=label).filter("doc_id is not null and toxic in (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = max(1, -(-marks.count() // most))
    marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    return only(docs, doc_id=doc_id, text=text).join(F.broadcast(marks), "doc_id").select("text", "toxic")


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, evidence, passages)`` of every whole text.

    ``passages`` are the significant segments as structs ``(surprise, first, last)`` of
    white-space-separated words. Null and empty texts have no passage and the score of
    evidence 0. Repeated rows and null ids stay; other columns are not read, above all no
    label. An empty table gives no rows.
    """
    found = evidence(only(docs, doc_id=doc_id, text=text), model)
    a, b = model.curve
    value = 1 / (1 + F.exp(-(F.lit(a) * F.log1p("evidence") + F.lit(b))))
    return found.select("doc_id", value.alias("score"), "evidence", "passages")
