"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests.

A pattern finds what looks like an assignment, an access key or a hash. Other secrets have
no form but that their characters are random. Each long token is taken as a string over the
alphabet of its inferred encoding and tested for uniformity (chi-squared), for runs of
character classes, and for serial correlation. It must pass all three as a random
string, and it must be unlike ordinary text: the same statistics are held against those of
all shorter tokens of the same corpus, and the Benjamini-Hochberg procedure, within tokens
of like encoding and length, keeps the share of false discoveries at a given rate. A short token
has little evidence and competes only with other short ones.

Everything is DataFrame expressions: no Python runs on the rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

# The patterns and least lengths of the base kinds, in their order. A run of one
# set of characters is always matched from its start, so there the least length may stand in
# the pattern; an assignment that is too short still uses up what it matched.
PATTERNS = {
    "assign": "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}

DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Encoding: its alphabet in order of value, and the whole token it must match.
ENCODINGS = {
    "hex": (DIGITS + "abcdef", "[0-9a-f]+|[0-9A-F]+"),
    "base32": (UPPER + "234567", "[A-Z2-7]+={0,6}"),
    "base64": (UPPER + LOWER + DIGITS + "+/", "[A-Za-z0-9+/]+={0,2}"),
    "base64url": (UPPER + LOWER + DIGITS + "-_", "[A-Za-z0-9_-]+={0,2}"),
}
TOKEN = "[A-Za-z0-9+/=_-]"
SHORTEST = 16    # characters of a token that is tested; shorter ones make up ordinary text
BINS = 50        # of the logarithm of a p-value: 0.02 wide in powers of e
DEEPEST = 700.0  # smaller p-values than exp(-700) are one bin


def inferred(token: Column) -> Column:
    """The narrowest encoding a token fits; null for plain numbers and for none."""
    found = F.when(token.rlike("^[0-9]+$"), F.lit(None))
    for name, (_, pattern) in ENCODINGS.items():
        found = found.when(token.rlike(f"^(?:{pattern})$"), F.lit(name))
    return found


def body(token: Column, encoding: Column) -> Column:
    """The symbols of a token: no padding, hexadecimal digits in lower case."""
    bare = F.rtrim(token, F.lit("="))
    return F.when(encoding == "hex", F.lower(bare)).otherwise(bare)


def classes(symbols: Column) -> Column:
    """Symbols by their class: ``a`` lower, ``A`` upper, ``0`` digit, ``+`` other."""
    return F.translate(symbols, LOWER + UPPER + DIGITS + "+/-_", "a" * 26 + "A" * 26 + "0" * 10 + "++++")


def measured(rows: DataFrame) -> DataFrame:
    """Statistics of ``encoding, symbols``: length, coincidences, changes of class, lag-1 correlation.

    ``pairs`` counts pairs of equal symbols, from which chi-squared against the uniform
    alphabet of ``k`` symbols follows as ``k (L + 2 pairs) / L - L``.
    """
    kept = rows.columns
    alphabet = reduce(lambda c, e: c.when(F.col("encoding") == e, F.lit(ENCODINGS[e][0])), ENCODINGS, F)
    rows = rows.withColumns({
        "k": F.when(F.col("encoding") == "hex", 16).when(F.col("encoding") == "base32", 32).otherwise(64),
        "length": F.length("symbols"), "alphabet": alphabet, "class": classes(F.col("symbols")),
        "symbol": F.split("symbols", ""),
    })
    # Symbols as numbers from their alphabet; sums of them are whole numbers, so exact.
    value = F.transform("symbol", lambda s: (F.instr(F.col("alphabet"), s) - 1).cast("double"))
    times = F.transform(
        F.array_distinct("symbol"), lambda s: (F.col("length") - F.length(F.replace(F.col("symbols"), s, F.lit("")))).cast("double"))
    zero = F.lit(0.0)
    rows = rows.withColumns({
        "value": value, "pairs": F.aggregate(times, zero, lambda a, n: a + n * (n - 1) / 2),
        # A change is a place where a run of one class ends before the end of the token.
        "changes": F.size(F.regexp_extract_all("class", F.lit("a+|A+|0+|\\++"), F.lit(0))) - 1,
    })
    later = F.slice("value", 2, F.greatest(F.col("length") - 1, F.lit(1)))
    rows = rows.withColumns({
        "sum": F.aggregate("value", zero, lambda a, x: a + x), "squares": F.aggregate("value", zero, lambda a, x: a + x * x),
        "products": F.aggregate(F.zip_with("value", later, lambda x, y: x * F.coalesce(y, zero)), zero, lambda a, x: a + x),
        "ends": F.element_at("value", 1) + F.element_at("value", -1),
    })
    mean = F.col("sum") / F.col("length")
    spread = F.col("squares") - F.col("sum") * mean
    lagged = F.col("products") - mean * (2 * F.col("sum") - F.col("ends")) + (F.col("length") - 1) * mean * mean
    lag = F.when(F.size(F.array_distinct("symbol")) > 1, lagged / spread).otherwise(1.0)
    return rows.withColumn("lag", lag).select(*kept, "k", "length", "pairs", "changes", "lag")


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, to seven digits; the polynomial of Zelen and Severo."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def pair_moments(n: Column, s2: Column, s3: Column) -> tuple[Column, Column]:
    """Mean and variance of the number of equal pairs among ``n`` draws with power sums ``s2`` and ``s3``."""
    all_pairs = n * (n - 1) / 2
    return all_pairs * s2, all_pairs * (s2 - s2 * s2) + n * (n - 1) * (n - 2) * (s3 - s2 * s2)


def random_p(encodings: dict = ENCODINGS) -> Column:
    """P-value of the battery if a token is random: three times the least of its tests."""
    n, k = F.col("length").cast("double"), F.col("k").cast("double")
    mean, variance = pair_moments(n, 1 / k, 1 / (k * k))
    # Chi-squared with its exact mean and variance, brought near to normal by a cube root.
    ratio, spread = (k * (n + 2 * F.col("pairs")) / n - n) / (k - 1), 4 * k * k / (n * n) * variance / ((k - 1) * (k - 1))
    uniform = normal_tail((F.cbrt(ratio) - (1 - spread / 9)) / F.sqrt(spread / 9))
    s2, s3 = F.lit(None), F.lit(None)
    for name, (alphabet, _) in encodings.items():
        shares = [sum(c in group for c in alphabet) / len(alphabet) for group in (LOWER, UPPER, DIGITS, "+/-_")]
        s2 = F.when(F.col("encoding") == name, sum(p * p for p in shares)).otherwise(s2)
        s3 = F.when(F.col("encoding") == name, sum(p ** 3 for p in shares)).otherwise(s3)
    spread = (n - 1) * (s2 - s2 * s2) + 2 * (n - 2) * (s3 - s2 * s2)
    runs = 2 * normal_tail(F.abs(F.col("changes") - (n - 1) * (1 - s2)) / F.sqrt(spread))
    serial = 2 * normal_tail(F.abs(F.col("lag") + 1 / n) * F.sqrt(n))
    return F.least(F.lit(1.0), 3 * F.least(uniform, runs, serial))


def ordinary_p() -> Column:
    """Logarithm of the p-value of a token under ordinary text of its encoding: three times the least of its tests.

    Needs the columns of ``ordinary``. Ordinary text repeats symbols more often and changes
    class less often than random text; for changes the Chernoff bound holds at any length.
    """
    n = F.col("length").cast("double")
    mean, variance = pair_moments(n, F.col("s2"), F.col("s3"))
    fewer = normal_tail((mean - F.col("pairs") - 0.5) / F.sqrt(variance))
    rate, base = F.col("changes") / (n - 1), F.col("change")
    far = F.when(rate <= base, 0.0).otherwise(
        rate * F.log(rate / base) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - base))).otherwise(0.0))
    serial = 2 * normal_tail(F.abs(F.col("lag") - F.col("lag_mean")) * F.sqrt(n))
    logs = F.least(F.log(F.greatest(fewer, F.lit(1e-300))), -(n - 1) * far, F.log(F.greatest(serial, F.lit(1e-300))))
    return F.greatest(F.lit(-DEEPEST), F.least(F.lit(0.0), logs + math.log(3)))


def ordinary(texts: DataFrame) -> DataFrame:
    """What ordinary text of each encoding is like: ``(encoding, s2, s3, change, lag_mean)``, four rows.

    All tokens of 4 to 15 characters of all texts, each as often as it occurs. Counts of
    symbols and of changes start from one of each, so that an encoding without tokens counts as
    random and finds nothing.
    """
    tokens = texts.select(F.explode(F.split("text", f"{TOKEN.replace('[', '[^')}+")).alias("token"))
    short = tokens.filter(F.length("token").between(4, SHORTEST - 1)).groupBy("token").agg(F.count("*").alias("n"))
    fits = F.array(*[F.when(F.col("token").rlike(f"^(?:{p})$"), F.lit(e)) for e, (_, p) in ENCODINGS.items()])
    rows = short.select("token", "n", F.explode(F.array_compact(fits)).alias("encoding"))
    known = measured(rows.withColumn("symbols", body(F.col("token"), F.col("encoding"))).filter("length(symbols) > 2"))
    known = staged(known.select("encoding", "symbols", "n", "length", "changes", "lag"), "ordinary")
    symbols = known.select("encoding", "n", F.explode(F.split("symbols", "")).alias("symbol")).groupBy("encoding", "symbol").agg(F.sum("n").alias("n"))
    alphabets = F.array(*[F.struct(F.lit(e).alias("encoding"), F.split(F.lit(a), "").alias("symbol")) for e, (a, _) in ENCODINGS.items()])
    every = texts.sparkSession.range(1).select(F.inline(alphabets)).withColumn("symbol", F.explode("symbol"))
    counted = every.join(symbols, ["encoding", "symbol"], "left").select("encoding", (F.coalesce("n", F.lit(0)) + 1).cast("double").alias("n"))
    total = F.sum("n").over(Window.partitionBy("encoding"))
    power = counted.withColumn("p", F.col("n") / total).groupBy("encoding").agg(
        F.sum(F.pow("p", F.lit(2))).alias("s2"), F.sum(F.pow("p", F.lit(3))).alias("s3"))
    moves = known.groupBy("encoding").agg(
        F.sum(F.col("n") * F.col("changes")).alias("moved"), F.sum(F.col("n") * (F.col("length") - 1)).alias("places"),
        (F.sum(F.col("n") * F.col("lag")) / F.sum("n")).alias("lag_mean"))
    return power.join(moves, "encoding", "left").select(
        "encoding", "s2", "s3", ((F.coalesce("moved", F.lit(0)) + 1) / (F.coalesce("places", F.lit(0)) + 2)).alias("change"),
        F.coalesce("lag_mean", F.lit(0.0)).alias("lag_mean"))


def pieces(kind: str, pattern: str, rank: int, least: Column, kept: bool = False) -> tuple[Column, Column]:
    """Matches of a pattern, and the structs ``(rank, at, before, length, good, token)`` of those in a text.

    What lies before a match is what a split leaves there, so that matches need no positions of their own.
    """
    found, gaps = F.col(f"found_{kind}"), F.col(f"gaps_{kind}")
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.transform(found, lambda m, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("at"), F.length(F.get(gaps, i)).alias("before"), F.length(m).alias("length"),
        (F.length(F.regexp_extract(m, pattern, 2) if kind == "assign" else m) >= least).alias("good"),
        (m if kept else F.lit(None).cast("string")).alias("token")))


def candidates(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, rank, start, end, token)``: base spans, long tokens with an encoding, and one row without a rank for each text."""
    kinds = {**{k: (p, LEAST[k], False) for k, p in PATTERNS.items()}, "random": (f"{TOKEN}{{{SHORTEST},}}", SHORTEST, True)}
    made = {k: pieces(k, p, i, F.lit(least), kept) for i, (k, (p, least, kept)) in enumerate(kinds.items())}
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    # Most texts hold no key and no assignment: those are not searched for them.
    likely = {"access": F.contains("text", F.lit("AKIA")), "assign": F.col("text").rlike(PATTERNS["assign"])}
    none = F.array().cast("array<string>")
    rows = rows.withColumns({
        f"found_{k}": F.when(likely[k], found).otherwise(none) if k in likely else found for k, (found, _) in made.items()})
    rows = rows.withColumns({
        f"gaps_{k}": F.when(F.size(f"found_{k}") > 0, F.split("text", p, -1)) for k, (p, _, _) in kinds.items()})
    every = F.array(F.lit(None).cast("struct<rank:int,at:int,before:int,length:int,good:boolean,token:string>"))
    rows = rows.select("row", "doc_id", F.explode(F.concat(every, *[m for _, m in made.values()])).alias("m")).select("row", "doc_id", "m.*")
    so_far = Window.partitionBy("row", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.when(F.col("rank").isNotNull(), F.sum(F.col("before") + F.col("length")).over(so_far))
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    encoding = inferred(F.col("token"))
    return rows.withColumn("encoding", encoding).filter(
        "rank is null or (good and (token is null or encoding is not null))"
    ).select("row", "doc_id", "rank", "start", "end", "token", "encoding")


def limits(tests: DataFrame, rate: float) -> DataFrame:
    """``(encoding, octave, bin)``: the largest p-value that Benjamini and Hochberg reject among tokens of like length.

    P-values are rounded up to their bin, which keeps the rate; the rows are at most one
    per encoding, octave of length and bin.
    """
    counts = tests.groupBy("encoding", "octave", "bin").agg(F.count("*").alias("n"))
    alike = Window.partitionBy("encoding", "octave")
    running = F.sum("n").over(alike.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.select("encoding", "octave", "bin", running.alias("below"), F.sum("n").over(alike).alias("tests"))
    met = F.col("bin") / BINS <= F.log(F.lit(rate) * F.col("below") / F.col("tests"))
    return counts.filter(met).groupBy("encoding", "octave").agg(F.max("bin").alias("limit"))


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = 0.01, level: float = 0.001
) -> DataFrame:
    """``(doc_id, spans)``: the secrets of each text as structs ``(start, rank, kind, end)`` in order of start, then kind.

    Positions are code points, the end exclusive. Kinds are those of ``PATTERNS`` and ``random``:
    tokens of 16 or more characters that the battery does not tell from random strings at ``level``,
    that are no ordinary text at a false-discovery ``rate``, and that no base span touches.

    Null text is empty and gives no spans. One row per row of ``docs``, repeats and null doc_ids
    included; other columns are not read. The tests see the whole corpus, so equal tokens are
    judged alike everywhere; in an empty table, or without long tokens, nothing is tested. A text of any
    length is searched whole in one task; its spans are placed by a window, not by a loop. The
    limits joined to the tokens are one row for each encoding and octave of length: 4 x 31 at most.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = staged(candidates(rows), "spans")
    normal = staged(ordinary(rows), "background")
    symbols = body(F.col("token"), F.col("encoding"))
    tokens = found.filter("encoding is not null").select("row", "doc_id", "start", "end", "encoding", symbols.alias("symbols"))
    tests = measured(tokens.filter("length(symbols) > 2")).join(F.broadcast(normal), "encoding").select(
        "row", "doc_id", "start", "end", "encoding", F.floor(F.log2("length")).cast("int").alias("octave"),
        F.ceil(ordinary_p() * BINS).cast("int").alias("bin"), random_p().alias("random"))
    tests = staged(tests, "tests")
    chosen = tests.join(F.broadcast(limits(tests, rate)), ["encoding", "octave"]).filter(
        (F.col("bin") <= F.col("limit")) & (F.col("random") >= level))
    rank = len(PATTERNS)
    spans = found.filter("rank is not null and encoding is null").select("row", "doc_id", "rank", "start", "end").union(
        chosen.select("row", "doc_id", F.lit(rank), "start", "end"))
    # A base span that starts before the end of a token and ends after its start touches it.
    base = F.col("rank") < rank
    ordered = Window.partitionBy("row").orderBy("start")
    before = F.max(F.when(base, F.col("end"))).over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("start"))).over(ordered.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    touched = (F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    spans = spans.withColumn("touched", touched).filter(base | ~F.col("touched"))
    kind = F.element_at(F.array(*[F.lit(k) for k in [*PATTERNS, "random"]]), F.col("rank") + 1)
    everyone = found.filter("rank is null").select("row", "doc_id")
    gathered = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", kind.alias("kind"), "end"))).alias("spans"))
    empty = F.array().cast(gathered.schema["spans"].dataType)
    return everyone.join(gathered, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def counted(spans: Column, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
