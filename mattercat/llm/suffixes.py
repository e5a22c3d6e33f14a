"""Removal of byte strings that repeat anywhere in the corpus, by a depth-limited radix sort.

A suffix is ordered only through its first ``depth`` bytes, so suffixes that stay equal
to the end are exactly the repeated windows. The passes go from the most to the least
telling digit, and each keeps only suffixes that still share theirs with another:

1. *Anchor.* Of the ``gram``-byte strings inside a window the one with the smallest hash
   (the last of equal ones) is its leading digit. Equal windows pick equal anchors, and
   neighbouring windows mostly pick the same one, so a run of suffixes with one anchor
   (a *segment*) takes part as one row. Anchors that occur once end here.
2. *Segment.* Segments equal through all their bytes are repeats as a whole; of those,
   one goes on as representative.
3. *Window.* The windows of representatives whose anchor has different segments are
   ordered one by one through all ``depth`` bytes, as 128-bit hashes: those of up to ``GROUP``
   segments in one task, those of larger groups as rows of their own.

No pass brings a group of unbounded size to one task: groups are counted with partial
aggregation, and joins to the counts are split where a key is hot. Texts are keyed by
their digest, so copies of a document are worked on once after the first pass.

The same passes order suffixes through a number of words instead of bytes: windows then
begin and end at words, and anchors are strings of words. A window leaves out punctuation
before its first and after its last word, which often differs from place to place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, only, scratch, small_slices, staged

LOW = np.uint64((1 << 30) - 1)  # bits of a sliding minimum that hold the place
GROUP = 8192  # different segments of one anchor that are sorted in one place
BASES = (0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Strings:
    """Hashes of all substrings of a buffer, from prefix sums modulo 2**64."""

    values = np.random.default_rng(7).integers(0, 1 << 63, (2, 256), dtype="u8") * np.uint64(2) + np.uint64(1)
    powers: dict = {}

    def __init__(self, data: np.ndarray, lanes: int):
        size = len(data) + 1
        if len(self.powers.get(0, ([], []))[0]) < size:
            for lane, base in enumerate(BASES):
                up, down = np.full(size, base, "u8"), np.full(size, pow(base, -1, 1 << 64), "u8")
                up[0] = down[0] = 1
                self.powers[lane] = np.cumprod(up), np.cumprod(down)
        self.sums = []
        for lane in range(lanes):
            sums = np.zeros(size, "u8")
            np.cumsum(self.values[lane][data] * self.powers[lane][1][: size - 1], out=sums[1:])
            self.sums.append(sums)

    def hashes(self, first: np.ndarray, last: np.ndarray, lane: int) -> np.ndarray:
        """Hashes of ``data[first:last]``."""
        sums = self.sums[lane]
        raw = (sums[last] - sums[first]) * self.powers[lane][0][first]
        return mixed(raw + (last - first).astype("u8") * np.uint64(0x632BE59BD9B4E019))


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values, by minima from both ends of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo("u8").max, "u8")
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


SPACE, PLAIN = np.zeros(256, bool), np.ones(256, bool)
SPACE[list(b" \t\n\r\v\f")] = True
PLAIN[:128] = [chr(i).isalnum() for i in range(128)]  # letters and digits; all beyond ASCII


def word_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the number of words before each text and in all.

    Words are runs of bytes other than the six ASCII white spaces, without the ASCII
    punctuation around them; one of punctuation alone is kept whole.
    """
    inner = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = edge[ends] = True
    first = np.flatnonzero(inner & (edge[:-1] | np.concatenate([[True], ~inner[:-1]])))
    stop = np.flatnonzero(inner & (edge[1:] | np.concatenate([~inner[1:], [True]]))) + 1
    before = np.searchsorted(first, np.concatenate([starts, ends[-1:]]))
    plain = np.flatnonzero(PLAIN[data] & inner)
    if len(plain):
        low, high = np.searchsorted(plain, first), np.searchsorted(plain, stop)
        some = high > low
        first[some], stop[some] = plain[low[some]], plain[high[some] - 1] + 1
    return first, stop, before


def window_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int,
                  words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number, first byte and end of each window of ``depth`` bytes or words, and where all units begin and end."""
    if words:
        first, stop, before = word_places(data, starts, ends)
        low, high = before[:-1], before[1:]
    else:
        first = np.arange(len(data))
        stop, low, high = first + 1, starts, ends
    counts = np.maximum(high - low - depth + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(counts.sum()) + np.repeat(low - np.cumsum(counts) + counts, counts)
    return text, window, first[window], stop[window + depth - 1] if len(window) else window, (first, stop)


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, gram: int, words: bool = False):
    """Runs of windows with one anchor: ``(text, first, stop, anchor, hash, hash)``, from the first to the end of the last.

    ``data`` holds texts ``starts[i]:ends[i]``; places count from the start of the buffer.
    """
    none = np.zeros(0, "i8")
    if len(data) < depth:
        return none, none, none, none, none, none
    text, window, begin, end, (unit, unit_end) = window_places(data, starts, ends, depth, words)
    if not len(window):
        return none, none, none, none, none, none
    strings = Strings(data, 2)
    if words:
        grams = strings.hashes(unit[: len(unit) - gram + 1], unit_end[gram - 1:], 0)
    else:
        sums, up = strings.sums[0], strings.powers[0][0]
        grams = mixed((sums[gram:] - sums[:-gram]) * up[: len(data) - gram + 1])
    least = sliding_minimum((grams & ~LOW) | (LOW - np.arange(len(grams), dtype="u8")), depth - gram + 1)
    pick = (LOW - (least & LOW)).astype("i8")[window]
    new = np.flatnonzero(np.concatenate([[True], (pick[1:] != pick[:-1]) | (text[1:] != text[:-1])]))
    first, stop = begin[new], end[np.concatenate([new[1:], [len(window)]]) - 1]
    a, b = (strings.hashes(first, stop, lane).view("i8") for lane in (0, 1))
    return text[new], first, stop, grams[pick[new]].view("i8"), a, b


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all texts, with the start and end of each."""
    ends = np.cumsum([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), "u1"), ends - [len(t) for t in texts], ends


def repeated_spans(docs: DataFrame, depth: int = 400, gram: int = 100, words: bool = False) -> DataFrame:
    """``(key, first, stop)``: runs of windows of ``depth`` bytes that start elsewhere too.

    ``docs`` holds ``doc_id``, ``key``, the digest of the text, and ``text``. A run goes from the
    first byte of its first window to the end of its last; runs are not merged. With
    ``words`` both ``depth`` and ``gram`` count words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, key binary, first int, stop int, anchor bigint, a bigint, b bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            data, starts, ends = joined(byte_texts(batch.column("text")))
            text, first, stop, anchor, a, b = segments(data, starts, ends, depth, gram, words)
            base, row = starts[text], pa.array(text, "int64")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("key").take(row),
                 pa.array((first - base).astype("i4")), pa.array((stop - base).astype("i4")),
                 pa.array(anchor), pa.array(a), pa.array(b)],
                ["doc_id", "key", "first", "stop", "anchor", "a", "b"])

    long = docs.filter(F.octet_length("text") >= (2 * depth - 1 if words else depth))
    with scratch(docs.sparkSession) as keep:
        found = staged(long.mapInArrow(cut, shape), "segments")
        anchors = staged(found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
        shared = keep(found.join(anchors, "anchor", "left_semi"), "shared")

    # One row for each different segment, with one of its places.
    distinct = staged(shared.groupBy("anchor", "a", "b").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "doc_id", "first", "stop")).alias("at")), "distinct")
    # Written first, so that the rows of a segment that is everywhere are split by the join.
    common = staged(distinct.filter("n > 1").select("a", "b").distinct(), "common")
    whole = shared.join(common, ["a", "b"], "left_semi")

    several = staged(distinct.groupBy("anchor").agg(F.count("*").alias("members")).filter("members > 1"), "several")
    runs = distinct.join(several, "anchor").select("anchor", "members", "at.*").groupBy(
        F.col("key").alias("of_key"), F.col("doc_id").alias("of_doc")).agg(F.collect_list(F.struct("anchor", "members", "first", "stop")).alias("runs"))
    texts = long.join(staged(runs, "runs"), F.expr("key = of_key and doc_id <=> of_doc"))
    pieces = texts.select("key", F.col("text").cast("binary").alias("text"), F.explode("runs").alias("r")).select(
        "r.anchor", "r.members", "key", "r.first", F.expr("substring(text, r.first + 1, r.stop - r.first)").alias("data"))
    pieces = staged(pieces, "pieces")
    together = repeated_runs(pieces.filter(F.col("members") <= GROUP).drop("members"), depth, words)
    apart = repeated_windows(pieces.filter(F.col("members") > GROUP).drop("members"), depth, words)
    return whole.select("key", "first", "stop").union(together).union(apart).distinct()


def windows(batch: pa.RecordBatch, depth: int, words: bool) -> tuple[np.ndarray, ...]:
    """Row, number, first byte and end in the text and 128-bit hash of every window of a batch of pieces."""
    data, starts, ends = joined(byte_texts(batch.column("data")))
    row, number, begin, end, _ = window_places(data, starts, ends, depth, words)
    strings = Strings(data, 2)
    a, b = (strings.hashes(begin, end, lane) for lane in (0, 1))
    shift = batch.column("first").to_numpy()[row] - starts[row]
    return row, number, begin + shift, end + shift, a, b


def repeated_runs(pieces: DataFrame, depth: int, words: bool) -> DataFrame:
    """``(key, first, stop)``: runs of windows that another piece with the same anchor has too.

    Equal windows have equal anchors, so the pieces of one anchor, at most ``GROUP`` of them,
    are sorted in one place; a task holds those of a few anchors at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def found(ready: pa.RecordBatch) -> pa.RecordBatch:
            row, number, begin, end, a, b = windows(ready, depth, words)
            order = np.lexsort((b, a))
            same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
            twice = np.zeros(len(a), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            row, number, begin, end = row[twice], number[twice], begin[twice], end[twice]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)])) if len(row) else row
            last = np.concatenate([new[1:], [len(row)]]) - 1 if len(row) else row
            return pa.RecordBatch.from_arrays(
                [ready.column("key").take(pa.array(row[new])), pa.array(begin[new].astype("i4")), pa.array(end[last].astype("i4"))],
                ["key", "first", "stop"])

        for batch in small_slices(batches, "data"):
            anchor = batch.column("anchor").to_numpy()
            # Rows of the last anchor may go on in the next batch.
            cut = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if anchor[0] != anchor[-1] else 0
            if held and held[0].column("anchor")[-1].as_py() != anchor[0]:
                yield found(pa.concat_batches(held))
                held = []
            if cut:
                yield found(pa.concat_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield found(pa.concat_batches(held))

    return pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "key binary, first int, stop int")


def repeated_windows(pieces: DataFrame, depth: int, words: bool) -> DataFrame:
    """The same for anchors with any number of pieces: every window is a row of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "data"):
            row, _, begin, end, a, b = windows(batch, depth, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(row)), pa.array(begin.astype("i4")), pa.array(end.astype("i4")),
                 pa.array(a.view("i8")), pa.array(b.view("i8"))],
                ["key", "first", "stop", "a", "b"])

    each = staged(pieces.mapInArrow(run, "key binary, first int, stop int, a bigint, b bigint"), "windows")
    twice = staged(each.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b"), "repeated")
    return each.join(twice, ["a", "b"], "left_semi").select("key", "first", "stop")


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Spans in order, those that touch as one."""
    runs: list[list[int]] = []
    for first, stop in sorted(spans):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([first, stop])
    return runs


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = 400, gram: int = 100,
                   carry: str | None = None, words: int | None = None, cut_words: bool = True) -> DataFrame:
    """Every document without the bytes covered by a ``depth``-byte string that occurs twice.

    With ``words`` the strings of that many words that occur twice go too, however short they are; with
    ``cut_words=False`` they stay and come in one more column, ``passages``: runs of them as structs like those of
    ``removed``, judged on the input too, so that a passage also shows where its bytes are removed.

    Returns ``(doc_id, n_bytes, removed, kept)``: the UTF-8 length of the text, the removed
    runs as structs ``(first, last)`` of byte places (last exclusive, in order, apart by
    at least a byte), and the bytes that stay. All strings are judged on the input; the
    first occurrence goes like any other.

    ``carry`` names one more column to hand through, such as a struct of all others; then
    comes ``text`` too, what stays without characters that a cut has broken (null for null).

    Null and empty texts keep nothing and lose nothing. Texts shorter than ``depth`` stay
    whole. Repeated rows are copies of each other, whatever their doc_id, which may be null.
    An empty table gives no rows; other columns are not read. A very long text is one row
    of one task, which needs about 100 bytes for each of its own.
    """
    base = only(docs, doc_id=doc_id, text=text, **({"carry": carry} if carry else {}))
    keyed = base.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    source = keyed.select("doc_id", "key", "text")
    # Each order of suffixes leaves its spans; all its other tables go before the next one begins.
    with scratch(docs.sparkSession) as keep:
        spans = keep(repeated_spans(source, depth, gram), "spans")
    if words:
        with scratch(docs.sparkSession) as keep:
            found = keep(repeated_spans(source, words, max(1, words // 4), words=True), "spans")
            spans = spans.withColumn("cut", F.lit(True)).union(found.withColumn("cut", F.lit(cut_words)))
    else:
        spans = spans.withColumn("cut", F.lit(True))
    spans = staged(spans.groupBy("key").agg(F.collect_list(F.struct("first", "stop", "cut")).alias("spans")), "spans")
    told = bool(words) and not cut_words
    through = ["doc_id", "carry"] if carry else ["doc_id"]
    kinds = "".join(f"{n} {keyed.schema[n].dataType.simpleString()}, " for n in through)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            removed, kept, sizes, texts, passages = [], [], [], [], []
            for given, text, spans in zip(
                    batch.column("text").to_pylist(), byte_texts(batch.column("text")), batch.column("spans").to_pylist()):
                runs = merged([(s["first"], s["stop"]) for s in spans or () if s["cut"]])
                edges = [0, *(x for r in runs for x in r), len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2])) if runs else text)
                removed.append([{"first": i, "last": j} for i, j in runs])
                sizes.append(len(text))
                texts.append(given if not runs else kept[-1].decode("utf-8", "ignore"))
                passages.append([{"first": i, "last": j} for i, j in merged([(s["first"], s["stop"]) for s in spans or () if not s["cut"]])])
            places = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            found = {"n_bytes": pa.array(sizes, "int64"), "removed": pa.array(removed, places), "kept": pa.array(kept, pa.binary())}
            if carry:
                found["text"] = pa.array(texts, pa.string())
            if told:
                found["passages"] = pa.array(passages, places)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in through], *found.values()], [*through, *found])

    return keyed.join(spans, "key", "left").select(*through, "text", "spans").mapInArrow(
        strip, f"{kinds}n_bytes bigint, removed array<struct<first: bigint, last: bigint>>, kept binary" + (", text string" if carry else "")
        + (", passages array<struct<first: bigint, last: bigint>>" if told else ""))
