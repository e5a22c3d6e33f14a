"""Token sequences of fixed length: tokenise, cut, and pack by the sum-of-squares rule.

A piece goes where the sum, over residual gaps, of the squared number of open sequences
with that gap becomes smallest; opening a new sequence is one of the choices. The rule
needs only these counts, so a step costs one pass over at most ``capacity`` numbers.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, small_slices, staged

SHARD = 4096  # pieces packed together


def rank_table(path: str) -> tuple[dict[bytes, int], list[str]] | None:
    """Bytes and id of every token, and the special tokens, of a byte-level tokenizer file.

    Only if its ids are the order of its merges, which is all that a faster encoder of the
    same vocabulary needs to know; else None.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, split = described["model"], described.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if model.get("type") != "BPE" or not plain or described.get("normalizer") or model.get("ignore_merges"):
        return None
    # Byte-level vocabularies print each byte as a letter: printable ones as themselves, the others from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*shown}))}
    special = [t["content"] for t in described.get("added_tokens", [])]
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)) or len(vocabulary) != 256 + len(merges):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}, special


class Ids:
    """Ids of texts, as bytes of little-endian unsigned 32-bit numbers.

    The ids are those that ``tokenizers`` gives for the file. Where the vocabulary allows
    it, ``tiktoken`` finds the same ones at a third of the cost; texts that spell out a
    special token, and other kinds of file, go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.other, self.special, self.encode = path, None, [], None
        if table := rank_table(path):
            import tiktoken
            from public_tokenizers import PATTERN

            ranks, self.special = table
            self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def by_tokenizers(self, text: str) -> bytes:
        if self.other is None:
            from tokenizers import Tokenizer

            self.other = Tokenizer.from_file(self.path)
        return np.array(self.other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.encode is None or any(s in text for s in self.special):
            return self.by_tokenizers(text)
        return self.encode(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of each document's ids plus ``end_id``.

    ``docs`` holds ``doc_id`` and ``text``; ``tokenizer`` is the path of a tokenizer file.
    Documents of more than ``capacity`` ids are cut into pieces of that length, of which
    the first may be shorter. Null text is empty: one piece with ``end_id`` alone.
    """
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else "")
    kind = docs.schema["doc_id"].dataType.simpleString()
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + ([pa.binary()] if ids else [])
    names = [f.split()[0] for f in fields.split(", ")]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(tokenizer)
        for batch in small_slices(batches, "text"):
            rows, at = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                coded = memoryview(encode(text or "") + end)
                total = len(coded) // 4
                first = total % capacity or capacity if total > capacity else total
                for piece, start in enumerate([0, *range(first, total, capacity)]):
                    length = first if piece == 0 else capacity
                    part = coded[4 * start: 4 * (start + length)]
                    rows.append((piece, start, length, zlib.crc32(part), bytes(part))[:len(types)])
                    at.append(i)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, "int64")), *columns], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {fields}")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece (numbered as opened) and its offset there.

    Pieces come in the order given; full sequences no longer count. Moving a sequence
    from gap ``g`` to ``g - s`` changes the sum by ``2 (N[g - s] - N[g] + 1)``, by
    ``1 - 2 N[s]`` if it becomes full, and a new sequence by ``2 N[capacity - s] + 1``. Of
    equal changes the smallest gap wins.
    """
    counts = np.zeros(capacity + 1, "i8")
    open_ = [[] for _ in range(capacity + 1)]
    sequence, offset = np.zeros(len(lengths), "i8"), np.zeros(len(lengths), "i8")
    opened, never = 0, np.int64(1) << 40
    for i, s in enumerate(lengths.tolist()):
        held = counts[s:]
        change = np.where(held > 0, 2 * (counts[: capacity + 1 - s] - held + 1), never)
        change[0] = 1 - 2 * counts[s] if counts[s] else never
        gap = int(change.argmin())
        if change[gap] <= (2 * counts[capacity - s] + 1 if s < capacity else -1):
            number = open_[s + gap].pop()
            counts[s + gap] -= 1
            offset[i] = capacity - s - gap
        else:
            number, gap, opened = opened, capacity - s, opened + 1
        sequence[i] = number
        if gap:
            open_[gap].append(number)
            counts[gap] += 1
    return sequence, offset


def packed(parts: DataFrame, capacity: int) -> DataFrame:
    """``parts`` (with ``row`` and ``length``) packed shard by shard; adds ``sequence_id``, ``offset``, ``used``.

    Rows are dealt evenly over shards of about ``SHARD`` pieces, each packed by one task,
    longest first. A sequence is named by the row of its first piece.
    """
    shards = max(1, -(-parts.count() // SHARD))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)

    def run(group: pa.Table) -> pa.Table:
        group = group.drop_columns(["shard"])
        length, row = group.column("length").to_numpy(), group.column("row").to_numpy()
        order = np.lexsort((row, -length))
        found, offset = sum_of_squares(length[order], capacity)
        first = np.zeros(found.max() + 1, "i8")
        used = np.bincount(found, weights=length[order]).astype("i8")
        head = offset == 0
        first[found[head]] = row[order][head]
        for name, values in (("sequence_id", first[found]), ("offset", offset), ("used", used[found])):
            column = np.zeros(len(order), "i8")
            column[order] = values
            group = group.append_column(name, pa.array(column))
        return group

    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, f"{fields}, sequence_id bigint, offset bigint, used bigint")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048,
                   end_id: int = 0, ids: bool = False, slack: float = 1 / 64) -> DataFrame:
    """Every piece of every document with its place in a sequence of ``capacity`` ids.

    Returns ``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``. The
    pieces of a sequence fill it from 0 without gaps. Tokenising runs once: pieces are
    written to the shared folder and packed from there in two rounds. Pieces that fill
    a sequence are done; the others are packed in shards, and what lies in sequences
    with more than ``slack`` of the capacity free is packed again, shards drawn anew.

    Null and empty texts are pieces of one id. Repeated rows are pieces of their own, a
    null doc_id stays null, an empty table gives no rows, and other columns are not read.
    """
    found = pieces(only(docs, doc_id=doc_id, text=text), tokenizer, capacity, end_id, ids)
    parts = staged(found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = parts.filter(F.col("length") == capacity).select("*", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = staged(packed(parts.filter(F.col("length") < capacity), capacity), "packed")
    done = F.col("used") >= capacity - int(capacity * slack)
    again = packed(first.filter(~done).drop("sequence_id", "offset", "used"), capacity)
    return full.union(first.filter(done).drop("used")).union(again.drop("used")).drop("row")
