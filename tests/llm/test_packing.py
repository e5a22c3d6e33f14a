import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mattercat.llm import packing

BPE = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return np.array(Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_ids_are_those_of_the_tokenizer_file():
    own = packing.Ids(BPE)
    assert own.encode is not None
    for text in ["", " ", "a  b \n c", "don't it's\t\tx", "é漢\xa0字 ½²🙂", "x <|endoftext|> y", "\x1c  .\n\n", "word " * 500]:
        assert own(text) == own.by_tokenizers(text) == ids_of(text)[:-1].tobytes()


def test_other_kinds_of_file_go_through_the_tokenizer():
    assert packing.rank_table(public_tokenizers.path("word_bpe_49k.json")) is None


@pytest.mark.parametrize("capacity", [8, 64])
def test_every_id_is_packed_once(spark, capacity):
    texts = [None, "", "one", "one", "some words here, and more " * 40, "x" * 3000, "a b c d e f g"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, 9) for i, t in enumerate(texts)], "doc_id bigint, text string, offset int")
    rows = packing.pack_documents(docs, BPE, capacity=capacity, ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, found in by_doc.items():
        found.sort(key=lambda r: r.piece)
        whole = ids_of(texts[3 if doc_id is None else doc_id])
        assert b"".join(bytes(r.ids) for r in found) == whole.tobytes()
        assert [r.start for r in found] == np.cumsum([0, *[r.length for r in found]])[:-1].tolist()
        assert all(r.length == capacity for r in found[1:]) and (len(found) == 1 or found[0].length <= capacity)
    for found in by_sequence.values():
        end = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= capacity
    assert len(by_doc) == len(texts)


def test_repeated_rows_are_pieces_of_their_own(spark):
    docs = spark.createDataFrame([(1, "same text")] * 5, "doc_id bigint, text string")
    assert len(packing.pack_documents(docs, BPE, capacity=16).collect()) == 5
    assert packing.pack_documents(docs.limit(0), BPE).collect() == []


def greedy(lengths, capacity):
    """The rule stated plainly: try every choice and take the least sum of squares."""
    gaps, places = [], []
    for s in lengths:
        best = None
        for choice in [*sorted({g for g in gaps if g >= s}), None]:
            after = list(gaps)
            if choice is None:
                after.append(capacity - s)
            else:
                after[after.index(choice)] -= s
            counts = defaultdict(int)
            for g in after:
                if g:
                    counts[g] += 1
            total = sum(n * n for n in counts.values())
            if best is None or total < best[0]:
                best = total, choice
        if best[1] is None:
            gaps.append(capacity - s)
            places.append(capacity)
        else:
            gaps[gaps.index(best[1])] -= s
            places.append(best[1])
    return gaps, places


def test_sum_of_squares_rule():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = rng.integers(1, 13, 60)
        sequence, offset = packing.sum_of_squares(lengths, 12)
        gaps, places = greedy(lengths.tolist(), 12)
        assert (12 - offset).tolist() == places
        used = np.bincount(sequence, weights=lengths)
        assert sorted(12 - used) == sorted(gaps)


def test_packing_is_close_to_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs, BPE, capacity=2048).collect()
    assert len({r.sequence_id for r in rows}) <= 1.02 * sum(r.length for r in rows) / 2048
