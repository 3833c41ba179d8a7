"""Packing: the plan against checks of every slot, pieces against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from llm_rows import EDGES, documents  # noqa: F401

from meterstar.llm import packing
from meterstar.llm.common import read_table


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def first_fit_best(lengths, capacity):
    """Sequences that best fit, longest first, needs when it places one piece at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= length]
        room = min(fitting) if fitting else capacity
        if fitting:
            rooms.remove(room)
        rooms.append(room - length)
    return len(rooms)


def test_every_slot_of_the_plan():
    rng = random.Random(8)
    for _ in range(200):
        capacity = rng.choice([1, 5, 10, 50, 200])
        counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randrange(30))}
        sequences, ranks = {}, {}
        for length, a, b, first, offset in packing.plan_slots(counts, capacity):
            ranks.setdefault(length, []).extend(range(a, b))
            for i in range(b - a):
                sequences.setdefault(first + i, []).append((offset, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
        for members in sequences.values():
            at = 0
            for offset, length in sorted(members):
                assert offset == at
                at += length
            assert at <= capacity
        pieces = [length for length, n in counts.items() for _ in range(n)]
        assert len(sequences) <= first_fit_best(pieces, capacity) * 1.1 + 1


def test_cuts():
    assert list(packing.cut(5, 10)) == [(0, 5)] and list(packing.cut(10, 10)) == [(0, 10)]
    assert list(packing.cut(23, 10)) == [(0, 3), (3, 10), (13, 10)]
    assert list(packing.cut(20, 10)) == [(0, 10), (10, 10)]


def check(rows, packed, library, capacity=2048):
    """Every document is there whole, and every sequence is filled without gaps."""
    want = []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            want.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed]
    assert sorted(map(str, got)) == sorted(map(str, want))
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(r.length for r in packed) // capacity)


def test_hard_documents(spark, documents, library):
    rows = EDGES + [(20, "<|endoftext|> and <|endoftext|>x"), (21, "é漢🙂\x00"), (22, " lead"), (23, "a" * 3000)]
    rows += [(100 + i, "same words again " * 50) for i in range(60)]
    packed = packing.pack_documents(documents(rows)).collect()
    check(rows, packed, library)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in packed)
    assert packing.pack_documents(documents([])).collect() == []


def test_given_documents_fill_their_sequences(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 50)  # many groups
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    packed = packing.pack_documents(docs, keep_ids=False).collect()
    used, least = check([(r.doc_id, r.text) for r in docs.collect()], packed, library)
    assert used <= least * 1.02 + 1


def test_clashing_names_are_kept(spark):
    names = "length bigint, _row int, _group string, _n int, _before int, _inside int, _slot int, _rank int, offset string"
    rows = [(5, 1, "g", 2, 3, 4, 5, 6, "o"), (7, 1, "g", 2, 3, 4, 5, 6, "o"), (5, 9, None, 2, 3, 4, 5, 6, "o")]
    df = spark.createDataFrame(rows, names)
    out = packing.pack(df, 12)
    assert out.columns == [*df.columns, "sequence_id", "_offset"]
    got = out.collect()
    assert sorted((tuple(r)[:9] for r in got), key=str) == sorted(rows, key=str)
    assert {(r.offset, r._group) for r in got} == {("o", "g"), ("o", None)}
