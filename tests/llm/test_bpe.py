"""BPE against the tokenizers library on the same vocabulary, byte for byte."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from llm_rows import EDGES, documents  # noqa: F401

from meterstar.llm import bpe
from meterstar.llm.common import read_table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ours():
    return bpe.WordBpe(PATH)


def same(library, ours, texts):
    for text, ids in zip(texts, ours.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:80]
        assert ours.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_every_code_point(library, ours):
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and not 0x20000 <= c < 0xE0000]
    texts = ["".join(f"a{c}b {c}1" for c in points[i : i + 200]) for i in range(0, len(points), 200)]
    same(library, ours, texts)


def test_hard_texts(library, ours):
    same(library, ours, [
        "", " ", "<|endoftext|>", "<|startoftext|>hi <|endoftext|>x", "<|ENDOFTEXT|>", "<|endoftext", "a<|endoftext|>b",
        "aaaaaaaaaaaaaaa", "a" * 5001, "thethethe" * 200, "ΑΣ ΣΑΣ.", "İI ı", "don't we'll IT'S 'S", " x\x1cy\x85z",
        "é é ẛ̣", "\x00\x01", "日本語テキスト", "🙂🙂👩‍👩‍👧", "½ ² 12 ١٢", "ȺȾ ſt",
    ])


def test_random_mixtures(library, ours):
    rng = random.Random(5)
    parts = ["the", "ing", "aaaa", "é", "ß", "'s", "'LL", " ", "\n", "12", "!!", "Ж", "漢", "<|endoftext|>", "ab" * 20]
    same(library, ours, ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(500)])


def test_a_full_cache_is_emptied(library, ours, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    same(library, ours, ["one two three four", "five six seven one", "one two", "a b c d e f g h i"])


def test_a_vocabulary_whose_merges_go_back_is_refused(tmp_path):
    import json

    spec = json.load(open(PATH))
    spec["model"]["merges"] = [["in", "g</w>"], ["i", "n"]]
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.WordBpe(str(path))


def test_documents(spark, documents, library):
    rows = EDGES + [(9, "Ünï <|endoftext|> done")]
    got = bpe.digest(bpe.encode_documents(documents(rows))).collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_given_documents(spark, library):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in bpe.encode_documents(docs).collect()}
    for row in docs.collect():
        want = library.encode(row.text, add_special_tokens=False).ids
        assert np.frombuffer(got[row.doc_id].ids, "<u4").tolist() == want
