"""BPE encoding and decoding in batched numpy merge rounds.

The distinct new words of a batch are laid end to end in one flat array of symbols. A round
looks up every neighbouring pair by binary search over the sorted keys of the merge table,
finds each word's lowest rank, and merges that pair wherever it stands in the word (left to
right, not overlapping). Words without a mergeable pair drop out; rounds go on until none
is left. In a vocabulary whose merges only use what lower ranks made, merging all places of
a word's lowest pair at once gives the same as merging them one by one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from meterstar.llm.common import over_texts

CACHED_WORDS = 400_000  # words kept per task
NO_RANK = np.iinfo(np.int32).max


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Beyond these (Latin, Greek, Cyrillic), and for the letters that lower-case by context or
# out of this range, the library's own normaliser and splitter prepare the text: releases
# of Unicode differ there.
UNUSUAL = re.compile("[\u0130\u023a\u023e\u03a3\u0530-\U0010ffff]")
SPACES = "\\t-\\r \\x85\\xa0"


def _plain_pattern(pattern: str) -> str:
    """The pattern for `re`, its classes spelt out for the characters below U+0530."""
    def ranges(wanted: str) -> str:
        letters = [chr(c) for c in range(0x530) if unicodedata.category(chr(c))[0] == wanted]
        return "".join(map(re.escape, letters))

    spelt = pattern.replace("\\p{L}", ranges("L")).replace("\\p{N}", ranges("N"))
    return spelt.replace("\\s", SPACES)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 0
    for b in range(256):
        letters.append(chr(b) if b in shown else chr(256 + extra))
        extra += b not in shown
    return letters


class WordBpe:
    """A word-end BPE vocabulary: texts to ids and back."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # Text preparation as the vocabulary's file states it.
        self.normalizer = Tokenizer.from_file(path).normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.exact_words = lambda text: [w for w, _ in splitter.pre_tokenize_str(text)]
        self.words = re.compile(_plain_pattern(pattern))
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        self.width = max(vocab.values()) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {a + b: rank for rank, (a, b) in enumerate(merges)}
        if len(made) < len(merges) or any(
            max(made.get(a, -1), made.get(b, -1)) >= rank for rank, (a, b) in enumerate(merges)
        ):
            raise ValueError("a merge uses what a higher rank makes: merge places one by one")
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.cache: dict[str | int, bytes] = {}

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, little-endian unsigned 32-bit, all words at once."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(b) for b in data], np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.first[flat]
        symbols[np.cumsum(lengths) - 1] = self.last[flat[np.cumsum(lengths) - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.full(len(symbols), NO_RANK, np.int32)
            rank[:-1][known] = self.ranks[at[known]]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(owner))
            active = np.repeat(lowest != NO_RANK, sizes)
            if not active.all():
                finished.append((owner[~active], symbols[~active]))
                owner, symbols, rank = owner[active], symbols[active], rank[active]
                keep = lowest != NO_RANK
                lowest, sizes = lowest[keep], sizes[keep]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, sizes)
            # Of pairs that overlap (a run of one symbol), take every other one.
            where = np.flatnonzero(hit)
            run_start = np.diff(where, prepend=-2) != 1
            place_in_run = np.arange(len(where)) - np.flatnonzero(run_start)[np.cumsum(run_start) - 1]
            where = where[place_in_run % 2 == 0]
            symbols[where] = self.result[rank[where]]
            stays = np.ones(len(symbols), bool)
            stays[where + 1] = False
            owner, symbols = owner[stays], symbols[stays]
        if not finished:
            return [b""] * len(words)
        owners = np.concatenate([o for o, _ in finished])
        ids = np.concatenate([s for _, s in finished])
        data = ids[np.argsort(owners, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owners, minlength=len(words)))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def pieces(self, text: str) -> list[str | int]:
        """Words of a text, and the ids of special tokens that stand in it."""
        found: list[str | int] = []
        parts = self.split.split(text) if "<|" in text else [text]
        for i, part in enumerate(parts):
            if i % 2:
                found.append(self.special[part])
            elif UNUSUAL.search(part) or not unicodedata.is_normalized("NFC", part):
                found += self.exact_words(self.normalizer.normalize_str(part))
            else:
                found += self.words.findall(part.lower())
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        split = [self.pieces(text) for text in texts]
        used = set().union(*split)
        new = used - self.cache.keys()
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = used
        words = [w for w in new if isinstance(w, str)]
        self.cache.update(zip(words, self.merge_words(words)))
        self.cache.update((i, i.to_bytes(4, "little")) for i in new if not isinstance(i, str))
        ids = self.cache.__getitem__
        return [b"".join(map(ids, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the vocabulary's file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def encode_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     path: str | None = None) -> DataFrame:
    """Ids of every whole text and the text decoded from them, one row per row of `docs`.

    `ids` is binary, little-endian unsigned 32-bit. Null and empty texts have no ids and
    decode to an empty text. Ids of documents may be null or repeat; other columns are not
    looked at.
    """
    path = path or default_vocabulary()

    def make():
        bpe = vocabulary(path)

        def run(batch: pa.RecordBatch) -> dict:
            encoded = bpe.encode([t or "" for t in batch.column(1).to_pylist()])
            return {"id": batch.column(0),
                    "n_tokens": pa.array([len(x) // 4 for x in encoded], pa.int64()),
                    "ids": pa.array(encoded, pa.binary()),
                    "decoded": pa.array([bpe.decode(x) for x in encoded], pa.string())}

        return run

    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return over_texts(
        plain, "text", f"id: {kind}, n_tokens: long, ids: binary, decoded: string", make
    ).withColumnRenamed("id", id_column)


def digest(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_column, "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )

