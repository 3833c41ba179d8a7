"""Quality rules with cross-document line frequency.

A document's lines are normalised (ASCII letters lower-cased, white space collapsed, digit
runs as 0) and hashed. A line stands above the limit on a host if more than `share` of the
host's documents, and at least `min_documents`, hold it. Such lines are removed, and a
document that keeps too little without them is rejected. Documents with equal texts count
once: a page that was crawled a thousand times is one document, and removing copies is not
this rule's business.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import free_name, over_texts
from meterstar.scratch import staged

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SHARE = 0.1
MIN_DOCUMENTS = 20
KEEP_PERCENT = 20  # of its words, at least
FREQUENT_LINES = 200_000  # hashes of lines above the limits that tasks may hold, about 20 MB

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
DIGITS = re.compile(rb"[0-9]+")


def line_mark(line: bytes) -> bytes:
    """The 128-bit hash of a normalised line."""
    return xxhash.xxh3_128_digest(DIGITS.sub(b"0", b" ".join(line.lower().split())))


def repeated_words(ids: np.ndarray, owner: np.ndarray, n_owners: int) -> np.ndarray:
    """How many words of each owner lie in 8-word windows that occur twice or more in it.

    `ids` numbers equal words equally. Windows of 8 get numbers by doubling: a pair of
    numbers of windows of 1, 2 and 4 words becomes one number, without hashing.
    """
    if len(ids) < WINDOW:
        return np.zeros(n_owners, np.int64)
    window, width = ids.astype(np.int64), 1
    while width < WINDOW:
        left, right = window[:-width], window[width:]
        window = np.unique(left * (window.max() + 1) + right, return_inverse=True)[1]
        width *= 2
    whole = owner[: len(window)] == owner[WINDOW - 1 :]
    start = np.flatnonzero(whole)
    key = owner[start].astype(np.int64) * (window.max() + 1) + window[start]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = start[counts[inverse] > 1]
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    return np.bincount(owner, weights=np.cumsum(edges[:-1]) > 0, minlength=n_owners).astype(np.int64)


MEASURED = (
    "struct<_text_hash: binary, n_words: bigint, word_chars: bigint, n_symbols: bigint, "
    "n_dup_lines: bigint, n_repeat_words: bigint, "
    "_lines: array<struct<mark: binary, words: bigint>>>"
)
LINE = pa.struct([("mark", pa.binary()), ("words", pa.int64())])


def _measure(texts: list[str | None]) -> dict:
    marks, n_words, chars, symbols, duplicates, lines = [], [], [], [], [], []
    numbers: dict[bytes, int] = {}
    ids: list[int] = []
    for text in texts:
        text = text or ""
        data = text.encode("utf-8", "surrogatepass")
        marks.append(xxhash.xxh3_128_digest(data))
        chars.append(len(text) - sum(map(text.count, SPACES)))
        symbols.append(sum(map(text.count, SYMBOLS)))
        total, again, seen, own = 0, 0, set(), {}
        for line in data.split(b"\n"):
            words = line.split()
            if not words:
                continue
            total += len(words)
            again += line in seen
            seen.add(line)
            ids += [numbers.setdefault(w, len(numbers)) for w in words]
            mark = line_mark(line)
            own[mark] = own.get(mark, 0) + len(words)
        n_words.append(total)
        duplicates.append(again)
        lines.append([{"mark": m, "words": n} for m, n in own.items()])
    owner = np.repeat(np.arange(len(texts)), n_words)
    repeats = repeated_words(np.array(ids, np.int64), owner, len(texts))
    return {
        "_text_hash": pa.array(marks, pa.binary()), "n_words": pa.array(n_words, pa.int64()),
        "word_chars": pa.array(chars, pa.int64()), "n_symbols": pa.array(symbols, pa.int64()),
        "n_dup_lines": pa.array(duplicates, pa.int64()), "n_repeat_words": pa.array(repeats),
        "_lines": pa.array(lines, pa.list_(LINE)),
    }


def _host_key(host: str) -> Column:
    """A host as text; null is a value of its own, so that plain equality joins hold it."""
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))


def frequent_lines(texts: DataFrame, lines: DataFrame, share: float, min_documents: int) -> DataFrame:
    """(host, mark) of the lines above the limits, from `texts` (host, text_hash) and `lines`
    (the same and mark).

    Distinct texts first, then plain counts: both are summed before they are shuffled.
    """
    documents = texts.distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    return (
        lines.select("host", "mark", "text_hash").distinct()
        .groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_documents)
        .join(documents, "host")
        .filter(F.col("n") > share * F.col("documents"))
        .select("host", "mark")
    )


def judge(docs: DataFrame, host_column: str = "source", text_column: str = "text",
          share: float = SHARE, min_documents: int = MIN_DOCUMENTS,
          keep_text: bool = True) -> DataFrame:
    """`docs` with one more column, `verdict`: a struct of the measures, base_failed, kept
    and `removed`, the marks of the lines above the limits (null if there are none).

    With `keep_text` false the text is dropped early. (If `docs` has a column `verdict`, the new one gets underscores before its name.) Every
    row is judged by its own text; a null text is empty. Rows whose host is null share one
    host. Ids are not used, so they may be null or repeat.
    """
    columns = [c for c in docs.columns if keep_text or c != text_column]
    row, judged, host = (free_name(docs, n) for n in ("_row", "verdict", "_host"))
    stats = free_name(docs, "_stats")
    measured = over_texts(
        docs.withColumn(host, F.col(host_column).cast("string")), text_column,
        f"`{stats}` {MEASURED}",
        lambda: lambda batch: {stats: _as_struct(_measure(
            batch.column(batch.schema.get_field_index(text_column)).to_pylist()))},
        keep=True,
    )
    if not keep_text:
        measured = measured.drop(text_column)
    table = staged(measured.withColumn(row, F.monotonically_increasing_id()), "lines")

    lines = table.select(
        row, _host_key(host).alias("host"), F.col(f"{stats}._text_hash").alias("text_hash"),
        F.explode(f"{stats}._lines").alias("line"),
    ).select(row, "host", "text_hash", "line.mark", "line.words")
    texts = table.select(_host_key(host).alias("host"), F.col(f"{stats}._text_hash").alias("text_hash"))
    frequent = frequent_lines(texts, lines, share, min_documents)
    removed = (
        lines.select(row, "host", "mark", "words").join(frequent, ["host", "mark"])
        .groupBy(row)
        .agg(F.sum("words").alias("removed_words"), F.collect_list("mark").alias("removed"))
    )
    s = F.col(stats)
    base_failed = (s["n_words"] < MIN_WORDS) | (
        100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"]
    )
    left = s["n_words"] - F.coalesce(F.col("removed_words"), F.lit(0))
    depleted = (left < MIN_WORDS) | (100 * left < KEEP_PERCENT * s["n_words"])
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return table.join(removed, row, "left").select(
        *columns,
        F.struct(
            *[s[m].alias(m) for m in measures],
            base_failed.alias("base_failed"),
            (~base_failed & ~depleted).alias("kept"),
            F.col("removed"),
        ).alias(judged),
    )


def _as_struct(columns: dict) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def without_lines(text: str, removed: set[bytes]) -> str:
    """The text without the lines whose marks are in `removed`; lines without words stay."""
    return "\n".join(
        line for line in text.split("\n")
        if not line.strip(SPACES) or line_mark(line.encode("utf-8", "surrogatepass")) not in removed
    )


def filter_documents(docs: DataFrame, host_column: str = "source",
                     text_column: str = "text", length_column: str = "n_chars",
                     share: float = SHARE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The kept rows of `docs`, lines above the limits taken out of their texts, in its columns.

    As in `judge`: a null text is empty and goes, null hosts are one host, ids may repeat or be
    null, repeated rows are judged alike, and an empty table gives no rows. Lengths of changed
    texts are renewed.

    The lines above the limits go to the tasks, which read the texts a second time and never
    shuffle them; beyond FREQUENT_LINES such lines, the verdicts are joined to the rows instead.
    """
    host, text = free_name(docs, "_host"), text_column
    keyed = docs.withColumn(host, _host_key(host_column))

    def hashed():
        def run(batch: pa.RecordBatch) -> dict:
            own = batch.column(1).to_pylist()
            marks = [list({line_mark(line) for line in (t or "").encode("utf-8", "surrogatepass").split(b"\n")
                           if line.split()}) for t in own]
            return {"host": batch.column(0), "marks": pa.array(marks, pa.list_(pa.binary())),
                    "text_hash": pa.array([xxhash.xxh3_128_digest((t or "").encode("utf-8", "surrogatepass"))
                                           for t in own], pa.binary())}

        return run

    texts = over_texts(keyed.select(F.col(host).alias("host"), F.col(text).alias("text")), "text",
                       "host string, text_hash binary, marks array<binary>", hashed)
    texts = staged(texts, "line-marks")
    lines = texts.select("host", "text_hash", F.explode("marks").alias("mark"))
    frequent = staged(frequent_lines(texts.select("host", "text_hash"), lines, share, min_documents), "frequent")
    if frequent.count() > FREQUENT_LINES:
        return _filtered_by_join(docs, host_column, text, length_column, share, min_documents)
    held: dict[str, set[bytes]] = {}
    for line in frequent.collect():
        held.setdefault(line.host, set()).add(bytes(line.mark))

    kept, cleaned = free_name(docs, "_kept"), free_name(docs, "_cleaned")

    def make():
        def clean(batch: pa.RecordBatch) -> dict:
            own, hosts = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in (text, host))
            measured = _measure(own)
            words, repeats = (measured[n].to_numpy() for n in ("n_words", "n_repeat_words"))
            out, good = [], []
            for i, lines in enumerate(measured["_lines"].to_pylist()):
                gone = held.get(hosts[i], ())
                removed = {x["mark"] for x in lines if x["mark"] in gone}
                left = words[i] - sum(x["words"] for x in lines if x["mark"] in removed)
                failed = words[i] < MIN_WORDS or 100 * repeats[i] > MAX_REPEAT_PERCENT * words[i]
                good.append(bool(not failed and left >= MIN_WORDS and 100 * left >= KEEP_PERCENT * words[i]))
                out.append(without_lines(own[i], removed) if removed and good[-1] else None)
            return {kept: pa.array(good), cleaned: pa.array(out, pa.string())}

        return clean

    out = over_texts(keyed, text, f"`{kept}` boolean, `{cleaned}` string", make, keep=True).filter(F.col(kept))
    new = F.col(cleaned)
    return out.select(*[
        F.coalesce(new, F.col(c)).alias(c) if c == text
        else F.when(new.isNull(), F.col(c)).otherwise(F.length(new)).alias(c) if c == length_column
        else F.col(c)
        for c in docs.columns
    ])


def _filtered_by_join(docs: DataFrame, host_column: str, text_column: str, length_column: str,
                      share: float, min_documents: int) -> DataFrame:
    """`filter_documents` for any number of lines above the limits."""
    name = free_name(docs, "verdict")
    kept = judge(docs, host_column, text_column, share, min_documents).filter(F.col(f"{name}.kept"))
    marks = free_name(kept, "_removed")
    kept = kept.withColumn(marks, F.col(f"{name}.removed")).drop(name)
    cleaned = free_name(kept, "_cleaned")

    def make():
        def clean(batch: pa.RecordBatch) -> dict:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            return {cleaned: pa.array([
                without_lines(text, set(gone)) if gone else text
                for text, gone in zip(column[text_column].to_pylist(), column[marks].to_pylist())
            ], pa.string())}

        return clean

    out = over_texts(kept, text_column, f"`{cleaned}` string", make, keep=True)
    columns = [
        F.col(cleaned).alias(c) if c == text_column
        else F.when(F.col(marks).isNull(), F.col(c)).otherwise(F.length(cleaned)).alias(c)
        if c == length_column else F.col(c)
        for c in docs.columns
    ]
    return out.select(*columns)


def digest(judged: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return judged.select(id_column, "verdict.*").drop("removed")
