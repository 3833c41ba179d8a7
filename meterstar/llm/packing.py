"""Best-fit packing of tokenised documents, planned over the histogram of lengths.

The plan needs counts only: how many pieces there are of each length. Best fit runs over
those (at most `capacity`) counts, so its size does not grow with the data. A planned slot
range says: pieces of length L with ranks r0 <= rank < r1 go, one each, to the sequences
s0, s0 + 1, ... at one offset. Pieces then take their slots by a join on the rank within
their length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import free_name, over_texts
from meterstar.scratch import staged

CAPACITY = 2048
END_ID = 0
SPECIAL = "<|endoftext|>"
RANK_GROUP = 20_000  # pieces that one window partition ranks, on average


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary; its one special token is recognised in texts."""
    import public_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens={SPECIAL: len(ranks)},
    )


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n ids; of a cut document the first may be shorter."""
    first = n if n <= capacity else n % capacity or capacity
    yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


def tokenised_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start, length and `ids`, little-endian unsigned 32-bit."""
    vocabulary = vocabulary or default_vocabulary()

    def make():
        encode = encoder(vocabulary).encode

        def pieces(batch: pa.RecordBatch) -> dict:
            rows, numbers, starts, lengths, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = np.array([*encode(text or "", allowed_special="all"), end_id], "<u4")
                for piece, (start, length) in enumerate(cut(len(tokens), capacity)):
                    rows.append(i)
                    numbers.append(piece)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(tokens[start : start + length].tobytes())
            return {"id": batch.column(0).take(pa.array(rows, pa.int64())),
                    "piece": pa.array(numbers, pa.int32()), "start": pa.array(starts, pa.int64()),
                    "length": pa.array(lengths, pa.int64()), "ids": pa.array(ids, pa.binary())}

        return pieces

    kind = docs.schema[id_column].dataType.simpleString()
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return over_texts(
        plain, "text", f"id: {kind}, piece: int, start: long, length: long, ids: binary", make
    ).withColumnRenamed("id", id_column)


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset) of all slots.

    Best fit, longest first, over counts. Open sequences are held as ranges by the room
    they have left; a count that is larger than the range it meets uses up the range and
    goes on, so every step settles a length, a range, or splits one range in two.
    """
    open_ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    slots, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def place(first: int, n: int, room: int) -> None:
            nonlocal rank, left
            slots.append((length, rank, rank + n, first, capacity - room))
            if room > length:
                open_ranges[room - length].append((first, n))
            rank, left = rank + n, left - n

        room = length
        while left and room <= capacity:
            if not open_ranges[room]:
                room += 1
                continue
            first, n = open_ranges[room].pop()
            if n > left:
                open_ranges[room].append((first + left, n - left))
                n = left
            place(first, n, room)
            # What now has less room may still be the best fit for the same length.
            room = max(length, room - length) if room >= 2 * length else room
        while left:
            # New sequences take as many of this length as fit, whole ones first.
            each = capacity // length
            n = left // each or 1
            first, fill = sequences, min(each, left)
            sequences += n
            for k in range(fill):
                slots.append((length, rank, rank + n, first, k * length))
                rank, left = rank + n, left - n
            if (room := capacity - fill * length) > 0:
                open_ranges[room].append((first, n))
    return slots


def _ranked(pieces: DataFrame, row: str, rank: str, rows: int) -> DataFrame:
    """`pieces` with a gapless `rank` from 0 within each length, in the place of `row`.

    A length may hold most of the rows, so ranks are made in groups of bounded size: within
    a group by a window, and from group to group by a running sum over group counts.
    """
    group, n, before, inside = (free_name(pieces, x) for x in ("_group", "_n", "_before", "_inside"))
    groups = max(1, rows // RANK_GROUP)
    grouped = pieces.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
    counts = grouped.groupBy("length", group).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy("length").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", group, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    own = Window.partitionBy("length", group).orderBy(row)
    return (
        grouped.withColumn(inside, F.row_number().over(own) - 1)
        .join(offsets, ["length", group])
        .withColumn(rank, F.col(before) + F.col(inside))
        .drop(group, before, inside, row)
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row of `pieces` a `sequence_id` and an `offset`, gapless from 0.

    `pieces` needs a column `length` (1 to `capacity`) and is evaluated once; it keeps its
    other columns; new names that it has get underscores before them. Repeated rows take a
    slot each. No pieces give no rows.
    """
    spark = pieces.sparkSession
    row, rank, slots_name, slot = (free_name(pieces, x) for x in ("_row", "_rank", "_slots", "_slot"))
    # The number of a row is frozen by writing it.
    table = staged(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    # At most `capacity` rows, whatever the input's size.
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int]]] = {}
    for length, first, _, sequence, offset in plan_slots(counts, capacity):
        slots.setdefault(length, []).append((first, sequence, offset))
    plan = spark.createDataFrame(
        list(slots.items()),
        f"length long, `{slots_name}` array<struct<rank: long, sequence: long, offset: long>>",
    )
    taken = F.element_at(F.filter(slots_name, lambda s: s["rank"] <= F.col(rank)), -1)
    return (
        # The plan has at most `capacity` rows and is bounded by it, not by the data.
        _ranked(table, row, rank, sum(counts.values())).join(F.broadcast(plan), "length")
        .withColumn(slot, taken)
        .select(
            *pieces.columns,
            (F.col(f"{slot}.sequence") + F.col(rank) - F.col(f"{slot}.rank")).alias(free_name(pieces, "sequence_id")),
            F.col(f"{slot}.offset").alias(free_name(pieces, "offset")),
        )
    )


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   capacity: int = CAPACITY, vocabulary: str | None = None,
                   keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and pack whole documents; a null text counts as empty (one end id).

    Returns id, piece, start, length, ids_crc32, sequence_id and offset, and with `keep_ids`
    the `ids` themselves, little-endian unsigned 32-bit. Ids of documents may be null or
    repeat; columns other than id and text are not looked at.
    """
    pieces = tokenised_pieces(docs, id_column, text_column, capacity, vocabulary=vocabulary)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces if keep_ids else pieces.drop("ids"), capacity)
