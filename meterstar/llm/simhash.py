"""SimHash near-duplicates by a generalised pigeonhole.

A text's fingerprint has 64 bits; bit b is 1 if it is set in over half of the text's shingle
hashes. Two fingerprints link if at most D of their bits differ.

The bits are dealt into m parts. If a part i is given the threshold t_i, and the t_i + 1 sum up
to D + 1, then of two linked fingerprints at least one part i differs in at most t_i bits:
otherwise they would differ in D + 1 bits. So a fingerprint finds all its partners if it probes,
in every part, all values within that part's threshold; -1 stands for a part not probed at all.

- Bits that go together (by their correlation over all distinct fingerprints) share a part, so
  that common values crowd few parts and the others stay selective.
- How many candidates a threshold brings is estimated from histograms over all distinct
  fingerprints, of groups of at most 8 bits, whose distances are added up as if independent.
- Every fingerprint gets thresholds of its own by dynamic programming over the parts: those
  with the least estimated cost of probes and candidates. m is the number of parts with the
  least cost over all of them.

Probes meet the fingerprints of equal part values in one shuffle, are compared bit by bit, and
return a spanning forest of links. A value that many share is dealt into cells of two slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.llm.common import BY_WHITESPACE, importable, in_tasks, over_texts, words_of
from meterstar.llm.components import components, forest
from meterstar.scratch import staged

BITS = 64
DISTANCE = 4
WORDS = 4
SEED = 42
MOST_PARTS = 5
REACH = 3  # largest threshold of a part: C(32, 3) probes of the widest one
GROUP_BITS = 8  # of one histogram
CANDIDATES_PER_PROBE = 32  # comparisons that cost as much as one shuffled probe
SLOT = 2048
PAIRS = 1 << 21  # compared at once
PROBES = 1 << 20  # made at once

INDEXED, PROBES_IT = 1, 2

U = np.uint64


def shingle_hashes(text: str | None, n: int = WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of the space-joined word n-grams, repeats included; of fewer words, of all."""
    digest, carry, some = xxhash.xxh64_intdigest, [], False
    for words in words_of(text, BY_WHITESPACE):
        words = carry + words
        if len(words) >= n:
            some = True
            grams = map(b" ".join, zip(*(words[i:] for i in range(n))))
            yield np.array([digest(g, seed) for g in grams], U)
        carry = words[max(len(words) - n + 1, 0) :]
    if carry and not some:
        yield np.array([digest(b" ".join(carry), seed)], U)


def bit_matrix(numbers: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per number, the lowest bit first."""
    octets = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little")


def numbers_of(bits: np.ndarray) -> np.ndarray:
    """The numbers whose lowest bits are the columns of `bits`; at most 64."""
    octets = np.zeros((len(bits), 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    octets[:, : packed.shape[1]] = packed
    return octets.view("<u8").ravel().astype(U)


def fingerprints(texts: list[str | None], n: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text; zero without words."""
    ones, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    waiting, owners = [], []

    def count() -> None:
        owner = np.repeat(owners, [len(h) for h in waiting])
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        bits = bit_matrix(np.concatenate(waiting))
        ones[owner[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        waiting.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text, n, seed):
            waiting.append(hashes)
            owners.append(i)
            total[i] += len(hashes)
            if sum(map(len, waiting)) > 1 << 16:
                count()
    if waiting:
        count()
    return numbers_of(2 * ones > total[:, None])


def _summed(df: DataFrame, function, size: int) -> np.ndarray:
    """The sum over all fingerprints of a vector of `size` that `function` gives for a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += function(batch.column(0).to_numpy().view(U))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)],
                                         names=["cell", "n"])

    rows = in_tasks(df, run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(size)
    for row in rows.collect():  # `size` rows
        out[row.cell] = row.n
    return out


def correlations(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and the size of the correlation of every two bits."""
    def together(numbers: np.ndarray) -> np.ndarray:
        bits = bit_matrix(numbers).astype(np.float64)
        return np.concatenate([[len(bits)], (bits.T @ bits).ravel()])

    total = _summed(prints, together, 1 + BITS * BITS)
    n, both = total[0], total[1:].reshape(BITS, BITS)
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    scale = np.outer(spread, spread)
    size = np.abs(both / max(n, 1) - np.outer(share, share))
    return int(n), np.divide(size, scale, out=np.zeros_like(size), where=scale > 1e-12)


def grouped(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """The bits dealt into parts of like width, those that go together into one part.

    A part starts with the free bit that goes best with the other free ones, and takes the bit
    that goes best with those it has; so neighbours in the list go together, too.
    """
    strength = correlation - np.diag(np.diag(correlation))
    free, out = list(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        part = [max(free, key=lambda b: (strength[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            part.append(max(free, key=lambda b: (strength[b, part].sum(), -b)))
            free.remove(part[-1])
        out.append(part)
    return out


class Plan:
    """Parts, and what the histograms of their groups of bits say about distances."""

    def __init__(self, parts: list[list[int]], distance: int):
        self.parts, self.distance = parts, distance
        self.groups = [[p[i : i + GROUP_BITS] for i in range(0, len(p), GROUP_BITS)] for p in parts]
        self.reach = min(REACH, distance)
        self.masks = [_masks(len(p), self.reach) for p in parts]
        self.tables: list[list[np.ndarray]] = []

    def histograms(self, bits: np.ndarray) -> np.ndarray:
        return np.concatenate([
            np.bincount(numbers_of(bits[:, g]).astype(np.int64), minlength=1 << GROUP_BITS)
            for part in self.groups for g in part
        ])

    def learn(self, histograms: np.ndarray) -> None:
        """Of each group: value to the share of fingerprints at distance 0, 1, ..."""
        rest = iter(histograms.reshape(-1, 1 << GROUP_BITS))
        values = np.arange(1 << GROUP_BITS)
        apart = np.bitwise_count(values[:, None] ^ values[None, :])
        for part in self.groups:
            own = []
            for _ in part:
                share = next(rest)
                share = share / max(share.sum(), 1)
                own.append(np.stack([(apart == e) @ share for e in range(self.reach + 1)], axis=1))
            self.tables.append(own)

    def costs(self, bits: np.ndarray, n: int) -> np.ndarray:
        """(part, fingerprint, threshold + 1): the estimated cost of a threshold."""
        out = np.zeros((len(self.parts), len(bits), self.reach + 2))
        for i, (groups, tables) in enumerate(zip(self.groups, self.tables)):
            at = np.zeros((len(bits), self.reach + 1))
            at[:, 0] = 1
            for group, table in zip(groups, tables):
                add = table[numbers_of(bits[:, group]).astype(np.int64)]
                at = np.stack([sum(at[:, j] * add[:, e - j] for j in range(e + 1))
                               for e in range(self.reach + 1)], axis=1)
            probes = np.array([len(m) for m in self.masks[i]])
            out[i, :, 1:] = probes + n * np.cumsum(at, axis=1) / CANDIDATES_PER_PROBE
        return out

    def thresholds(self, bits: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, part) thresholds of the least cost, and that cost.

        best[f, s] is the least cost of the parts so far if their thresholds + 1 sum up to s.
        """
        costs, need = self.costs(bits, n), self.distance + 1
        best = np.full((len(bits), need + 1), np.inf)
        best[:, 0] = 0
        chosen = []
        for cost in costs:
            options = np.full((self.reach + 2, len(bits), need + 1), np.inf)
            for t in range(min(self.reach + 2, need + 1)):
                options[t, :, t:] = best[:, : need + 1 - t] + cost[:, t, None]
            chosen.append(options.argmin(0))
            best = options.min(0)
        out, left, rows = np.empty((len(bits), len(costs)), np.int64), np.full(len(bits), need), np.arange(len(bits))
        for i in reversed(range(len(costs))):
            out[:, i] = chosen[i][rows, left]
            left = left - out[:, i]
        return out - 1, best[:, need]


def _masks(width: int, reach: int) -> list[np.ndarray]:
    """For each threshold 0, 1, ...: the numbers of `width` bits with at most so many ones."""
    out, so_far = [], []
    for ones in range(reach + 1):
        so_far += [sum(1 << b for b in c) for c in combinations(range(width), ones)]
        out.append(np.array(so_far, U))
    return out


def plan_of(prints: DataFrame, distance: int) -> tuple[Plan, int]:
    """The plan with the least estimated cost over all fingerprints, and their number."""
    n, correlation = correlations(prints)
    # One part would take C(64, 4) probes; part values of up to 32 bits fit a key.
    plans = [Plan(grouped(correlation, m), distance)
             for m in range(2, max(MOST_PARTS, distance // (REACH + 1) + 1) + 1)]
    plans = [p for p in plans if len(p.parts) * (p.reach + 1) >= distance + 1]

    def counts(numbers: np.ndarray) -> np.ndarray:
        bits = bit_matrix(numbers)
        return np.concatenate([p.histograms(bits) for p in plans])

    sizes = [(1 << GROUP_BITS) * sum(map(len, p.groups)) for p in plans]
    learnt = _summed(prints, counts, sum(sizes))
    for plan, histograms in zip(plans, np.split(learnt, np.cumsum(sizes)[:-1])):
        plan.learn(histograms)

    def costs(numbers: np.ndarray) -> np.ndarray:
        bits = bit_matrix(numbers)
        return np.array([p.thresholds(bits, n)[1].sum() for p in plans])

    return plans[int(_summed(prints, costs, len(plans)).argmin())], n


def signatures(plan: Plan, numbers: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, fingerprint, role) of the part values and the probes of some fingerprints."""
    bits = bit_matrix(numbers)
    thresholds, _ = plan.thresholds(bits, n)
    for i, part in enumerate(plan.parts):
        value = numbers_of(bits[:, part])
        tag = U(i << 40)
        role = np.where(thresholds[:, i] >= 0, INDEXED | PROBES_IT, INDEXED)
        yield value | tag, numbers, role
        for t in range(1, plan.reach + 1):
            masks = plan.masks[i][t][1:]
            who = np.flatnonzero(thresholds[:, i] == t)
            step = max(1, PROBES // max(len(masks), 1))
            for a in range(0, len(who), step):
                some = who[a : a + step]
                keys = (value[some][:, None] ^ masks[None, :]).ravel() | tag
                yield keys, np.repeat(numbers[some], len(masks)), np.full(len(keys), PROBES_IT)


def probed(prints: DataFrame, plan: Plan, n: int) -> DataFrame:
    """(key, print, role): a part value, who has it or asks for it, and which of the two."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy().view(U)
            for key, owner, role in signatures(plan, numbers, n) if len(numbers) else ():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(owner.view(np.int64)),
                     pa.array(role.astype(np.int8))], names=["key", "print", "role"],
                )

    return in_tasks(prints, run, "key bigint, print bigint, role tinyint")


def in_cells(rows: DataFrame) -> DataFrame:
    """(cell, print, role): the rows of a key, or of two slots of a key with many rows."""
    indexes, probes = (F.col("role").bitwiseAND(F.lit(r)) > 0 for r in (INDEXED, PROBES_IT))
    sizes = staged(
        rows.groupBy("key").agg(F.count_if(indexes).alias("i"), F.count_if(probes).alias("j"))
        .filter(f"least(i, j) > 0 and greatest(i, j) > {SLOT}")
        .select("key", *(F.ceil(F.col(c) / SLOT).cast("int").alias(c) for c in "ij")),
        "crowded",
    )
    plain = F.col("key").alias("cell"), "print", "role"
    if sizes.isEmpty():
        return rows.select(*plain)
    crowded = rows.join(sizes, "key")

    def dealt(role: int, own: str, other: str) -> DataFrame:
        slot = F.pmod(F.xxhash64("print"), F.col(own)).cast("int")
        others = crowded.filter(F.col("role").bitwiseAND(F.lit(role)) > 0).select(
            "key", "print", slot.alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        )
        return others.select(F.xxhash64("key", "i", "j").alias("cell"), "print",
                             F.lit(role).cast("tinyint").alias("role"))

    return (
        rows.join(sizes, "key", "left_anti").select(*plain)
        .unionAll(dealt(INDEXED, "i", "j")).unionAll(dealt(PROBES_IT, "j", "i"))
    )


def linked(cell: np.ndarray, numbers: np.ndarray, role: np.ndarray, distance: int) -> np.ndarray:
    """A spanning forest, as rows (a, b), of the links within cells; rows are sorted by cell."""
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(cell))))
    has, asks = (role & INDEXED) > 0, (role & PROBES_IT) > 0
    own, starts = numbers[has], np.searchsorted(group[has], np.arange(len(first) + 1))
    many = np.diff(starts)[group[asks]]
    asking, at = numbers[asks][many > 0], starts[:-1][group[asks]][many > 0]
    many = many[many > 0]
    upto = np.cumsum(many)
    found, begin = [], 0
    while begin < len(many):
        done = upto[begin - 1] if begin else 0
        end = max(int(np.searchsorted(upto, done + PAIRS, "right")), begin + 1)
        some = many[begin:end]
        left = np.repeat(asking[begin:end], some)
        place = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        right = own[np.repeat(at[begin:end], some) + place]
        near = (left != right) & (np.bitwise_count(left ^ right) <= distance)
        if near.any():
            found.append(spanning(np.stack([left[near], right[near]], axis=1)))
        begin = end
    return spanning(np.concatenate(found)) if found else np.empty((0, 2), U)


def spanning(pairs: np.ndarray) -> np.ndarray:
    """(a, b): each number of the pairs but the least of its component, with that least one."""
    numbers, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(-1, 2)
    label = forest(len(numbers), at[:, 0], at[:, 1])
    other = label != np.arange(len(numbers))
    return np.stack([numbers[other], numbers[label[other]]], axis=1)


def links(cells: DataFrame, distance: int) -> DataFrame:
    """(a, b): edges between distinct fingerprints with the components of all their links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the rows of the last cell, which the next batch may continue
        for batch in (*batches, None):
            if batch is not None and not batch.num_rows:
                continue
            if batch is None:
                rows, kept = kept, None
            else:
                rows = [c.to_numpy() for c in batch.columns]
                if kept is not None:
                    rows = [np.concatenate(both) for both in zip(kept, rows)]
                end = np.searchsorted(rows[0], rows[0][-1])
                kept = [r[end:] for r in rows]
                rows = [r[:end] for r in rows]
            if rows is not None and len(rows[0]):
                a, b = linked(rows[0], rows[1].view(U), rows[2], distance).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
                )

    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return in_tasks(dealt, run, "a bigint, b bigint")


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                          n: int = WORDS, seed: int = SEED) -> DataFrame:
    """id and print (64 bits as a long) of every row; columns other than these two go."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def make():
        def describe(batch: pa.RecordBatch) -> dict:
            found = fingerprints(batch.column(1).to_pylist(), n, seed)
            return {"id": batch.column(0), "print": pa.array(found.view(np.int64))}

        return describe

    kind = rows.schema["id"].dataType.simpleString()
    return over_texts(rows, "text", f"id {kind}, print bigint", make)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    distance: int = DISTANCE, n: int = WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of `docs`: id, fingerprint (16 hex digits) and component_id, the smallest
    id reachable by fingerprints that differ in at most `distance` bits (0 to 16), its own included.

    Null and empty texts, and texts of white space only, have the fingerprint zero, which links
    like any other. Rows of equal text are copies, whatever their ids. A null id is passed over
    for component_id, which is null if no row of the component has an id. Other columns are not
    looked at. An empty table gives no rows. Long texts are read in pieces.
    """
    if not 0 <= distance <= 16:
        raise ValueError("distance must be 0 to 16 bits")
    importable(docs.sparkSession)
    table = staged(fingerprint_documents(docs, id_column, text_column, n, seed), "fingerprints")
    prints = staged(table.groupBy("print").agg(F.min("id").alias("least")), "prints")
    least = prints.withColumnRenamed("least", "component_id")
    if distance and not prints.isEmpty():
        plan, count = plan_of(prints.select("print"), distance)
        rows = staged(probed(prints.select("print"), plan, count), "probes")
        joined = components(links(in_cells(rows), distance)).withColumnRenamed("node", "print")
        rooted = staged(prints.join(joined, "print"), "rooted")
        by_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        moved = rooted.join(by_root, "root").select("print", F.col("component_id").alias("moved"), F.lit(True).alias("in"))
        least = prints.join(moved, "print", "left").select(
            "print", F.when(F.col("in"), F.col("moved")).otherwise(F.col("least")).alias("component_id")
        )
    return table.join(least, "print").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint"),
        "component_id",
    )
