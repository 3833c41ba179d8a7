"""N-gram Jaccard join by blocked sparse matrix products.

Documents with equal n-gram sets are one class and are joined without comparison. Classes
are then blocked. Two sets of at least 90 % Jaccard similarity differ in at most
k = |smaller| / 9 elements (for 90 %). The n-gram universe is cut by hash into m > k parts;
at most k parts can differ. In one order of all contents of parts, the first one that both
sets have is therefore among the first k + 1 of either. The order takes contents that the
fewest classes have first, so that the parts of a passage that many texts share come last:
they count only for texts that are little else. Classes that share such a part are candidates,
and so are, transitively, all classes of one connected component of candidates: no link
leaves it.

Within a component, classes are dealt by set size and by hash into slots of bounded size.
A cell is a pair of slots whose sizes can link; its task multiplies the two incidence
matrices (document by n-gram), a block of n-grams at a time, adds up overlap counts, and
after each block drops the documents whose every pair has fallen below the bound that its
sizes set. A cell returns a spanning forest of its links and link counts, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import free_name, importable, in_tasks, over_texts
from meterstar.llm.components import components, forest
from meterstar.scratch import staged

N = 3
PERCENT = 90
PART_RATIO = 1.4  # parts per part that is used
FREQUENT = 64  # classes; contents of parts that more have are one step of the order
GROUP_RATIO = 1.2  # sizes of one group of sets
SLOT_DOCUMENTS, SLOT_GRAMS = 512, 300_000
COLUMN_BLOCK = 4096
CACHED_WORDS = 100_000
BROADCAST_ROWS = 200_000  # ids of representatives, about 40 bytes each

U = np.uint64
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                   U)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def gram_set(text: str | None, hashes: WordHashes, n: int = N) -> np.ndarray:
    """The sorted distinct hashes of a text's word n-grams; of fewer words, of all of them."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, U)
    h = np.array([hashes[w] for w in words], U)
    size = min(n, len(h))
    grams = np.full(len(h) - size + 1, size, U)
    for i in range(size):
        grams += mixed(h[i : i + len(grams)] * FACTORS[i % len(FACTORS)] + U(i))
    return np.unique(mixed(grams))


def differences(size: int, percent: int) -> int:
    """How many elements two linked sets can differ in, `size` being the smaller's."""
    return size * (100 - percent) // percent


def size_groups(percent: int, largest: int = 2**31) -> np.ndarray:
    """The first sizes of the groups; below them all, linked sets are equal."""
    first = -(-percent // (100 - percent))
    starts = [first]
    while starts[-1] < largest:
        starts.append(max(starts[-1] + 1, int(starts[-1] * GROUP_RATIO)))
    return np.array(starts, np.int64)


def signatures(grams: np.ndarray, groups: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the parts of a set, for each group it can link in; and to each, by group,
    how many that come last in the order of contents are not needed.

    Empty parts are last in that order, and so the first not to be needed; they are left out.
    """
    size = len(grams)
    least = -(-size * percent // 100)
    low = max(int(np.searchsorted(groups, least, "right")) - 1, 0)
    high = int(np.searchsorted(groups, size, "right")) - 1
    marks, places = [np.empty(0, U)], [np.empty(0, np.int32)]
    for g in range(low, high + 1):
        used = differences(int(groups[g + 1]) - 1, percent) + 1
        parts = math.ceil(PART_RATIO * used)
        # Hashes are sorted, so the parts are runs of the array.
        part = ((grams >> U(32)) * U(parts)) >> U(32)
        ends = np.searchsorted(part, np.arange(parts + 1, dtype=U))
        sizes = np.diff(ends)
        total = np.concatenate([np.zeros(1, U), np.cumsum(mixed(grams ^ U(0x5851F42D4C957F2D)))])
        sums = total[ends[1:]] - total[ends[:-1]]
        place = np.arange(parts, dtype=U) + U(g << 32)
        mark = mixed(sums + mixed(place * FACTORS[0] + sizes.astype(U)))
        empty = np.sort(mark[sizes == 0])
        spare = parts - used
        own = np.concatenate([mark[sizes > 0], empty[: max(len(empty) - spare, 0)]])
        marks.append(own)
        places.append(np.full(len(own), (g << 24) + max(spare - len(empty), 0), np.int32))
    return np.concatenate(marks), np.concatenate(places)


def described(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """id, mark, size, class (128-bit hash of the set, null if empty), key (64 bits of it).

    `docs` has id, text and mark, a hash of the text that the engine can make as well.
    """
    def make():
        hashes = WordHashes()

        def describe(batch: pa.RecordBatch) -> dict:
            sets = [gram_set(text, hashes, n) for text in batch.column(1).to_pylist()]
            classes = [class_of(s) for s in sets]
            return {
                "id": batch.column(0), "mark": batch.column(2),
                "size": pa.array(map(len, sets), pa.int64()),
                "class": pa.array(classes, pa.binary()),
                "key": pa.array([c and key_of(c) for c in classes], pa.int64()),
            }

        return describe

    kind = docs.schema["id"].dataType.simpleString()
    return over_texts(
        docs, "text", f"id {kind}, mark bigint, size bigint, class binary, key bigint", make
    )


def class_of(grams: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None


def key_of(name: bytes) -> int:
    return int.from_bytes(name[:8], "big", signed=True)


def marked(docs: DataFrame, percent: int, n: int) -> DataFrame:
    """(mark, key, place) of every part of a class; of classes that a task meets again, once.

    `place` has the group of sizes and the number of parts not needed in it.
    """
    def make():
        hashes, groups, seen = WordHashes(), size_groups(percent), set()

        def mark(batch: pa.RecordBatch) -> dict:
            keys, marks, places = [], [], []
            for text in batch.column(1).to_pylist():
                grams = gram_set(text, hashes, n)
                name = class_of(grams)
                if name is None or name in seen:
                    continue
                if len(seen) >= CACHED_WORDS:
                    seen.clear()
                seen.add(name)
                own, place = signatures(grams, groups, percent)
                marks.append(own.view(np.int64))
                places.append(place)
                keys.append(np.full(len(own), key_of(name), np.int64))
            if not marks:
                return {}
            return {"mark": np.concatenate(marks), "key": np.concatenate(keys), "place": np.concatenate(places)}

        return mark

    return over_texts(docs, "text", "mark bigint, key bigint, place int", make)


def shared_marks(marks: DataFrame) -> DataFrame:
    """(mark, key, place, classes) of the marks that two classes have at least; `classes` is
    how many have it, FREQUENT at most.

    One shuffle of the marks, sorted within partitions; equal marks then stand in a row. Of a
    row, no more than a batch and FREQUENT keys is held, however many classes share the mark.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, flooded, last = None, None, None  # the latest mark's rows; it, once it is frequent; its latest key

        def rows_of(columns, classes) -> pa.RecordBatch:
            names = ["mark", "key", "place", "classes"]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(classes.astype(np.int32))], names=names)

        for batch in _then_none(batches):
            if batch is None:
                if kept is None or not len(kept[0]):
                    return
                columns, end = kept, len(kept[0])
            else:
                if not batch.num_rows:
                    continue
                columns = [c.to_numpy() for c in batch.columns]
                new = np.ones(len(columns[0]), bool)
                new[1:] = (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)
                new[0] = last != (columns[0][0], columns[1][0])
                last = columns[0][-1], columns[1][-1]
                columns = [c[new] for c in columns]
                if kept is not None:
                    columns = [np.concatenate(both) for both in zip(kept, columns)]
                if not len(columns[0]):
                    continue
                end = int(np.searchsorted(columns[0], columns[0][-1]))
            mark = columns[0][:end]
            first = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]])) if end else np.empty(0, int)
            counts = np.diff(np.append(first, end))
            counts[mark[first] == flooded] = FREQUENT
            classes = np.minimum(np.repeat(counts, np.diff(np.append(first, end))), FREQUENT)
            some = classes > 1
            if some.any():
                yield rows_of([c[:end][some] for c in columns], classes[some])
            kept = [c[end:] for c in columns]
            if len(kept[0]) and (len(kept[0]) >= FREQUENT or kept[0][0] == flooded):
                flooded = kept[0][0]
                yield rows_of(kept, np.full(len(kept[0]), FREQUENT))
                kept = [c[:0] for c in kept]

    dealt = marks.repartition("mark").sortWithinPartitions("mark", "key")
    return in_tasks(dealt, run, "mark bigint, key bigint, place int, classes int")


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def needed_marks(shared: DataFrame) -> DataFrame:
    """(mark, key) of the marks among those of a class and group that come first in the order.

    Marks of one class alone come first of all, so what is not needed lies among the shared.
    """
    own = Window.partitionBy("key", "place")
    ranked = shared.select(
        "mark", "key",
        F.row_number().over(own.orderBy("classes", "mark")).alias("rank"),
        F.count(F.lit(1)).over(own).alias("all"),
        F.col("place").bitwiseAND(F.lit((1 << 24) - 1)).alias("spare"),
    )
    return ranked.filter("rank <= all - spare").select("mark", "key")


def candidate_edges(marks: DataFrame) -> DataFrame:
    """An edge from each class to the smallest class it shares a mark with.

    One shuffle of the marks, sorted within partitions; equal marks then stand in a row, and
    of a row only its first key is held, however many classes share the mark.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, low = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            mark, key = (c.to_numpy() for c in batch.columns)
            new = np.concatenate([[mark[0] != last], mark[1:] != mark[:-1]])
            if not new[0]:
                key_low = np.concatenate([[low], key])
                first = np.where(new, np.arange(1, len(key) + 1), 0)
                lows = key_low[np.maximum.accumulate(first)]
            else:
                lows = key[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            last, low = mark[-1], lows[-1]
            differ = key != lows
            a, b = key[differ], lows[differ]
            pairs = np.unique(np.stack([a, b], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
            )

    dealt = marks.repartition("mark").sortWithinPartitions("mark", "key")
    return in_tasks(dealt, run, "a bigint, b bigint")


def _shared(marks: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The incidences whose n-gram is in two documents at least, n-grams numbered from 0."""
    grams, column, count = np.unique(marks, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    _, column = np.unique(column[keep], return_inverse=True)
    return owner[keep], column, int(column.max(initial=-1)) + 1


def linked_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                 percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i of left, j of right) of `sets` that link; i < j where both are in both."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner, column, columns = _shared(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rows, cols = left, right
    need = percent * (sizes[rows][:, None] + sizes[cols][None, :])
    # 100 I >= p (a + b - I) is (100 + p) I >= p (a + b).
    counts = np.zeros((len(rows), len(cols)), np.float32)
    rest = np.bincount(owner, minlength=len(sets))
    for start in range(0, columns, COLUMN_BLOCK):
        possible = counts + np.minimum(rest[rows][:, None], rest[cols][None, :])
        alive = (100 + percent) * possible >= need
        keep_rows, keep_cols = alive.any(1), alive.any(0)
        if not keep_rows.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if not (keep_rows.all() and keep_cols.all()):
            rows, cols = rows[keep_rows], cols[keep_cols]
            counts, need = (x[np.ix_(keep_rows, keep_cols)] for x in (counts, need))
        a, b = np.searchsorted(column, (start, start + COLUMN_BLOCK))
        block = np.zeros((len(sets), min(COLUMN_BLOCK, columns - start)), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        counts += block[rows] @ block[cols].T
        rest = rest - np.bincount(owner[a:b], minlength=len(sets))
    link = (100 + percent) * counts.astype(np.int64) >= need
    i, j = np.nonzero(link)
    i, j = rows[i], cols[j]
    both = np.isin(i, right) & np.isin(j, left)
    keep = np.where(both, i < j, i != j)
    return i[keep], j[keep]


def _cell(table: pa.Table, percent: int) -> pa.Table:
    # Rows that repeat in several tasks give a class more than once.
    first = {name: i for i, name in reversed([*enumerate(table.column("class").to_pylist())])}
    names, table = list(first), table.take(list(first.values()))
    sets = [np.frombuffer(s, U) for s in table.column("grams").to_pylist()]
    left, right = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("left", "right"))
    i, j = linked_pairs(sets, left, right, percent)
    label, links = forest(len(sets), i, j), np.bincount(np.concatenate([i, j]), minlength=len(sets))
    found = np.flatnonzero(links)
    return pa.table({
        "a": pa.array([names[x] for x in found], pa.binary()),
        "b": pa.array([names[label[x]] for x in found], pa.binary()),
        "links": pa.array(links[found], pa.int64()),
    })


def _cells(members: DataFrame, percent: int) -> DataFrame:
    """(class, cell, left, right) for every cell that a member (class, size, root) is in."""
    # A little wider than the ratio of linked sizes: they lie in one band or in neighbours.
    step = math.log(100 / percent) * 1.001
    members = members.withColumn("band", F.floor(F.log(F.col("size").cast("double")) / step))
    slots = staged(
        members.groupBy("root", "band").agg(
            F.greatest(
                F.ceil(F.count(F.lit(1)) / SLOT_DOCUMENTS), F.ceil(F.sum("size") / SLOT_GRAMS)
            ).cast("int").alias("slots")
        ),
        "slots",
    )

    def at(shift: int, name: str) -> DataFrame:
        return slots.select("root", (F.col("band") + shift).alias("band"), F.col("slots").alias(name))

    placed = (
        members.join(slots, ["root", "band"])
        .join(at(-1, "above"), ["root", "band"], "left")
        .join(at(1, "below"), ["root", "band"], "left")
        .withColumn("slot", F.pmod(F.xxhash64("class"), F.col("slots")).cast("int"))
    )

    def others(count: str, cell) -> F.Column:
        # No cells where the neighbouring band has no members.
        n = F.coalesce(F.col(count), F.lit(0))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), cell)).otherwise(
            F.array().cast("array<struct<low: bigint, high: bigint, i: int, j: int, left: boolean, right: boolean>>")
        )

    band, slot = F.col("band"), F.col("slot")

    def cell(low, high, i, j, left, right):
        return F.struct(low.alias("low"), high.alias("high"), i.alias("i"), j.alias("j"),
                        left.alias("left"), right.alias("right"))

    all_cells = F.concat(
        others("slots", lambda o: cell(band, band, F.least(slot, o), F.greatest(slot, o),
                                       slot <= o, slot >= o)),
        others("above", lambda o: cell(band, band + 1, slot, o, F.lit(True), F.lit(False))),
        others("below", lambda o: cell(band - 1, band, o, slot, F.lit(False), F.lit(True))),
    )
    return placed.select("class", "root", F.explode(all_cells).alias("cell")).select(
        "class", "root", "cell.*"
    )


def join_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   percent: int = PERCENT, n: int = N) -> DataFrame:
    """One row per row of `docs`: id, n_shingles (its set's size), component_id (the smallest
    id reachable by links, its own included) and n_links (linked sets other than its own).

    Null and empty texts have the empty set and no links. Rows with equal sets are linked
    whatever their ids, so repeated rows are copies of each other; ids may be null and are
    then passed over for component_id (null if no row of the component has one). Columns
    other than id and text are not looked at. An empty table gives no rows. The texts are
    read three times: `docs` should be a table.
    """
    importable(docs.sparkSession)
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                       F.xxhash64(text_column).alias("mark"))
    table = staged(described(docs, percent, n), "sets")
    shared = staged(shared_marks(marked(docs, percent, n)), "shared")
    candidates = components(candidate_edges(needed_marks(shared)))
    candidates = candidates.withColumnRenamed("node", "key")

    classes = staged(
        table.filter("class is not null").groupBy("class").agg(
            F.min("id").alias("least"), F.min("size").alias("size"), F.min("key").alias("key"),
            F.min(F.struct("mark", "id")).alias("example"),
        ),
        "classes",
    )
    members = staged(classes.join(candidates, "key").drop("key"), "members")

    # The sets of the members, made again from the text of one document of each class. Its id
    # alone would not do: ids may repeat, or be null, with many texts.
    wanted = members.select(
        F.col("example.mark").alias("_mark"), F.col("example.id").alias("_id"),
        F.col("class").alias("_class"),
    )
    if members.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    same = (F.col("mark") == F.col("_mark")) & F.col("id").eqNullSafe(F.col("_id"))
    texts = docs.join(wanted, same).select("_class", "text")

    def make():
        hashes, seen = WordHashes(), set()

        def again(batch: pa.RecordBatch) -> dict:
            names, sets = [], []
            for name, text in zip(*(c.to_pylist() for c in batch.columns)):
                if name in seen:  # a repeated row
                    continue
                if len(seen) >= CACHED_WORDS:
                    seen.clear()
                seen.add(name)
                grams = gram_set(text, hashes, n)
                if class_of(grams) == name:
                    names.append(name)
                    sets.append(grams.tobytes())
            return {"class": pa.array(names, pa.binary()), "grams": pa.array(sets, pa.binary())}

        return again

    grams = over_texts(texts, "text", "class binary, grams binary", make)
    grams = grams.join(_cells(members, percent), "class")
    links = staged(
        grams.groupBy("root", "low", "high", "i", "j").applyInArrow(
            lambda t: _cell(t, percent), "a binary, b binary, links bigint"
        ),
        "links",
    )
    joined = components(links).select(F.col("node").alias("class"), "root")
    counted = links.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("n_links"))
    rooted = classes.join(joined, "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").join(counted, "class", "left").select(
        "class", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return table.select("id", "size", "class").join(labels, "class", "left").select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def distinct_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       percent: int = 80, n: int = 5) -> DataFrame:
    """One row of `docs` per component: the one with the smallest id, nulls last; in its columns.

    Texts without words are linked with nothing and all stay. Of rows alike in id and text,
    one stays.
    """
    mark = F.unhex(F.md5(F.col(text_column)))
    named = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"),
                     mark.alias("mark"))
    plain = docs.select(named.alias("id"), F.col(text_column).alias("text"))
    joined = staged(join_documents(plain, "id", "text", percent, n).select("id", "component_id"),
                    "joined")
    # The rows that go are fewer than those that stay, and only their names are needed.
    name, other = free_name(docs, "_name"), free_name(docs, "_other")
    gone = joined.filter("id <> component_id").select(F.col("id").alias(other)).distinct()
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    kept = docs.join(gone, named.eqNullSafe(F.col(other)), "left_anti")
    again = joined.groupBy(F.col("id").alias(other)).count().filter("count > 1").select(other)
    again = staged(again, "repeated")
    if again.isEmpty():
        return kept
    twice = named.eqNullSafe(F.col(other))
    # Of rows alike in id and text, the one whose other columns sort first.
    rank = free_name(docs, "_rank")
    rest = [F.col(c) for c in docs.columns if c not in (id_column, text_column)]
    first = Window.partitionBy(name).orderBy(*rest) if rest else Window.partitionBy(name).orderBy(name)
    once = kept.join(again, twice, "left_semi").withColumn(name, named)
    once = once.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(name, rank)
    return kept.join(again, twice, "left_anti").unionByName(once)
