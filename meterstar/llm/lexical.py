"""Ranked lexical search by a dual tree over items and documents.

The documents become sparse rows over the items' terms, each with its integer impact. Rows that
share their weightiest term are brought together by a range shuffle, so that the documents of a
node have much in common. A task reads its rows in batches and builds a hierarchy over each:
leaves of neighbouring documents, their parents, and so on; a node holds, per term, the largest
impact below it. The items have such a hierarchy, too, of their largest weights.

The product of an item node's and a document node's vectors bounds every score between them.
A pair of nodes is dropped if that bound is below the weakest kth score that the node's items
have so far, and split otherwise, a level of both hierarchies at a time, from the roots; the
pairs of leaves that are left are scored in full. An item's leaf is that item, a document's one
of a few neighbours. Scores and bounds are whole numbers, exact in floating point, so nothing
that belongs to a result is dropped.

Two rounds: in the first, an item visits only the documents' leaves that promise most, and the
kth best scores found in all tasks are where the second, complete, round starts from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import BY_SYMBOLS, importable, in_tasks, slices, words_of
from meterstar.scratch import staged

K = 20
BLOCK_ITEMS = 256
BLOCK_TERMS = 1 << 14
DOCUMENT_LEAF = 4
FANOUT = 4
BATCH = 2048
DENSE = 1 << 23  # entries of the vectors of one level of a hierarchy
SEED_LEAVES = 4  # that an item visits per batch in the first round

NONE = -1  # below every score


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def hierarchy(leaves: np.ndarray, fanout: int) -> list[np.ndarray]:
    """The vectors of the nodes by level, from the leaves up to one root.

    The nodes of a level are the maxima of `fanout` neighbours of the level below.
    """
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append(np.maximum.reduceat(below, np.arange(0, len(below), fanout), axis=0))
    return levels


class Items:
    """A block of items: their terms, and once the weights are known, their hierarchy."""

    def __init__(self, rows: list[tuple[object, dict[bytes, int]]], fanout: int = FANOUT,
                 leaf: int = DOCUMENT_LEAF, batch: int = BATCH):
        self.rows, self.fanout, self.leaf, self.batch = rows, fanout, leaf, batch
        terms = sorted({t for _, counts in rows for t in counts})
        self.terms = {t: i for i, t in enumerate(terms)}

    def weigh(self, weights: np.ndarray) -> None:
        """Weights per term; items get the order in which like ones are neighbours."""
        dense = np.zeros((len(self.rows), len(self.terms)))
        for i, (_, counts) in enumerate(self.rows):
            for term, count in counts.items():
                at = self.terms[term]
                dense[i, at] = count * weights[at]
        self.order = _neighbours(dense, self.fanout)
        self.levels = hierarchy(dense[self.order], self.fanout)


def _neighbours(dense: np.ndarray, fanout: int) -> np.ndarray:
    """Rows in an order of halves: each half is what is more like its own than the other pole."""
    out, waiting = [], [np.arange(len(dense))]
    norm = np.sqrt((dense**2).sum(1)) + 1e-9
    while waiting:
        rows = waiting.pop()
        if len(rows) <= fanout:
            out.append(rows)
            continue
        unit = dense[rows] / norm[rows, None]
        one = int((unit @ unit[0]).argmin())
        other = int((unit @ unit[one]).argmin())
        side = np.argsort(unit @ unit[other] - unit @ unit[one], kind="stable")
        half = -(-len(rows) // (2 * fanout)) * fanout
        waiting += [rows[side[half:]], rows[side[:half]]]
    return np.concatenate(out)


class Search:
    """The best k documents of each item in one task, from batches of sparse rows."""

    def __init__(self, items: Items, k: int, floors: np.ndarray):
        """`floors`: per item, in the hierarchy's order, a score that its kth best has at least."""
        self.items, self.k, self.floors = items, k, floors.copy()
        self.best: list[list[tuple]] = [[] for _ in floors]  # (-score, no id, id)
        self.compared = 0

    def add(self, ids: list, offsets: np.ndarray, terms: np.ndarray, impacts: np.ndarray, seed: bool) -> None:
        """Documents `ids`, whose terms and impacts stand between their offsets."""
        width, leaf = self.items.levels[0].shape[1], self.items.leaf
        rows = max(leaf, min(self.items.batch, DENSE // max(width, 1)) // leaf * leaf)
        for a in range(0, len(ids), rows):
            at = offsets[a : a + rows + 1]
            span = slice(at[0], at[-1])
            self._batch(ids[a : a + rows], at - at[0], terms[span], impacts[span], seed)

    def _batch(self, ids, offsets, terms, impacts, seed) -> None:
        used, terms = np.unique(terms, return_inverse=True)
        if not len(used):
            return
        items, size = [level[:, used] for level in self.items.levels], self.items.leaf
        owner = np.repeat(np.arange(len(ids)), np.diff(offsets))
        leaves = np.zeros((-(-len(ids) // size), len(used)))
        np.maximum.at(leaves, (owner // size, terms), impacts)
        if seed:
            promise = items[0] @ leaves.T
            best = np.argsort(-promise, axis=1, kind="stable")[:, :SEED_LEAVES]
            active = np.zeros(promise.shape, bool)
            active[np.arange(len(active))[:, None], best] = True
            active &= promise >= self._weakest(0)[:, None]
        else:
            active = self._descend(items, hierarchy(leaves, self.items.fanout))
        found = []
        for leaf in np.flatnonzero(active.any(0)):
            first = leaf * size
            span = slice(offsets[first], offsets[min(first + size, len(ids))])
            own, at = np.unique(terms[span], return_inverse=True)
            dense = np.zeros((min(size, len(ids) - first), len(own)))
            dense[owner[span] - first, at] = impacts[span]
            who = np.flatnonzero(active[:, leaf])
            scores = items[0][np.ix_(who, own)] @ dense.T
            self.compared += scores.size
            row, doc = np.nonzero(scores >= self._weakest(0)[who, None])
            found += zip(who[row].tolist(), (doc + first).tolist(), scores[row, doc].astype(np.int64).tolist())
        self._take(found, ids)

    def _weakest(self, level: int) -> np.ndarray:
        """Per node of a level of the items, the least score that one of them still takes."""
        low = np.maximum(self.floors, 1)
        for _ in range(level):
            low = np.minimum.reduceat(low, np.arange(0, len(low), self.items.fanout))
        return low

    def _descend(self, items: list[np.ndarray], documents: list[np.ndarray]) -> np.ndarray:
        """(item, document leaf): the pairs that no bound on the way from the roots rules out."""
        i, d = len(items) - 1, len(documents) - 1
        active = np.ones((1, 1), bool)
        while True:
            rows, columns = np.flatnonzero(active.any(1)), np.flatnonzero(active.any(0))
            bounds = items[i][rows] @ documents[d][columns].T
            active[np.ix_(rows, columns)] &= bounds >= self._weakest(i)[rows, None]
            if i == d == 0 or not active.any():
                return active if i == d == 0 else np.zeros((len(items[0]), len(documents[0])), bool)
            if i:
                i -= 1
                active = active.repeat(self.items.fanout, axis=0)[: len(items[i])]
            if d:
                d -= 1
                active = active.repeat(self.items.fanout, axis=1)[:, : len(documents[d])]

    def _take(self, found: list[tuple[int, int, int]], ids: list) -> None:
        """(item, place in `ids`, score) of pairs that may belong to the best."""
        for i, at, score in found:
            name = ids[at]
            self.best[i].append((-score, name is None, 0 if name is None else name))
        for i in {i for i, _, _ in found}:
            self.best[i] = sorted(self.best[i])[: self.k]
            if len(self.best[i]) == self.k:
                self.floors[i] = max(self.floors[i], -self.best[i][-1][0])

    def found(self, id_type: pa.DataType) -> pa.RecordBatch:
        """(item: its place in the block, doc, score)."""
        rows = [(place, None if none else name, -score)
                for place, best in zip(self.items.order.tolist(), self.best) for score, none, name in best]
        kinds = pa.int32(), id_type, pa.int64()
        columns = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                          names=["item", "doc", "score"])


def sparse_documents(docs: DataFrame, items: Items) -> DataFrame:
    """doc, n (its terms with repeats), terms and counts of the block's terms in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, width = items.terms.get, max(len(items.terms), 1)
        for batch in slices(batches, "text"):
            sizes, keys = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                n = 0
                for words in words_of(text, BY_SYMBOLS):
                    n += len(words)
                    known = np.array([x for x in map(get, words) if x is not None], np.int64)
                    keys.append(known + row * width)
                sizes.append(n)
            found, counts = np.unique(np.concatenate([np.empty(0, np.int64), *keys]), return_counts=True)
            offsets = np.searchsorted(found, np.arange(len(sizes) + 1) * width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found % width, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))],
                names=["doc", "n", "terms", "counts"],
            )

    kind = docs.schema["doc"].dataType.simpleString()
    return in_tasks(docs.select("doc", "text"), run,
                    f"doc {kind}, n bigint, terms array<int>, counts array<bigint>")


def _search(rows: DataFrame, items: Items, k: int, floors: np.ndarray, seed: bool) -> DataFrame:
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, id_type = Search(items, k, floors), pa.null()
        for batch in batches:
            id_type = batch.column(0).type
            terms, impacts = batch.column(1), batch.column(2)
            search.add(batch.column(0).to_pylist(), terms.offsets.to_numpy() - terms.offsets[0].as_py(),
                       terms.flatten().to_numpy(), impacts.flatten().to_numpy().astype(np.float64), seed)
        if not pa.types.is_null(id_type):
            yield search.found(id_type)

    return in_tasks(rows, run, f"item int, doc {kind}, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(items: DataFrame, most: int = BLOCK_ITEMS, **shape: int) -> Iterator[Items]:
    """The items in blocks of a bounded number of items and of terms; one item at least."""
    rows, terms = [], set()
    for item in items.toLocalIterator():
        counts: dict[bytes, int] = {}
        for words in words_of(item.text, BY_SYMBOLS):
            for word in words:
                counts[word] = counts.get(word, 0) + 1
        if not counts:
            continue
        if rows and (len(rows) >= most or len(terms | counts.keys()) > BLOCK_TERMS):
            yield Items(rows, **shape)
            rows, terms = [], set()
        rows.append((item.item, counts))
        terms |= counts.keys()
    if rows:
        yield Items(rows, **shape)


def search_documents(items: DataFrame, docs: DataFrame, k: int = K, item_id: str = "item_id",
                     doc_id: str = "doc_id", text_column: str = "text", block_items: int = BLOCK_ITEMS, **shape: int) -> DataFrame:
    """The k documents of each item with the highest scores above 0: item_id, rank (from 1),
    doc_id, score; equal scores go by ascending doc_id, null ids last.

    Null and empty texts have no terms: such documents count nowhere and are in no result, such
    items have no rows. Repeated document rows are documents each; rows of one item id are one
    item, with the text that sorts first. Null item ids are an id like any other. Other columns
    are not looked at; an empty table on either side gives no rows. Very long texts are read in
    pieces. Items are searched in blocks of `block_items`, and each block reads the documents once.
    `shape` sets fanout, leaf and batch of the hierarchies.
    """
    spark = docs.sparkSession
    importable(spark)
    docs = docs.select(F.col(doc_id).alias("doc"), F.col(text_column).alias("text"))
    asked = items.select(F.col(item_id).alias("item"), F.col(text_column).alias("text"))
    asked = asked.groupBy("item").agg(F.min("text").alias("text"))
    doc_kind = docs.schema["doc"].dataType.simpleString()
    item_kind = asked.schema["item"].dataType.simpleString()
    results = []
    for block in _blocks(asked, block_items, **shape):
        sparse = staged(sparse_documents(docs, block), "sparse")
        n, total = sparse.agg(F.count_if(F.expr("n > 0")), F.sum("n")).first()
        if not n:
            break
        frequency = sparse.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(block.terms))
        for row in frequency:  # BLOCK_TERMS of them, or those of one item
            weights[row.term] = term_weight(n, row["count"])
        block.weigh(weights)
        rows = staged(_gathered(sparse, n, total, weights), "impacts")

        floors = np.full(len(block.rows), NONE, np.int64)
        place = np.empty(len(block.rows), np.int64)
        place[block.order] = np.arange(len(block.rows))
        seeds = _best(_search(rows, block, k, floors, True), k).filter(F.col("rank") == k)
        for row in seeds.select("item", "score").collect():  # one per item of the block
            floors[place[row.item]] = row.score
        best = _best(_search(rows, block, k, floors, False), k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block.rows)],
                                      f"item int, name {item_kind}")
        results.append(best.join(F.broadcast(names), "item").select(  # as many rows as a block has items
            F.col("name").alias(item_id), "rank", F.col("doc").alias(doc_id), "score"))
    if not results:
        return spark.createDataFrame(
            [], f"`{item_id}` {item_kind}, rank int, `{doc_id}` {doc_kind}, score bigint")
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out


def _gathered(sparse: DataFrame, n: int, total: int, weights: np.ndarray) -> DataFrame:
    """doc, terms, impacts: documents whose weightiest terms are alike in one place."""
    impact = "transform(counts, tf -> (1000000000L * tf) div (1000L * tf + 12L * m))"
    rows = sparse.filter("size(terms) > 0").withColumn("m", F.expr(f"75 + (25L * n * {n}L) div {total}L"))
    rows = rows.select("doc", "terms", F.expr(impact).alias("impacts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            terms = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            score = weights[terms] * batch.column(2).flatten().to_numpy()
            order = np.lexsort((terms, -score, owner))
            first = terms[order][offsets[:-1]]
            second = terms[order][np.minimum(offsets[:-1] + 1, offsets[1:] - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())],
                names=["doc", "terms", "impacts", "first", "second"],
            )

    kind = rows.schema["doc"].dataType.simpleString()
    rows = in_tasks(rows, run, f"doc {kind}, terms array<int>, impacts array<bigint>, first int, second int")
    # Ids deal out the documents of one pair of terms, however many there are.
    spread_out = F.xxhash64("doc")
    return (
        rows.repartitionByRange("first", "second", spread_out)
        .sortWithinPartitions("first", "second", spread_out).select("doc", "terms", "impacts")
    )
