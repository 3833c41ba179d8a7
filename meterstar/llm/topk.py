"""Exact top-k search by distributed histogram selection.

Queries and candidates are cut into chunks; a task scores one query chunk against one
candidate chunk. Each round counts, per query, the scores in the bins of an interval that
holds the kth value, and sums the counts over all chunks; the bin with the kth value is the
next interval, until it is one score wide. Then the kth value of every query is known
exactly, every pair above it is in the result, and pairs equal to it fill up by id.

A chunk's own kth value bounds the global one from below, so a chunk reports only bins
from its own kth value upwards: at most k of them, however many candidates there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import importable
from meterstar.scratch import staged

K = 20
SCALE = 64
QUERY_CHUNK = 512
CANDIDATE_CHUNK = 8192
BINS = 256  # per interval and round
EXACT = 2**53  # sums of products below this are exact in floating point


def as_integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as long; null if a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(vector.isNotNull() & ~bad, scaled)


def vectors(df: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(id, v) of the rows that take part."""
    return df.select(
        F.col(id_column).cast("long").alias("id"),
        as_integers(F.col(vector_column), scale).alias("v"),
    ).filter("id is not null and v is not null")


def _cells(queries: DataFrame, candidates: DataFrame, chunks: tuple[int, int]):
    """Both sides keyed by (query chunk, candidate chunk)."""
    def chunk(n: int, by: str) -> Column:
        return F.pmod(F.xxhash64(by), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q, c = chunks
    left = queries.withColumn("q", chunk(q, "id")).withColumn("c", all_of(c))
    # By row: an id may repeat any number of times.
    right = candidates.withColumn("c", chunk(c, "row")).withColumn("q", all_of(q))
    return left.groupBy("q", "c").cogroup(right.groupBy("q", "c"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of vectors; shorter ones are padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = flat
    return out


def _scores(queries: pa.Table, candidates: pa.Table, rows: int = 128) -> Iterator[tuple]:
    """(first query, scores, own) of strips of queries; `own` marks a query's own id."""
    both = [t.column("v").combine_chunks() for t in (queries, candidates)]
    width = max(int(pc.max(pc.list_value_length(v)).as_py() or 0) for v in both)
    q, c = (_matrix(v, width) for v in both)
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * width
    if top < EXACT:
        q, c = q.astype(np.float64), c.astype(np.float64)
    q_ids, c_ids = (t.column("id").to_numpy() for t in (queries, candidates))
    for a in range(0, len(q), rows):
        scores = (q[a : a + rows] @ c.T).astype(np.int64)
        yield a, scores, q_ids[a : a + rows, None] == c_ids[None, :]


LEAST = np.iinfo(np.int64).min


def _count(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """Counts per query and bin of the query's interval, from the chunk's own kth value up."""
    ids, bins, counts, tops = [], [], [], []
    low, width = (queries.column(n).to_numpy() for n in ("low", "width"))
    names = queries.column("id").to_numpy()
    for a, scores, own in _scores(queries, candidates):
        scores[own] = LEAST
        n = len(scores)
        some = min(k, scores.shape[1])
        best = np.partition(scores, scores.shape[1] - some, axis=1)[:, -some:]
        # What lies above the interval was counted in an earlier round.
        at = (best - low[a : a + n, None]) // width[a : a + n, None]
        inside = (best > LEAST) & (at >= 0) & (at < BINS)
        key = np.repeat(np.arange(n), some)[inside.ravel()] * BINS + at[inside]
        found, count = np.unique(key, return_counts=True)
        ids.append(names[a + found // BINS])
        bins.append(found % BINS)
        counts.append(count)
    return pa.table({
        "id": np.concatenate([np.empty(0, np.int64), *ids]),
        "bin": np.concatenate([np.empty(0, np.int64), *bins]),
        "n": np.concatenate([np.empty(0, np.int64), *counts]),
    })


def _select(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The chunk's pairs above each query's kth value, and the k smallest ids equal to it."""
    out = []
    low = queries.column("low").to_numpy()
    names, c_ids = queries.column("id").to_numpy(), candidates.column("id").to_numpy()
    by_id = np.argsort(c_ids, kind="stable")
    for a, scores, own in _scores(queries, candidates):
        scores[own] = LEAST
        scores = scores[:, by_id]
        kth = low[a : a + len(scores), None]
        above = (scores > kth) & (scores > LEAST)
        equal = (scores == kth) & (scores > LEAST)
        equal &= np.cumsum(equal, axis=1) <= k
        row, column = np.nonzero(above | equal)
        out.append((names[a + row], c_ids[by_id[column]], scores[row, column]))
    columns = [np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*out)] or [[]] * 3
    return pa.table(dict(zip(("query_id", "vec_id", "score"),
                             (pa.array(x, pa.int64()) for x in columns))))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K,
          query_chunk: int = QUERY_CHUNK, candidate_chunk: int = CANDIDATE_CHUNK) -> DataFrame:
    """The k best candidates of each query by inner product; ties go to the smaller id.

    Both sides have (id long, v array<long>), as `vectors` gives them. A query never meets
    candidates of its own id. Repeated query ids are one query (its smallest vector);
    repeated candidate ids are candidates each, and rank by id among equal scores. A query
    with fewer than k candidates gets all of them. Vectors of different lengths are compared
    as if the shorter one were padded with zeros. Scores have to fit a long.
    """
    spark = queries.sparkSession
    importable(spark)
    queries = staged(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    candidates = staged(candidates.select("id", "v", F.monotonically_increasing_id().alias("row")), "candidates")
    sizes = [df.count() for df in (queries, candidates)]
    chunks = tuple(max(1, -(-n // c)) for n, c in zip(sizes, (query_chunk, candidate_chunk)))
    # A bound on every score: each component's largest size, summed over the vector.
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    bounds = [df.agg(F.max(norm)).first()[0] or 0.0 for df in (queries, candidates)]
    bound = int((bounds[0] * bounds[1]) ** 0.5) + 1

    # Per query: the interval [low, low + width * BINS) with the kth value, and how many
    # scores lie above it.
    # Widths are powers of BINS, so a bin of one round is exactly the next one's interval.
    width = 1
    while width * BINS < 2 * bound + 1:
        width *= BINS
    state = queries.select("id", F.lit(-bound).cast("long").alias("low"),
                           F.lit(width).cast("long").alias("width"), F.lit(0).cast("long").alias("above"))
    while True:
        counted = _cells(queries.join(state, "id"), candidates, chunks).applyInArrow(
            lambda left, right: _count(left, right, k), "id long, bin long, n long"
        )
        totals = counted.groupBy("id", "bin").agg(F.sum("n").alias("n"))
        from_top = Window.partitionBy("id").orderBy(F.desc("bin"))
        running = totals.join(state, "id").withColumn("upto", F.col("above") + F.sum("n").over(from_top))
        # The first bin from the top that reaches k; of a query with fewer, the lowest bin.
        reached = running.groupBy("id").agg(
            F.max(F.when(F.col("upto") >= k, F.struct("bin", "low", "width", "upto", "n"))).alias("r"),
            F.min(F.struct("bin", "low", "width", "upto", "n")).alias("least"),
        ).select("id", F.coalesce("r", "least").alias("r"))
        done, narrower = width == 1, max(width // BINS, 1)
        state = reached.select(
            "id",
            (F.col("r.low") + F.col("r.bin") * F.col("r.width")).alias("low"),
            F.lit(narrower).cast("long").alias("width"),
            (F.col("r.upto") - F.col("r.n")).alias("above"),
        )
        state = staged(state, "kth_values")
        if done:
            break
        width = narrower

    pairs = _cells(queries.join(state, "id"), candidates, chunks).applyInArrow(
        lambda left, right: _select(left, right, k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
