"""Top-k search against a sort of all scores."""

import math
import random

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F
from llm_rows import DATA

from meterstar.llm import registry, topk


def brute(rows, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % 20 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = set()
    for q, x in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in good if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def search(spark, rows, k, **sizes):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows],
                               "vec_id bigint, embedding array<double>, id int, v string")
    vectors = topk.vectors(df, "vec_id", "embedding")
    found = topk.top_k(vectors.filter(F.col("id") % 20 == 0), vectors, k, **sizes)
    return found.collect()


@pytest.mark.parametrize("seed, spread, k", [(1, 1.0, 20), (2, 0.02, 7), (3, 1e5, 3)])
def test_against_a_sort(spark, seed, spread, k):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, spread) for _ in range(5)]) for i in range(260)]
    rows += [(1000 + i, [0.5] * 5) for i in range(90)]  # ties by the dozen
    rows += [(1, None), (2, [1.0, None]), (3, [float("nan")]), (40, [float("inf")] * 5), (None, [1.0] * 5), (7, []), (60, [2.0])]
    got = search(spark, rows, k, query_chunk=7, candidate_chunk=50)
    assert len(got) == len({tuple(r) for r in got})
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == brute(rows, k)


def test_few_candidates_equal_vectors_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (5, [1.0, 2.0])]
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in search(spark, rows, 20)} == brute(rows, 20)
    assert search(spark, [(0, [1.0])], 20) == []
    assert search(spark, [(1, [1.0]), (2, [1.0])], 20) == []
    zero = [(i, [0.0, 0.0]) for i in range(0, 60)]
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in search(spark, zero, 4)} == brute(zero, 4)


def test_rows_of_one_id_are_dealt_over_chunks(spark):
    rows = [(3, [float(i % 7), 1.0]) for i in range(400)] + [(0, [1.0, 1.0]), (20, [2.0, 0.0])]
    got = [tuple(r) for r in search(spark, rows, 9, candidate_chunk=40)]
    assert sorted(got) == sorted(brute_all(rows, 9))
    df = spark.createDataFrame([(r[0], [int(64 * x) for x in r[1]], i) for i, r in enumerate(rows)],
                               "id bigint, v array<bigint>, row bigint")
    cells = df.select((F.pmod(F.xxhash64("row"), F.lit(10))).alias("c")).groupBy("c").count().collect()
    assert len(cells) == 10 and max(r["count"] for r in cells) < 90


def brute_all(rows, k):
    """As `brute`, with every row of a repeated id."""
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in vectors if i % 20 == 0}):
        x = min(v for i, v in vectors if i == q)
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in vectors if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def test_query_matches_sql(spark):
    con = connect(DATA)
    con.execute(f"create view embeddings as select * from '{DATA}/embeddings.parquet'")
    assert compare(registry.op3_topk(spark, DATA), con, registry.OP3_SQL) == []
