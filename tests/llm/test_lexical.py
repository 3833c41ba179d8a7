"""Ranked lexical search against scores of all pairs, and against SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_rows import DATA, EDGES, documents  # noqa: F401
from oracle import compare, connect

from meterstar.llm import lexical as L
from meterstar.llm import registry

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def brute(items, docs, k):
    counted = [(i, len(t), Counter(t)) for i, text in docs if (t := terms_of(text))]
    n, total = len(counted), sum(size for _, size, _ in counted)
    df = Counter(t for _, _, c in counted for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(terms_of(text)), []
        for doc, size, c in counted:
            m = 100 - 25 + (25 * size * n) // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc))
        out += [(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def made(rng, n, words):
    vocabulary = [f"w{i}" for i in range(words)] + ["Éa", "éa", "x9", "中文"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 40))) for _ in range(n)]


def found(spark, documents, items, docs, k=20, **shape):  # noqa: F811
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items],
                                  "item_id bigint, text string, item string, rank int")
    df = L.search_documents(table, documents(docs), k, **shape)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed, k, small", [(1, 20, False), (2, 3, True)])
def test_against_all_pairs(spark, documents, seed, k, small):  # noqa: F811
    # Several blocks of items, several batches, deep trees.
    shape = dict(block_items=9, leaf=3, batch=50, fanout=2) if small else {}
    rng = random.Random(seed)
    texts = made(rng, 260, 120)
    docs = list(enumerate(texts)) + [(1000 + i, texts[7]) for i in range(30)] + EDGES + [(-5, "... !"), (77, "W1-w1/w2\x00w3_w4")]
    items = [(i, t) for i, t in enumerate(made(rng, 20, 120))]
    items += [(100, texts[7]), (101, None), (102, " ., "), (103, "nowhere"), (None, "w1 w2"), (104, "w3 w3 W3 same no id")]
    assert found(spark, documents, items, docs, k, **shape) == sorted(brute(items, docs, k), key=str)


def test_repeated_items_and_no_rows(spark, documents):  # noqa: F811
    docs = [(1, "a b"), (2, "a c"), (3, "d")]
    got = found(spark, documents, [(1, "b"), (1, "a"), (1, "a")], docs)
    assert got == sorted(brute([(1, "a")], docs, 20), key=str)
    assert found(spark, documents, [], docs) == []
    assert found(spark, documents, [(1, "a")], [(1, None), (2, " ")]) == []


def test_bounds_hold_and_most_pairs_are_pruned():
    rng = random.Random(4)
    items = L.Items([(i, {b"t%d" % t: 1 for t in rng.sample(range(600), 12)}) for i in range(40)])
    items.weigh(np.array([rng.randint(1, 5000) for _ in items.terms], float))
    assert sorted(items.order) == list(range(40))
    width = len(items.terms)
    assert [len(level) for level in items.levels] == [40, 10, 3, 1]
    assert (items.levels[-1][0] == items.levels[0].max(0)).all()
    # Documents of 40 subjects, which are neighbours, as after the range shuffle.
    subjects = [rng.sample(range(width), 14) for _ in range(40)]
    rows = [sorted({*rng.sample(subjects[d // 100], 6), rng.randrange(width)}) for d in range(4000)]
    offsets = np.cumsum([0, *map(len, rows)])
    terms = np.concatenate(rows)
    impacts = np.array([rng.randint(1, 999) for _ in terms], float)
    dense = np.zeros((4000, width))
    dense[np.repeat(np.arange(4000), np.diff(offsets)), terms] = impacts
    scores = (items.levels[0] @ dense.T).astype(int)
    best = [sorted((-s, False, d) for d, s in enumerate(row) if s > 0)[:5] for row in scores]
    floors = np.array([-b[-1][0] if len(b) == 5 else L.NONE for b in best])
    warm, cold = L.Search(items, 5, floors), L.Search(items, 5, np.full(40, L.NONE))
    for search in (warm, cold):
        search.add(list(range(4000)), offsets, terms, impacts, False)
        assert search.best == best
    assert warm.compared < 0.2 * scores.size and warm.compared < cold.compared < scores.size
    seed = L.Search(items, 5, np.full(40, L.NONE))
    seed.add(list(range(4000)), offsets, terms, impacts, True)
    assert (seed.floors <= floors).all() and seed.floors.max() > 0


def test_query_matches_sql(spark):
    con = connect(DATA)
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    assert compare(registry.op13_dual_tree(spark, DATA), con, registry.OP13_SQL) == []
