"""The Jaccard join against all pairs, its parts against their own definitions."""

import random

import numpy as np
import pytest
from oracle import compare, connect
from llm_rows import DATA, EDGES, documents  # noqa: F401

from meterstar.llm import jaccard as J
from meterstar.llm import registry
from meterstar.llm.components import components


def sets_of(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, percent, n):
    """(id, size, component, links) by comparing every pair of distinct sets."""
    sets = [sets_of(t, n) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    links = dict.fromkeys(distinct, 0)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[find(s)] = min(least.get(find(s), doc_id), doc_id)
    return [(d, len(s), least.get(find(s)) if s else d, links.get(s, 0)) for (d, _), s in zip(rows, sets)]


def copies(rng, bases, each, size, edits):
    rows = []
    for b in range(bases):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randint(*size))]
        for _ in range(each):
            words = list(base)
            for _ in range(rng.randrange(edits + 1)):
                at = rng.randrange(len(words))
                action = rng.random()
                if action < 0.6:
                    words[at] = f"e{rng.randrange(10_000)}"
                elif action < 0.8 and len(words) > 1:
                    del words[at]
                else:
                    words.insert(at, f"i{rng.randrange(10_000)}")
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent, n, size, edits", [(90, 3, (1, 40), 2), (90, 3, (60, 150), 6), (80, 5, (30, 120), 5), (50, 1, (2, 30), 6)])
def test_against_all_pairs(spark, documents, monkeypatch, percent, n, size, edits):  # noqa: F811
    # Small slots and column blocks: many cells, many blocks.
    for name, value in (("SLOT_DOCUMENTS", 12), ("SLOT_GRAMS", 3000), ("COLUMN_BLOCK", 16)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(percent + n + size[0])
    rows = copies(rng, 10, 14, size, edits) + [(d and d + 5000, t) for d, t in EDGES]
    rows += [(9000 + i, rows[0][1]) for i in range(40)]  # one large group of exact copies
    got = [tuple(r) for r in J.join_documents(documents(rows), percent=percent, n=n).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, percent, n)))


def test_linked_pairs_of_a_cell(monkeypatch):
    monkeypatch.setattr(J, "COLUMN_BLOCK", 7)
    rng = random.Random(13)
    for _ in range(150):
        base = list(range(40))
        sets = [np.array(sorted({x if rng.random() > 0.06 else rng.randrange(100, 130) for x in base[: rng.randint(1, 40)]}), np.uint64)
                for _ in range(12)]
        left = np.array(sorted(rng.sample(range(12), rng.randint(1, 12))))
        right = left if rng.random() < 0.5 else np.array([i for i in range(12) if i not in left], np.int64)
        if not len(right):
            right = left
        i, j = J.linked_pairs(sets, left, right, 80)
        want = set()
        for a in left.tolist():
            for b in right.tolist():
                x, y = set(sets[a].tolist()), set(sets[b].tolist())
                if 100 * len(x & y) >= 80 * len(x | y) and (a < b if left is right else True):
                    want.add((a, b))
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def needed(grams, groups, percent, classes):
    """The marks of a set that come first, by group, in an order that `classes` gives."""
    marks, places = J.signatures(grams, groups, percent)
    out = set()
    for place in np.unique(places):
        own = sorted(marks[places == place].tolist(), key=lambda m: (classes(m), m))
        out |= set(own[: len(own) - (int(place) & 0xFFFFFF)])
    return out


def test_linked_sets_share_a_needed_mark_in_any_order():
    rng = random.Random(14)
    for percent in (90, 80, 50):
        groups = J.size_groups(percent)
        for _ in range(300):
            size = rng.randint(1, 300)
            a = np.unique(J.mixed(np.array([rng.getrandbits(60) for _ in range(size)], np.uint64)))
            keep = a[np.random.default_rng(rng.getrandbits(30)).permutation(len(a))[: len(a) - rng.randint(0, len(a) // 10)]]
            new = np.array([rng.getrandbits(60) for _ in range(rng.randint(0, max(1, len(a) // 12)))], np.uint64)
            b = np.unique(np.concatenate([keep, J.mixed(new)]))
            both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * both >= percent * union and both < union:
                salt = rng.getrandbits(30)
                order = lambda m: hash((m, salt)) % 7
                assert needed(a, groups, percent, order) & needed(b, groups, percent, order)


def test_shared_marks_are_counted_whatever_the_batches(spark, settings):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="50")
    rng = random.Random(15)
    rows = [(m, k, 5) for m in range(40) for k in range(rng.choice([1, 1, 2, 5, 63, 64, 65, 300]))]
    rows += rng.sample(rows, 500)  # classes that several tasks met
    df = spark.createDataFrame(rows, "mark bigint, key bigint, place int").repartition(7)
    sizes = {}
    for m, k, _ in set(rows):
        sizes[m] = sizes.get(m, 0) + 1
    want = sorted((m, k, p, min(sizes[m], J.FREQUENT)) for m, k, p in set(rows) if sizes[m] > 1)
    assert sorted(tuple(r) for r in J.shared_marks(df).collect()) == want


def test_texts_that_share_a_passage_are_no_candidates(spark):
    rng = random.Random(16)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    for share, percent, n in [(0.25, 80, 5), (0.4, 80, 5), (0.5, 90, 3)]:
        passage = words(int(400 * share))
        texts = []
        for _ in range(400):
            own = words(400 - len(passage))
            at = rng.randrange(len(own))
            texts.append(" ".join(own[:at] + passage + own[at:]))
        docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
        found = components(J.candidate_edges(J.needed_marks(J.shared_marks(J.marked(docs, percent, n)))))
        assert found.count() <= 20, (share, percent)


def test_components(spark):
    rng = random.Random(15)
    path = [(i, i + 1) for i in range(200)]
    rng.shuffle(path)
    star = [(1000, 1001 + i) for i in range(50)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = path + star + loose + [(5, 5), (0, 1), (1, 0)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == nodes
    pairs = {(got[x], find(x)) for x in nodes}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_distinct_documents(spark, documents):  # noqa: F811
    rng = random.Random(16)
    rows = copies(rng, 8, 6, (40, 80), 2) + [(d and d + 5000, t) for d, t in EDGES] + [(7000, EDGES[5][1])]
    df = documents(rows)
    out = J.distinct_documents(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, str(r.text)[:40]) for r in out.collect())
    wanted = {}
    for (doc_id, text), (_, size, component, _) in zip(rows, brute(rows, 80, 5)):
        if not size or doc_id == component:
            wanted[doc_id is None, doc_id or 0, str(text)[:40]] = 1
    assert got == sorted(wanted)
    assert J.distinct_documents(documents([])).count() == 0


def test_query_matches_sql(spark):
    con = connect(DATA)
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    assert compare(registry.op10_jaccard_join(spark, DATA), con, registry.OP10_SQL) == []
