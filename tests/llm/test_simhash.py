"""SimHash near-duplicates against all pairs, the plan against its own promise."""

import random

import numpy as np
import pytest
import xxhash
from llm_rows import DATA, EDGES, documents  # noqa: F401
from pyspark.sql import functions as F

from meterstar.llm import registry
from meterstar.llm import simhash as S
from meterstar.llm.common import BY_SYMBOLS, BY_WHITESPACE, words_of


def print_of(text):
    words = "".join(c.lower() if c < "\x80" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, distance, prints=None):
    """(id, fingerprint, component) by comparing all pairs of fingerprints."""
    prints = prints or [print_of(t) for _, t in rows]
    distinct = np.array(sorted(set(prints)), np.uint64)
    near = np.bitwise_count(distinct[:, None] ^ distinct[None, :]) <= distance
    label = S.forest(len(distinct), *np.nonzero(near))
    root = {int(p): int(label[i]) for i, p in enumerate(distinct)}
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    return [(i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints)]


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_fingerprints_are_spark_s_own_hashes(spark):
    texts = ["One two THREE four five", "a\tb\x0bc", "É é word É é word again", "x"]
    for text in texts:
        words = text.encode().lower().split()
        gram = b" ".join(words[:4]).decode()
        expected = spark.range(1).select(F.xxhash64(F.lit(gram))).first()[0]
        assert int(next(S.shingle_hashes(text))[0]) == expected % 2**64
    assert [int(x) for x in S.fingerprints([*texts, None, ""])] == [print_of(t) for t in [*texts, None, ""]]


def test_long_texts_are_read_in_pieces_without_a_seam():
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(50)}" for _ in range(5000)) + "\n"
    for table in (BY_WHITESPACE, BY_SYMBOLS):
        whole = [w for part in words_of(text, table) for w in part]
        for limit in (1, 7, 1000):
            assert [w for part in words_of(text, table, limit) for w in part] == whole
    assert int(S.fingerprints([text * 60])[0]) == print_of(text * 60)


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
def test_thresholds_find_every_pair(distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, distance, replace=False).astype(np.uint64))
             for _ in base]
    other = base ^ np.array(flips, np.uint64)
    # Two bits that are always alike, and one that never changes.
    numbers = np.unique(np.concatenate([base, other, rng.integers(0, 2**63, 500, dtype=np.uint64)]))
    bits = S.bit_matrix(numbers)
    for parts in range(2, 6):
        plan = S.Plan(S.grouped(np.abs(np.corrcoef(bits.T + rng.normal(0, 1e-9, bits.T.shape))), parts), distance)
        assert sorted(b for p in plan.parts for b in p) == list(range(64))
        if parts * (plan.reach + 1) < distance + 1:
            continue
        plan.learn(plan.histograms(bits).astype(float))
        thresholds, cost = plan.thresholds(bits, len(numbers))
        assert ((thresholds + 1).sum(1) == distance + 1).all() and np.isfinite(cost).all()
        held, asked = set(), set()
        for key, owner, role in S.signatures(plan, numbers, len(numbers)):
            for k, o, r in zip(key.tolist(), owner.tolist(), role.tolist()):
                (held.add((k, o)) if r & S.INDEXED else None, asked.add((k, o)) if r & S.PROBES_IT else None)
        by_key = {}
        for k, o in held:
            by_key.setdefault(k, set()).add(o)
        for a, b in zip(base.tolist(), other.tolist()):
            assert any(b in by_key.get(k, ()) for k, o in asked if o == a)


def test_dynamic_program_gives_the_least_cost():
    from itertools import product

    rng = np.random.default_rng(5)
    bits = S.bit_matrix(rng.integers(0, 2**62, 30, dtype=np.uint64))
    plan = S.Plan(S.grouped(np.abs(np.corrcoef(bits.T + rng.normal(0, 1e-9, bits.T.shape))), 3), 4)
    plan.learn(plan.histograms(bits).astype(float))
    costs = plan.costs(bits, 30)
    _, best = plan.thresholds(bits, 30)
    for f in range(30):
        options = [sum(costs[i, f, t] for i, t in enumerate(ts))
                   for ts in product(range(plan.reach + 2), repeat=3) if sum(ts) == 5]
        assert best[f] == pytest.approx(min(options))


@pytest.mark.parametrize("seed, distance, slot", [(1, 4, 2048), (4, 9, 8), (5, 0, 8)])
def test_against_all_pairs(spark, documents, monkeypatch, seed, distance, slot):  # noqa: F811
    monkeypatch.setattr(S, "SLOT", slot)  # small ones deal many keys into cells
    rng = random.Random(seed)
    rows = []
    for b in range(25):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 300))]
        for _ in range(rng.choice([1, 1, 4, 12])):
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(words)))
    rows += EDGES + [(rows[3][0], rows[3][1]), (900, rows[3][1].upper() + " \t")]
    got = S.near_duplicates(documents(rows), distance=distance)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert result(got) == sorted(brute(rows, distance), key=str)


def test_a_crowd_of_near_fingerprints_returns_a_forest(spark):
    rng = np.random.default_rng(2)
    flips = np.uint64(1) << rng.integers(0, 64, (3000, 2)).astype(np.uint64)
    prints = np.unique(np.uint64(0x123456789ABCDEF) ^ flips[:, 0] ^ flips[:, 1])
    edges = S.linked(np.zeros(len(prints), np.int64), prints, np.full(len(prints), 3), 4)
    assert len(edges) == len(prints) - 1


def test_no_rows(spark, documents):  # noqa: F811
    assert S.near_duplicates(documents([(1, "a")]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        S.near_duplicates(documents([(1, "a")]), distance=17)


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    prints = [int(x) for x in S.fingerprints([t for _, t in rows])]
    assert prints[:40] == [print_of(t) for _, t in rows[:40]]
    assert result(registry.op11_simhash(spark, DATA)) == sorted(brute(rows, 4, prints), key=str)
