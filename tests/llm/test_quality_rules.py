"""Quality rules against a plain recount of windows, lines and hosts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import compare, connect
from llm_rows import DATA, EDGES, documents  # noqa: F401

from meterstar.llm import quality_rules as Q
from meterstar.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows, share, minimum):
    def line_key(line):
        low = " ".join(WORD.findall(line)).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.sub("[0-9]+", "0", low)

    texts, holders = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                holders[host, line_key(line)].add(text)
    out = []
    for doc_id, text, host in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in lines
                   if len(holders[host, line_key(x)]) >= minimum and len(holders[host, line_key(x)]) > share * len(texts[host]))
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        left = len(words) - gone
        kept = not failed and left >= Q.MIN_WORDS and 100 * left >= Q.KEEP_PERCENT * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                    len(lines) - len(set(lines)), len(covered), failed, kept))
    return out


def random_rows(rng, n):
    common = ["Subscribe NOW to our 12 letters", "all rights\treserved  2024", "share this", "menu home about"]
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(rng.randint(0, 12)))
                 for _ in range(rng.randint(1, 6))]
        lines += [rng.choice(common).replace("12", str(rng.randint(1, 99))) for _ in range(rng.randint(0, 5))]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["hot", "hot", "small", None])))
    return rows + [(1000 + i, rows[0][1], "hot") for i in range(30)]  # copies count once


def test_against_a_recount(spark, documents):  # noqa: F811
    rng = random.Random(11)
    rows = random_rows(rng, 160) + [(d, t, "hot") for d, t in EDGES]
    judged = Q.digest(Q.judge(documents(rows), share=0.1, min_documents=5).withColumnRenamed("verdict", "_mine")
                      .withColumnRenamed("_verdict", "verdict").drop("n_words"))
    got = [tuple(r) for r in judged.collect()]
    assert sorted(map(str, got)) == sorted(map(str, slow(rows, 0.1, 5)))
    assert any(not r[6] and not r[7] for r in got) and any(r[7] for r in got)


def test_repeated_windows():
    rng = random.Random(12)
    for _ in range(100):
        docs = [[rng.randrange(3) for _ in range(rng.randrange(40))] for _ in range(4)]
        docs[1] = docs[1][:12] * 2
        ids = np.array([w for d in docs for w in d], np.int64)
        owner = np.repeat(np.arange(4), [len(d) for d in docs])
        want = []
        for d in docs:
            windows = Counter(tuple(d[i : i + 8]) for i in range(len(d) - 7))
            want.append(len({i + k for i in range(len(d) - 7) if windows[tuple(d[i : i + 8])] > 1 for k in range(8)}))
        assert Q.repeated_words(ids, owner, 4).tolist() == want


def test_white_space_that_is_no_separator_is_a_word():
    """A line of a no-break space has a word, so its mark counts and it can go."""
    odd = "\u00a0"
    assert Q.without_lines(f"a\n{odd}\n \t\nb", {Q.line_mark(odd.encode())}) == "a\n \t\nb"


@pytest.mark.parametrize("held", [200_000, 0])
def test_both_ways_to_filter_are_the_verdicts(spark, documents, monkeypatch, held):  # noqa: F811
    monkeypatch.setattr(Q, "FREQUENT_LINES", held)
    rng = random.Random(21)
    rows = random_rows(rng, 120) + [(d, t, "hot") for d, t in EDGES]
    df = documents(rows)
    judged = Q.judge(df, share=0.1, min_documents=5)
    want = []
    for r in judged.filter("_verdict.kept").collect():
        gone = {bytes(m) for m in r._verdict.removed or ()}
        want.append((r.doc_id, Q.without_lines(r.text, gone) if gone else r.text))
    out = Q.filter_documents(df, share=0.1, min_documents=5)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and 0 < len(got) < len(rows)
    assert any(t != x for (i, t) in got for j, x, _ in rows if i == j)


def test_filtered_documents_lose_the_common_lines(spark, documents):  # noqa: F811
    banner = "Read 5 more stories in our weekly paper"
    own = ["".join(chr(97 + (i // 7**k) % 7) for k in range(3)) for i in range(40)]
    rows = [(i, " ".join(own[i] + chr(97 + j) for j in range(25)) + f"\n{banner.replace('5', str(i))}\n\nend {own[i]} here", "h")
            for i in range(40)]
    rows += [(100, f"{banner}\n" + banner.lower(), "h"), (101, "\n".join(f"z{j} z z z z z z" for j in range(9)), "other"), (102, None, "h")]
    df = documents(rows)
    out = Q.filter_documents(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {*range(40), 101}
    for i in range(40):
        assert got[i].text == rows[i][1].replace(f"{banner.replace('5', str(i))}\n", "") and got[i].n_chars == len(got[i].text)
    assert got[101].text == rows[41][1]
    assert Q.filter_documents(documents([])).count() == 0


def test_query_matches_sql(spark):
    con = connect(DATA)
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    assert compare(registry.op5_quality_rules(spark, DATA), con, registry.OP5_SQL) == []


def test_sql_agrees_where_lines_go(spark, tmp_path):
    """A large host and a small one, each with lines above its limit and lines below it."""
    rng = random.Random(31)

    def line(words):
        return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(words))

    rows, banners = [], [line(9) + " 2024", line(12), line(7)]
    for i in range(420):
        host = "large" if i < 360 else "small" if i < 410 else None
        lines = [line(rng.randint(3, 14)) for _ in range(rng.randint(1, 4))]
        lines += [b.replace("2024", str(rng.randint(1, 9999))) for b, share in zip(banners, (0.5, 0.12, 0.06)) if rng.random() < share]
        if i % 7 == 0:
            lines = [banners[0], banners[0].upper(), line(2)]  # little else: depleted on its host
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines) if i % 50 else None, host))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = connect(DATA)
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    df = registry.op5_quality_rules(spark, str(tmp_path))
    assert compare(df, con, registry.OP5_SQL) == []
    judged = Q.judge(docs).filter("verdict.removed is not null").groupBy("source").count().collect()
    assert {r.source for r in judged} >= {"large", "small"}
    assert df.filter("not base_failed and not kept").count() > 0
