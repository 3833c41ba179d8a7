"""The corpus pipeline: each stage against what it must do to planted documents."""

import os
import random

import pytest
from pyspark.sql import functions as F
from llm_rows import EDGES, documents  # noqa: F401

import corpus_pipeline as P
from meterstar import scratch
from meterstar.llm import packing, registry
from meterstar.llm.common import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(rng, words=60):
    return " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean, short, toxic, copied and secret-bearing documents, with labels."""
    rng = random.Random(17)
    clean = {i: prose(rng) for i in range(120)}
    toxic = {200 + i: prose(rng, 30) + " you worthless idiot, you stupid moron. " + prose(rng, 30) for i in range(40)}
    short = {300 + i: prose(rng, 5) for i in range(10)}
    copies = {400 + i: clean[i % 3] for i in range(30)}
    near = {500 + i: clean[5] + " " + prose(rng, 1) for i in range(20)}
    secret = {600: prose(rng) + "\npassword = hunter2hunter2\n" + prose(rng)}
    rows = clean | toxic | short | copies | near | secret
    root = str(tmp_path_factory.mktemp("planted"))
    table = [(k, t, "en", f"src{k % 2}", len(t)) for k, t in rows.items()]
    spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{root}/documents.parquet")
    labels = [(k, 1, int(k in toxic)) for k in [*clean, *toxic]]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, {"clean": clean, "toxic": toxic, "short": short, "copies": copies, "near": near, "secret": secret}


def test_stages_take_effect_in_order(spark, planted, tmp_path):
    root, rows = planted
    docs, kept = read_table(spark, root, "documents"), {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, root)
        if name != P.STAGES[-1][0]:
            assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    everything = {k for group in rows.values() for k in group}
    assert kept["quality_rules"] == everything - set(rows["short"])
    assert kept["toxicity"] == kept["quality_rules"] - set(rows["toxic"])
    gone = set(rows["copies"]) | set(rows["near"])
    assert kept["ngram_jaccard_join"] == kept["toxicity"] - gone == set(rows["clean"]) | {600}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/secret_scans").collect()}
    assert texts[600] == rows["secret"][600].replace("password = hunter2hunter2", "<ASSIGN>")
    assert all(texts[k] == t for k, t in rows["clean"].items())
    packed = spark.read.parquet(f"{tmp_path}/best_fit_packing")
    assert kept["best_fit_packing"] == set(texts)
    direct = packing.pack_documents(spark.read.parquet(f"{tmp_path}/secret_scans"), keep_ids=False)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(key).collect())) == sorted(map(tuple, direct.select(key).collect()))
    whole = P.run(spark, root)
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, packed.select(key).collect()))


def test_stages_take_hard_rows(spark, documents, tmp_path):  # noqa: F811
    """Nulls, repeats, long and empty texts, clashing columns; then no rows at all."""
    rng = random.Random(18)
    rows = EDGES + [(k, prose(rng)) for k in range(50, 60)] + [(None, prose(rng)), (70, prose(rng)), (70, prose(rng))]
    spark.createDataFrame([(50, 1, 0), (51, 1, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, df in (("some", documents(rows)), ("none", documents([]))):
        docs = df
        for i, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert i == len(P.STAGES) - 1 or out.columns == df.columns
            out.write.parquet(f"{tmp_path}/{name}{i}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{i}")
        if name == "none":
            assert docs.count() == 0
        else:
            # The long text repeats itself; short and empty texts are no documents.
            assert docs.select("doc_id").filter("piece = 0").count() == 13


def test_stages_remove_nothing_that_is_unread(spark, planted):
    """Two inputs, results read late and out of order; then two runs in one session."""
    root, _ = planted
    docs = read_table(spark, root, "documents")
    first, second = P.rules(spark, docs, root), P.rules(spark, docs.filter("doc_id < 200"), root)
    near = P.one_of_each(spark, first, root)
    again = P.no_secrets(spark, first, root)
    assert second.count() == 120 and again.count() == first.count() > near.count() > 0
    with scratch.collecting() as made:
        one = P.run(spark, root)
        two = P.run(spark, root)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    left = [p for p in made if os.path.exists(p.removeprefix("file:"))]
    assert len(left) == 2 and sorted(scratch.read_by(one, made) + scratch.read_by(two, made)) == sorted(left)


def test_given_documents(spark):
    """Clean labelled documents stay, toxic ones go. (On the table of sf0.01, 51 toxic labels
    in four languages are too few to learn the words of three of them: a quarter stays.)"""
    root = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, root, "documents"), read_table(spark, root, "labels")
    kept = P.not_toxic(spark, docs, root).select("doc_id").join(labels, "doc_id")
    by_label = {r.toxic: r.n for r in kept.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    all_of = {r.toxic: r.n for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    assert by_label[0] >= 0.99 * all_of[0] and by_label.get(1, 0) <= 0.1 * all_of[1]


def test_all_queries_are_registered():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names[:-1]] == [f"op{i}" for i in range(1, 14)] and names[-1] == "pipeline"
    assert set(registry.oracle_sql()) < set(names)
