"""Toxicity and quality scores: held-out accuracy, no leaks, hard rows."""

import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_rows import EDGES, documents  # noqa: F401

from meterstar.llm import quality_cnn, registry, toxic_features, toxicity
from meterstar.llm.common import labelled_sample, read_table

BIG = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    labels = read_table(spark, BIG, "labels").select("doc_id", F.col(label).alias("y"))
    rows = query(spark, BIG).join(labels, "doc_id").filter("held_out").collect()
    return np.array([r.y for r in rows]), np.array([r.predicted for r in rows]), np.array([r.score for r in rows])


def test_toxicity_of_held_out_documents(spark):
    y, predicted, score = held_out(spark, registry.op1_toxicity, "toxic")
    assert len(y) > 500 and ((0 <= score) & (score <= 1)).all() and ((score >= 0.5) == predicted).all()
    assert (predicted == y).mean() > 0.98
    assert predicted[y == 1].mean() > 0.9 and predicted[y == 0].mean() < 0.01


def test_quality_of_held_out_documents(spark):
    y, predicted, score = held_out(spark, registry.op4_quality_cnn, "quality")
    assert len(y) > 1000 and ((0 <= score) & (score <= 1)).all() and ((score >= 0.5) == predicted).all()
    assert (predicted == y).mean() > 0.97 and predicted[y == 1].mean() > 0.98
    assert predicted[y == 0].mean() < 0.12  # a recall of label 0 of 0.88 at least


@pytest.mark.parametrize("query, fold, held", [(registry.op1_toxicity, 5, 0), (registry.op4_quality_cnn, 3, 1)])
def test_labels_of_held_out_rows_are_not_learnt(spark, tmp_path, query, fold, held):
    """Turning them round changes no score; neither do lang, source and n_chars."""
    small = "/root/testdata/sf0.01"
    part = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(fold)) == held
    labels = read_table(spark, small, "labels")
    labels.withColumns({c: F.when(part, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")}).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    docs = read_table(spark, small, "documents")
    docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("bigint")}).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    before = {r.doc_id: (r.held_out, round(r.score, 9)) for r in query(spark, small).collect()}
    after = {r.doc_id: (r.held_out, round(r.score, 9)) for r in query(spark, str(tmp_path)).collect()}
    assert before == after
    assert all(v[0] == (zlib.crc32(str(k).encode()) % fold == held) for k, v in before.items())


@pytest.mark.parametrize("module", [toxicity, quality_cnn])
def test_hard_rows_and_few_labels(spark, documents, module):  # noqa: F811
    df = documents(EDGES)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 1), (None, 0, 0), (3, None, None), (3, 7, 7), (99, 1, 1)], none.schema)
    both = spark.createDataFrame([(4, 1, 1), (3, 0, 0), (4, 1, 1), (5, 1, 1)], none.schema)
    for labels in (none, one, both):
        rows = module.score_documents(df, labels, score_column="own").collect()
        assert len(rows) == len(EDGES) and all(0 <= r.own <= 1 for r in rows)
        assert all(r.score == 2 and r._features == "f" for r in rows)
    assert module.score_documents(documents([]), both, score_column="own").count() == 0


def test_obfuscated_words_count():
    stems = toxic_features.Stems([])
    density = toxic_features.FEATURES.index("insult_density")
    masked = toxic_features.FEATURES.index("obfuscated_count")
    plain = toxic_features.features("you are an idiot today", stems)
    assert plain[density] == 20 and plain[masked] == 0 and plain[toxic_features.FEATURES.index("near_second_person")] > 0
    for text in ("you 1d10t there", "you id*ot there", "you i.d.i.o.t there", "you idiooooot there",
                 "you id​iot there", "you і­dіоt there"):
        row = toxic_features.features(text, stems)
        assert row[density] > 0, text
    assert toxic_features.features("a fine day", stems)[density] == 0
    assert toxic_features.features(None, stems) == [0.0] * len(toxic_features.FEATURES)


def test_clean_documents_keep_their_columns(spark, documents):  # noqa: F811
    rows = [(i, f"a calm and friendly note number {i}") for i in range(200)]
    rows += [(200 + i, f"note {i} you worthless idiot and stupid moron") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i in range(260)], "doc_id bigint, quality int, toxic int")
    df = documents(rows + EDGES)
    out = toxicity.clean_documents(df, labels)
    assert out.columns == df.columns
    got = [r.doc_id for r in out.collect()]
    assert {i for i in got if i is not None and i >= 100} == set(range(100, 200)) and len(got) == 200 + len(EDGES)


# -- the network -----------------------------------------------------------------


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        data = bytes(1 + i % 255 for i in range(n))
        rows = quality_cnn.chunks(data)
        step = quality_cnn.CHUNK - quality_cnn.OVERLAP
        joined = b"".join(bytes(r[:step]) for r in rows) + bytes(rows[-1][step:])
        assert joined.rstrip(b"\0") == data and len(joined) - len(data) < quality_cnn.CHUNK + 1
        assert all((rows[i][step:] == rows[i + 1][: quality_cnn.OVERLAP]).all() for i in range(len(rows) - 1))


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    net = quality_cnn.Network.start(rng)
    for name in ("embedding", "filters", "bias", "weights", "intercept"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.bias += 0.3
    texts = [b"abc def ghi " * 60, b"zzz", b"qwertz uiop " * 5]
    labels = np.array([1.0, 0.0, 1.0])
    grads, _ = quality_cnn.gradients(net, texts, labels)
    for name, g in zip(("embedding", "filters", "bias", "weights", "intercept"), grads):
        value = getattr(net, name)
        places = np.argwhere(np.abs(g) > 1e-4)
        for at in places[rng.permutation(len(places))[:8]]:
            at, old, step = tuple(at), value[tuple(at)], 1e-6
            value[at] = old + step
            up = quality_cnn.gradients(net, texts, labels)[1]
            value[at] = old - step
            down = quality_cnn.gradients(net, texts, labels)[1]
            value[at] = old
            assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.05, abs=2e-3), (name, at)


def test_the_end_of_a_long_text_counts():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, 5).astype(np.uint8)) for _ in range(200)]
    def text(n, extra=b""):
        return b" ".join(words[i] for i in rng.integers(0, 200, n)) + extra
    texts = [text(40, b"" if i % 2 else b" #%$&" * 20) for i in range(120)]
    net = quality_cnn.train(texts, np.array([i % 2 for i in range(120)], float))
    long = text(20_000)
    clean, junk = net.probabilities([long, long + b" #%$&" * 20_000])
    assert clean > 0.7 and junk < clean - 0.3


def test_samples_are_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(6000)] + [(2, "same")] * 6000
                                 + [(3, None), (None, "x"), (4, "long" * 99)], "id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (2, 1)], "id bigint, label int")
    sample = labelled_sample(docs, labels, 600, most_bytes=100).collect()
    assert 400 < len(sample) < 800 and {r.id for r in sample} <= {1, 2}
    both = labelled_sample(docs, labels, 600, by_label=True).collect()
    assert 400 < len([r for r in both if r.label == 0]) < 800
    assert sorted((r.id, r.text) for r in both if r.label == 1) == [(2, "same"), (4, "long" * 99)]
    assert labelled_sample(docs, labels.limit(0), 600).collect() == []


def slow_places(text):
    """near_second_person and the places of spaced-out words, found from the start each time."""
    T = toxic_features
    lower = T.HIDDEN.sub("", text).lower()
    words = T.TOKEN.findall(lower)
    hits = [i for i, w in enumerate(words) if w in T.CLASS_OF]
    spaced = [len(T.TOKEN.findall(lower, 0, m.start())) for m in T.SPACED.finditer(lower)
              if T.CLASS_OF.get(T.NOT_LETTERS.sub("", m[0])) is not None]
    person = [i for i, w in enumerate(words) if w in T.SECOND_PERSON]
    return sum(min(abs(p - i) for p in person) <= T.NEAR for i in hits + spaced) if person else 0


def test_features_are_linear_in_long_texts_and_equal():
    rng = np.random.default_rng(6)
    stems, near = toxic_features.Stems([]), toxic_features.FEATURES.index("near_second_person")
    parts = ["you", "i d i o t", "@i d i o t", "x!i.d.i.o.t", "idiot", "a", "word", "$", "your", "moron", "s-t-u-p-i-d", "k i l l"]
    for _ in range(300):
        text = " ".join(rng.choice(parts, rng.integers(1, 40)))
        assert toxic_features.features(text, stems)[near] == pytest.approx(np.log1p(slow_places(text)))
    for text in ("you i d i o t word " * 55_000, "you idiot moron " * 65_000):
        begun = time.perf_counter()
        toxic_features.features(text, stems)
        assert time.perf_counter() - begun < 10  # a second or two; hours before
