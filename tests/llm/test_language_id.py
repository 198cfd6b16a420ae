from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import types as T

from matchlytics.llm.common import on_workers
from matchlytics.llm.language_id import SPAN, Network, identify, languages, sample_windows, train
from matchlytics.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType()), T.StructField("c0", T.StringType())])


def docs(spark, rows):
    on_workers(spark)
    return spark.createDataFrame([(*r, "old", "mine") for r in rows], SCHEMA).repartition(3)


def any_network(seed=1, hidden=3):
    network = Network.start(["a", "b", "c"], hidden)
    rng = np.random.default_rng(seed)
    return Network(network.langs, *[w.astype(float) + rng.normal(0, 0.5, w.shape) for w in network.weights()])


def plain_pooled(network, text):
    """Byte by byte in Python's numbers."""
    s = lambda x: x / (1 + abs(x))
    hidden, langs = network.state.shape[2], len(network.langs)
    sums = [0.0] * langs
    for at in range(0, len(text), SPAN):
        part = text[at : at + SPAN]
        outs = [[0.0] * langs for _ in part]
        for way in range(2):
            h = [0.0] * hidden
            for t in range(len(part)) if way == 0 else range(len(part) - 1, -1, -1):
                a = [network.byte[way][i][part[t]] + network.bias[way][i] for i in range(3 * hidden)]
                g = [sum(network.state[way][i][j] * h[j] for j in range(hidden)) for i in range(3 * hidden)]
                z = [(1 + s(a[i] + g[i])) / 2 for i in range(hidden)]
                r = [(1 + s(a[i] + g[i])) / 2 for i in range(hidden, 2 * hidden)]
                n = [s(a[2 * hidden + i] + r[i] * g[2 * hidden + i]) for i in range(hidden)]
                h = [n[i] + z[i] * (h[i] - n[i]) for i in range(hidden)]
                for k in range(langs):
                    outs[t][k] += sum(network.out[way][k][j] * h[j] for j in range(hidden))
        for o in outs:
            e = [np.exp(x + b) for x, b in zip(o, network.base)]
            sums = [x + y / sum(e) for x, y in zip(sums, e)]
    return [x / len(text) for x in sums]


def test_pooled_and_labels_equal_plain_loops():
    network = any_network()
    texts = [b"abc", b"", b"x" * SPAN, bytes(range(256)), b"ab" * 90 + b"\n", b"q"]
    got = network.pooled(texts)
    for text, p in zip(texts, got):
        assert np.allclose(p, plain_pooled(network, text) if text else 0, atol=1e-5)
        labels = network.label_text(text)
        assert labels.shape == (len(text), 3) and (not text or np.allclose(labels.mean(0), p, atol=1e-5))


def test_gradient_equals_differences():
    network, rng = any_network(2), np.random.default_rng(0)
    windows, sizes, label = rng.integers(97, 102, (9, 5)).astype(np.uint8), np.array([9, 9, 4, 1, 7]), np.array([0, 1, 2, 0, 1])
    _, gradient = network.gradient(windows, sizes, label)
    values = network.packed()
    for i in rng.choice(np.flatnonzero(gradient), 60):
        step = np.zeros_like(values)
        step[i] = 1e-5
        slope = (network.unpacked(values + step).gradient(windows, sizes, label)[0] - network.unpacked(values - step).gradient(windows, sizes, label)[0]) / 2e-5
        assert abs(slope - gradient[i]) < 1e-6 + 1e-4 * abs(slope)


def test_held_out_accuracy(spark):
    got = QUERIES["op12_language_id"](spark, MEDIUM).toPandas().set_index("doc_id")
    rows = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    held = [r for r in rows if crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(got.loc[r.doc_id].held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    for lang in sorted({r.lang for r in held}):  # for each language, so that a constant answer fails
        assert np.mean([got.loc[r.doc_id].lang_pred == lang for r in held if r.lang == lang]) >= 0.95


WORDS = {"aa": "lorem ipsum dolor sit amet ", "bb": "der die das und nicht wir "}


def test_odd_rows(spark):
    rows = [(k, WORDS[x] * 8, x) for k in range(40) for x in WORDS]
    odd = [(100, None, "aa"), (101, "", None), (102, "12 ²½ 34_ !", "bb"), (103, "é", None), (104, WORDS["bb"] * 20_000, None), (None, WORDS["aa"] * 4, None), (105, WORDS["aa"], None), (105, WORDS["aa"], None)]
    table = docs(spark, rows + odd)
    network = train(table.where("doc_id < 50"), rounds=6)
    assert network.langs == sorted(WORDS)
    got = identify(table, network)
    assert got.columns == ["doc_id", "text", "lang", "c0", "lang_pred", "score"]
    found = {(r.doc_id, r.text): r for r in got.collect()}
    assert got.count() == len(rows) + len(odd) and all(r.c0 == "mine" for r in found.values())
    assert [(found[i, t].lang_pred, found[i, t].score) for i, t, _ in odd[:3]] == [("und", 0.0)] * 3
    assert found[103, "é"].lang_pred in WORDS
    assert [found[i, t].lang_pred for i, t, _ in odd[4:]] == ["bb", "aa", "aa", "aa"]


@pytest.mark.parametrize("rows, pred", [([], set()), ([(1, None, "aa"), (2, "words", None)], {"und"}), ([(1, "words", "aa"), (2, "some", None)], {"aa"}), ([(1, "words", ""), (2, "some", None)], {""})])
def test_little_to_learn_from(spark, rows, pred):
    got = languages(docs(spark, rows), crc_any()).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} == pred


def crc_any():
    from pyspark.sql import functions as F

    return F.lit(True)


def test_sample_is_bounded_and_covers_whole_texts(spark):
    long = "".join(chr(97 + k % 26) * SPAN for k in range(200))
    rows = [(k, long, "aa") for k in range(300)] + [(1000 + k, f"number {k}", "bb") for k in range(3)] + [(7, "same", "cc")] * 50
    windows, langs = sample_windows(docs(spark, rows), "text", "lang", 20, 5, 4)
    found = windows.toPandas()
    assert langs == ["aa", "bb", "cc"] and found.groupby("label").size().to_dict() == {0: 100, 1: 3, 2: 20}
    first = found[(found.label == 0) & (found["rank"] == found[found.label == 0]["rank"].min())].window
    assert {chr(w[0]) for w in first} == {long[int(j * 200 / 5) * SPAN] for j in range(5)}
