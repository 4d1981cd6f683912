"""The classifiers' queries, samples, penalty and bounds."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import op7_toxicity, op8_quality
from tessera.llm.labelled import labelled_sample


def held(doc_id, folds, out):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Toxic documents hold a marked word, bad ones shouting lines; held-out labels are all wrong."""
    r = random.Random(5)
    path = tmp_path_factory.mktemp("labelled")
    rows, labels = [], []
    for i in range(400):
        toxic, bad = i % 4 == 0, i % 3 == 0
        words = [f"w{r.randrange(150)}" for _ in range(24)]
        if toxic:
            words[3] = r.choice(("badword", "baddest"))
        lines = [" ".join(words[k : k + 8]) + "." for k in (0, 8, 16)] + (["BUY!! NOW!! $$$ " * 4] * 2 if bad else [])
        rows.append((i, "\n".join(lines), "en", "s", 7, i))
        # labels of the held-out folds are wrong: a fit that saw them would be a bad one
        labels.append((i, int(not bad) ^ int(held(i, 3, 1)), int(toxic) ^ int(held(i, 4, 2))))
    rows += [(None, "badword", None, None, 1, 0), (900, None, None, None, 1, 0), (901, "", None, None, 1, 0), (5, "repeated id", None, None, 1, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int, held_out int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.mark.parametrize("query, folds, out, threshold, truth", [
    (op7_toxicity.op7_toxicity, 4, 2, 0.3, lambda i: i % 4 == 0),
    (op8_quality.op8_quality, 3, 1, 0.5, lambda i: i % 3 != 0),
])
def test_queries(spark, folder, query, folds, out, threshold, truth):
    got = query(spark, folder).collect()
    assert len(got) == 404
    for r in got:
        assert r["held_out"] == held(r["doc_id"], folds, out)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    right = [r["predicted"] == int(truth(r["doc_id"])) for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and r["doc_id"] != 5]
    assert sum(right) / len(right) > 0.97


def test_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_score", F.lit("x")).withColumn("_raw", F.lit("y"))
    model = op7_toxicity.train(spark.createDataFrame([], "_raw binary, _label int"))
    out = op7_toxicity.score_toxicity(docs, model)
    assert out.count() == docs.count() and dict(out.dtypes)["_score"] == "double" and out.first()["_raw"] == "y"


def test_sample_is_bounded(spark):
    """Very many rows of one id count as one, and the costs of all sum to the bound at most."""
    docs = spark.createDataFrame([(1, f"text {i % 50}") for i in range(8000)] + [(i, "x" * 10 * i) for i in range(2, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)] + [(1, 1), (7, None), (8, 3), (None, 1)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "quality", 40, 3, 1, F.octet_length, 4000).collect()
    assert 5 < len(got) <= 40 and sum(len(r["_raw"]) for r in got) <= 4000
    assert sum(bytes(r["_raw"]).startswith(b"text") for r in got) <= 1


def test_penalty_closes_the_gap(spark):
    """An identity term that goes with toxic labels raises scores without the penalty, and hardly with it."""
    r = random.Random(8)
    rows = []
    for i in range(400):
        words = [f"w{r.randrange(200)}" for _ in range(30)]
        if i % 4 == 0:
            words[5] = r.choice(("badword", "baddest"))
        if i % 4 == 0 and i % 8 == 0 or i % 16 == 1:
            words[7] = "woman"
        rows.append((" ".join(words).encode(), int(i % 4 == 0)))
    sample = spark.createDataFrame(rows, "_raw binary, _label int")

    def gap(swap):
        model = op7_toxicity.train(sample, swap=swap)
        features = op7_toxicity.Features(model.places)
        logit = [sum(model.weights[i] for i in features.of({t, b"w1", b"w2"})) for t in (b"woman", b"man")]
        return abs(logit[0] - logit[1])

    assert gap(0.0) > 1 and gap(op7_toxicity.SWAP) < 0.25 * gap(0.0)


def test_swaps_are_differences():
    places = {g: i for i, g in enumerate(sorted({g for w in (b"woman", b"man", b"girl", b"boy", b"manly") for g in op7_toxicity.grams(w)}))}
    features = op7_toxicity.Features(places)
    words = {b"woman", b"manly", b"other"}
    found = op7_toxicity.swaps(words, features, (("woman", "man", "girl"),))
    own = set(features.of(words))
    want = []
    for other in (b"man", b"girl"):
        new = set(features.of((words - {b"woman"}) | {other}))
        want.append((sorted(own - new), sorted(new - own)))
    assert found == want


def test_fit_goes_downhill():
    """The slopes that the fit follows are those of its loss: at its end no small step gains much."""
    r = np.random.default_rng(2)
    rows = [sorted(r.choice(12, 4, replace=False).tolist()) for _ in range(80)]
    labels = np.array([float(0 in x or r.random() < 0.2) for x in rows])
    takes, brings = [[1], [2, 3]], [[4], []]
    lists = [pa.array(x, pa.list_(pa.int32())) for x in (rows, takes, brings)]
    w, b = op7_toxicity.fit_weights(lists[0], labels, lists[1], lists[2], 12, rounds=2000)

    def loss(w, b):
        logit = np.array([b + w[x].sum() for x in rows])
        change = np.array([w[t].sum() - w[s].sum() for t, s in zip(takes, brings)])
        return np.mean(np.logaddexp(0, logit) - labels * logit) + op7_toxicity.RIDGE * (w**2).sum() + op7_toxicity.SWAP * np.mean(change**2)

    best = loss(w, b)
    for _ in range(100):
        assert loss(w + r.normal(size=12) * 0.01, b + r.normal() * 0.01) > best - 1e-4


def test_long_texts(spark):
    """A text of a million lines is scored whole, and one beyond the bound is passed over by the sample."""
    good, bad = "plain words that make a line.", "BUY!! NOW!! $$$"
    rows = [(("\n".join([good] * 4) if i % 2 else "\n".join([bad] * 4)).encode(), i % 2) for i in range(60)] + [("\n".join([good] * 3000).encode(), 1), ("\n".join([bad] * 3000).encode(), 0)]
    field = op8_quality.train(spark.createDataFrame(rows, "_raw binary, _label int"))
    long = "\n".join([bad] * 1_000_000)
    docs = spark.createDataFrame([(1, long), (2, "\n".join([good] * 100_000))], "doc_id long, text string")
    got = {r["doc_id"]: r["_score"] for r in op8_quality.score_quality(docs, field).select("doc_id", "_score").collect()}
    assert got[1] < 0.5 < got[2]
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    sample = labelled_sample(docs.unionByName(spark.createDataFrame([(3, good)], "doc_id long, text string")), labels, "quality", 10, 3, 7, op8_quality._line_count, op8_quality.SAMPLE_LINES)
    assert sorted(len(r["_raw"]) for r in sample.collect()) == [len(good), 100_000 * (len(good) + 1) - 1]
