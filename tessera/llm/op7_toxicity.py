"""Toxicity: a logistic classifier that is regularised by counterfactuals.

Features are the words of a document and runs of GRAM bytes in them, present or not; those that
tell the classes apart best on the labelled sample are kept. The loss adds, for every labelled text
with an identity term, the squared change of the logit when the term is swapped for another of its
group, so that naming a group is not what makes a text toxic.

The fit takes at most SAMPLE_ROWS labelled documents of at most SAMPLE_BYTES together; all documents are
scored, on their whole texts.

Defined results: a null or empty text gets the score of no features; a null doc_id is in no fold
(held_out false, never learned from); without labels of both classes the score is the share of
label 1 (0 without labels); rows that repeat are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.columns import Aside
from tessera.llm.labelled import fold_of, labelled_sample
from tessera.llm.words import lettered_words

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Labelled documents that the fit takes at most, and their bytes; features kept, and the least number of documents with one.
SAMPLE_ROWS, SAMPLE_BYTES, FEATURES, LEAST = 8000, 1 << 28, 2048, 4
GRAMS = (4, 6)
#: Strength of the counterfactual penalty and of the ridge.
SWAP, RIDGE = 1.0, 1e-3

# Identity terms by group, each swapped for the others of its group.
IDENTITY_GROUPS = (
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("female", "male", "nonbinary", "transgender"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("african", "american", "european", "mexican", "chinese", "indian"),
    ("immigrant", "refugee", "native"),
    ("deaf", "blind", "disabled", "autistic"),
    ("frau", "mann", "mädchen", "junge"),
    ("femme", "homme", "fille", "garçon"),
    ("mujer", "hombre", "chica", "chico"),
)


def grams(word: bytes) -> set[bytes]:
    """A word between marks, and its runs of some bytes."""
    marked = b"<" + word + b">"
    return {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


class Features(dict):
    """Kept features of a word, for the words met most recently."""

    def __init__(self, places: dict[bytes, int], most: int = 500_000):
        super().__init__()
        self.places, self.most = places, most

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = tuple(self.places[g] for g in grams(word) if g in self.places)
        return value

    def of(self, words: set[bytes]) -> list[int]:
        return sorted({i for w in words for i in self[w]})


def swaps(words: set[bytes], features: Features, groups=IDENTITY_GROUPS) -> list[tuple[list[int], list[int]]]:
    """Of each identity term of a text and each other term of its group: the features that a swap takes and brings."""
    named = [(term, [o for o in own if o != term]) for group in groups if (own := [t.encode() for t in group]) for term in own if term in words]
    if not named:
        return []
    many = Counter(i for w in words for i in features[w])
    out = []
    for term, others in named:
        alone = {i for i in features[term] if many[i] == 1}
        for other in others:
            out.append((sorted(alone - set(features[other])), sorted(i for i in features[other] if i not in many)))
    return out


def _best_features(sample: DataFrame, keep: int, least: int) -> list[bytes]:
    """The features whose presence differs most between the classes, by chi squared."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for raw, label in zip(batch.column("_raw"), batch.column("_label"), strict=True):
                own: set[bytes] = set()
                for word in set(lettered_words(raw.as_py())):
                    own |= grams(word)
                by[label.as_py()].update(own)
            for label, c in by.items():
                yield pa.record_batch({"gram": pa.array(list(c), pa.binary()), "ones": pa.array([n * label for n in c.values()], pa.int64()), "n": pa.array(list(c.values()), pa.int64())})

    sizes = sample.agg(F.count("*").alias("n"), F.sum("_label").alias("ones")).first()
    n, ones = sizes["n"], sizes["ones"] or 0
    counts = sample.mapInArrow(count, "gram binary, ones long, n long").groupBy("gram").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")).where(F.col("n") >= least)
    if not 0 < ones < n:
        return []
    expected = F.col("n") * (ones / n)
    gain = (F.col("ones") - expected) * (F.col("ones") - expected) / (expected * (1 - ones / n))
    return [bytes(r["gram"]) for r in counts.orderBy(F.desc(gain), "gram").limit(keep).collect()]


class Model:
    def __init__(self, places: dict[bytes, int], weights: np.ndarray, bias: float):
        self.places, self.weights, self.bias = places, weights, bias

    def score(self, features: Features, raw: bytes | None) -> float:
        logit = self.bias + sum(map(self.weights.__getitem__, features.of(set(lettered_words(raw)))))
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The list that each entry stands in, and the entries."""
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()


def fit_weights(own: pa.ListArray, labels: np.ndarray, takes: pa.ListArray, brings: pa.ListArray, width: int, swap: float = SWAP, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam steps on log loss + RIDGE * |w|^2 + swap * mean squared logit change of the swaps.

    own: features of each text; takes, brings: what each swap changes.
    """
    (row, col), (row_a, col_a), (row_b, col_b) = _flat(own), _flat(takes), _flat(brings)
    w, b, n, m = np.zeros(width), float(np.log(labels.mean() / (1 - labels.mean()))), len(own), max(1, len(takes))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        logit = b + np.bincount(row, w[col], n)
        off = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels
        slope = np.bincount(col, off[row], width) / n + 2 * RIDGE * w
        if len(takes):
            change = np.bincount(row_a, w[col_a], m) - np.bincount(row_b, w[col_b], m)
            slope += 2 * swap / m * (np.bincount(col_a, change[row_a], width) - np.bincount(col_b, change[row_b], width))
        all_slopes = np.append(slope, off.mean())
        first = 0.9 * first + 0.1 * all_slopes
        second = 0.99 * second + 0.01 * all_slopes**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(sample: DataFrame, keep: int = FEATURES, groups=IDENTITY_GROUPS, swap: float = SWAP) -> Model:
    """sample: _raw, _label. The numbers of kept features come to the driver, of swaps only what they change."""
    sample = sample.where("_label IS NOT NULL")
    kept = _best_features(sample, keep, LEAST)
    places = {g: i for i, g in enumerate(kept)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(places)
        for batch in batches:
            own, takes, brings = [], [], []
            for raw in batch.column("_raw"):
                words = set(lettered_words(raw.as_py()))
                changed = swaps(words, features, groups)
                own.append(features.of(words))
                takes.append([x for x, _ in changed])
                brings.append([x for _, x in changed])
            lists = pa.list_(pa.list_(pa.int32()))
            yield pa.record_batch({"label": batch.column("_label"), "own": pa.array(own, pa.list_(pa.int32())), "takes": pa.array(takes, lists), "brings": pa.array(brings, lists)})

    rows = sample.mapInArrow(sparse, "label int, own array<int>, takes array<array<int>>, brings array<array<int>>").toArrow().combine_chunks()
    labels = rows.column("label").to_numpy().astype(float)
    share = float(labels.mean()) if len(labels) else 0.0
    if not kept:
        return Model({}, np.zeros(0), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))))
    own, takes, brings = (rows.column(c).combine_chunks() for c in ("own", "takes", "brings"))
    return Model(places, *fit_weights(own, labels, takes.flatten(), brings.flatten(), len(kept), swap))


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with _score."""
    aside = Aside(docs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.places)
        for batch in batches:
            out = {c: batch.column(c) for c in inner}
            out["_score"] = pa.array([model.score(features, x.as_py()) for x in batch.column("_raw")], pa.float64())
            yield pa.RecordBatch.from_pydict(out)

    inner = aside.inner
    schema = T.StructType([*aside.df.schema.fields, T.StructField("_score", T.DoubleType())])
    return aside.back(aside.df.withColumn("_raw", aside(text).cast("binary")).mapInArrow(score, schema), "_score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(labelled_sample(docs, labels, "toxic", SAMPLE_ROWS, FOLDS, HELD_OUT, F.octet_length, SAMPLE_BYTES))
    scored = score_toxicity(docs.select("doc_id", F.col("text").cast("binary").alias("text")), model).select("doc_id", "_score")
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
