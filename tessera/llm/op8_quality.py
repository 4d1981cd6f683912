"""Quality: a linear-chain conditional random field labels every line of a document good or bad.

A line's features are its own shape and the mean shape of its neighbours. The field is fitted on
documents whose lines start with the document's label; then, in bad documents, lines that the field
finds good are relabelled (some line stays bad), and it is fitted again. A document's quality is
the mean of its lines' forward-backward marginals, weighted by length, put through a logistic curve
that is fitted to the documents' labels.

The fit takes at most SAMPLE_ROWS labelled documents of at most SAMPLE_LINES lines together, in chains of
at most CHAIN lines; all documents are scored, on their whole texts, and as whole chains.

Defined results: a null text, or one without a line that is not blank, scores as one empty line;
a null doc_id is in no fold (held_out false, never learned from); without labels of both classes the
score is the share of label 1 (1 without labels, so that nothing is rejected); rows that repeat are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.columns import Aside
from tessera.llm.labelled import fold_of, labelled_sample

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.5
#: Labelled documents that the fit takes at most, their lines, and the lines that the fit takes as one chain.
SAMPLE_ROWS, SAMPLE_LINES, CHAIN = 3000, 400_000, 512
#: Rounds of relabelling, gradient steps in each, and the ridge.
ROUNDS, STEPS, RIDGE = 3, 60, 1e-3

_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_DIGITS = bytes(range(0x30, 0x3A))
_PLAIN = _LETTERS + _DIGITS + b" \t\r.,"
_ENDS = (b".", b"!", b"?", b":", b";")
SHAPES = 10


def line_shape(line: bytes) -> tuple[float, ...]:
    """What a line looks like, in numbers from 0 to about 1."""
    n = len(line) or 1
    words = line.split()
    k = len(words) or 1
    odd = line.translate(None, _PLAIN)
    letters = n - len(line.translate(None, _LETTERS))
    same = sum(map(bytes.__eq__, words[1:], words)) if len(set(words)) < len(words) else 0
    return (
        len(odd) / n,
        len(set(odd)) / 8,
        (n - len(line.translate(None, _UPPER))) / (letters or 1),
        (n - len(line.translate(None, _DIGITS))) / n,
        len(set(words)) / k,
        same / k,
        min(n / k, 20) / 10,
        min(k, 60) / 60,
        float(line.rstrip().endswith(_ENDS)),
        float(line[:1] in _ENDS or line[:1] in (b"|", b"-", b"*")),
    )


def lines_of(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of the lines that are not blank."""
    lines = [x for x in (raw or b"").split(b"\n") if x and not x.isspace()] or [b""]
    shape = np.array([line_shape(x) for x in lines])
    sums = np.zeros_like(shape)
    sums[1:] += shape[:-1]
    sums[:-1] += shape[1:]
    sides = np.zeros(len(lines))
    sides[1:] += 1
    sides[:-1] += 1
    around = sums / np.maximum(sides, 1)[:, None]
    features = np.hstack([shape, shape**0.5, around, np.minimum(sides, 1)[:, None], np.ones((len(lines), 1))])
    return features, np.array([len(x) + 1 for x in lines], float)


class Field:
    """A chain of two labels (0 bad, 1 good): weights of label 1 by feature, and of pairs of labels."""

    def __init__(self, width: int):
        self.weights, self.pairs = np.zeros(width), np.zeros((2, 2))
        self.slope, self.offset = 1.0, 0.0

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """How likely each line of one document is good."""
        tilt = np.clip(features @ self.weights, -30, 30).tolist()
        n = len(tilt)
        (a, b), (c, d) = np.exp(self.pairs - self.pairs.max()).tolist()
        ahead = [0.0] * n  # share of label 1 so far
        p0, p1 = 0.5, 0.5
        for i, t in enumerate(tilt):
            up = np.e**t if t < 0 else 1.0
            down = 1.0 if t < 0 else np.e**-t
            q0, q1 = ((p0 * a + p1 * c), (p0 * b + p1 * d)) if i else (0.5, 0.5)
            q0, q1 = q0 * down, q1 * up
            p0, p1 = q0 / (q0 + q1), q1 / (q0 + q1)
            ahead[i] = p1
        out = [0.0] * n
        r0, r1 = 0.5, 0.5
        for i in range(n - 1, -1, -1):
            good, bad = ahead[i] * r1, (1 - ahead[i]) * r0
            out[i] = good / (good + bad)
            t = tilt[i]
            up = r1 * (np.e**t if t < 0 else 1.0)
            down = r0 * (1.0 if t < 0 else np.e**-t)
            r0, r1 = a * down + b * up, c * down + d * up
            r0, r1 = r0 / (r0 + r1), r1 / (r0 + r1)
        return np.array(out)

    def quality(self, features: np.ndarray, lengths: np.ndarray) -> float:
        """The mean marginal, weighted by length."""
        return float(self.marginals(features) @ lengths / lengths.sum())

    def score(self, features: np.ndarray, lengths: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.quality(features, lengths) + self.offset, -40, 40))))


def _expected(field: Field, x: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (documents, lines) and expected pairs of labels of padded documents at once."""
    n, t = real.shape
    tilt = np.clip(x @ field.weights, -30, 30)
    emit = np.exp(np.stack([np.minimum(-tilt, 0), np.minimum(tilt, 0)], 2))
    step = np.exp(field.pairs - field.pairs.max())
    ahead, back = np.full((n, t, 2), 0.5), np.full((n, t, 2), 0.5)
    now = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
    ahead[:, 0] = now
    for i in range(1, t):
        new = (now @ step) * emit[:, i]
        now = np.where(real[:, i, None], new / new.sum(1, keepdims=True), now)
        ahead[:, i] = now
    now = np.full((n, 2), 0.5)
    for i in range(t - 2, -1, -1):
        new = (now * emit[:, i + 1]) @ step.T
        now = np.where(real[:, i + 1, None], new / new.sum(1, keepdims=True), 0.5)
        back[:, i] = now
    both = ahead * back
    marginal = both[..., 1] / both.sum(2)
    joint = ahead[:, :-1, :, None] * step[None, None] * (emit[:, 1:] * back[:, 1:])[:, :, None, :]
    joint /= joint.sum((2, 3), keepdims=True)
    return marginal, (joint * real[:, 1:, None, None]).sum((0, 1))


def fit_field(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = ROUNDS, steps: int = STEPS) -> Field:
    """docs: features and lengths of each document's lines; labels: of the documents."""
    width = docs[0][0].shape[1]
    field = Field(width)
    lines = [np.full(len(x), y, float) for (x, _), y in zip(docs, labels, strict=True)]
    pieces = [(i, at, min(at + CHAIN, len(x))) for i, (x, _) in enumerate(docs) for at in range(0, len(x), CHAIN)]
    pieces.sort(key=lambda p: p[2] - p[1])
    of = np.array([i for i, _, _ in pieces])
    # pieces of like length are padded together
    padded = []
    for g in np.array_split(np.arange(len(pieces)), max(1, min(12, len(pieces)))):
        t = max(pieces[i][2] - pieces[i][1] for i in g)
        x, real = np.zeros((len(g), t, width), np.float32), np.zeros((len(g), t), bool)
        for k, (i, lo, hi) in enumerate(pieces[j] for j in g):
            x[k, : hi - lo], real[k, : hi - lo] = docs[i][0][lo:hi], True
        padded.append((g, x, real))
    total = sum(len(x) for x, _ in docs)
    balance = len(labels) / (2 * np.maximum(1, np.bincount(labels.astype(int), minlength=2)))
    for turn in range(rounds):
        first, second = np.zeros(width + 4), np.zeros(width + 4)
        for step in range(1, steps + 1):
            slope_w, slope_p = 2 * RIDGE * field.weights, 2 * RIDGE * field.pairs
            for g, x, real in padded:
                for y in (0, 1):
                    own = labels[of[g]] == y
                    if not own.any():
                        continue
                    z, r = x[own], real[own]
                    marginal, joint = _expected(field, z, r)
                    truth = np.zeros(r.shape)
                    for k, (i, lo, hi) in enumerate(pieces[j] for j in g[own]):
                        truth[k, : hi - lo] = lines[i][lo:hi]
                    off = np.where(r, marginal - truth, 0)
                    seen = np.zeros((2, 2))
                    now, nxt = truth[:, :-1].astype(int), truth[:, 1:].astype(int)
                    np.add.at(seen, (now[r[:, 1:]], nxt[r[:, 1:]]), 1)
                    slope_w = slope_w + balance[y] * np.einsum("nt,ntf->f", off, z) / total
                    slope_p = slope_p + balance[y] * (joint - seen) / total
            slope = np.append(slope_w, slope_p.ravel())
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            move = 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
            field.weights, field.pairs = field.weights - move[:-4], field.pairs - move[-4:].reshape(2, 2)
        if turn + 1 < rounds:
            for i in np.flatnonzero(labels == 0):
                marginal = field.marginals(docs[i][0])
                lines[i] = (marginal > 0.5).astype(float)
                lines[i][np.argmin(marginal)] = 0
    quality = np.array([field.quality(x, n) for x, n in docs])
    field.slope, field.offset = _logistic(quality, labels)
    return field


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve from x to y, by Newton steps with a small ridge."""
    w = np.zeros(2)
    a = np.stack([x, np.ones(len(x))], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        slope = a.T @ (p - y) + 1e-2 * w
        bend = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(bend, slope)
    return float(w[0]), float(w[1])


def train(sample: DataFrame) -> Field:
    """sample: _raw, _label; its line features come to the driver."""

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [lines_of(x.as_py()) for x in batch.column("_raw")]
            yield pa.record_batch({"label": batch.column("_label"), "features": pa.array([f.astype(np.float32).tobytes() for f, _ in both], pa.binary()), "lengths": pa.array([n.tobytes() for _, n in both], pa.binary())})

    rows = sample.mapInArrow(shapes, "label int, features binary, lengths binary").toArrow()
    labels = rows.column("label").to_numpy().astype(float)
    docs = []
    for raw, size in zip(rows.column("features"), rows.column("lengths"), strict=True):
        lengths = np.frombuffer(size.as_buffer(), np.float64)
        docs.append((np.frombuffer(raw.as_buffer(), np.float32).reshape(len(lengths), -1), lengths))
    if len({*labels.tolist()}) < 2:
        field = Field(3 * SHAPES + 2)
        share = float(labels.mean()) if len(labels) else 1.0
        field.slope, field.offset = 0.0, float(np.log(max(share, 1e-12) / max(1 - share, 1e-12)))
        return field
    return fit_field(docs, labels)


def score_quality(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """docs with _score."""
    aside = Aside(docs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: batch.column(c) for c in inner}
            out["_score"] = pa.array([field.score(*lines_of(x.as_py())) for x in batch.column("_raw")], pa.float64())
            yield pa.RecordBatch.from_pydict(out)

    inner = aside.inner
    schema = T.StructType([*aside.df.schema.fields, T.StructField("_score", T.DoubleType())])
    return aside.back(aside.df.withColumn("_raw", aside(text).cast("binary")).mapInArrow(score, schema), "_score")


def _line_count(raw: Column) -> Column:
    return F.regexp_count(raw.cast("string"), F.lit("\n")) + 1


def quality_field(docs: DataFrame, labels: DataFrame) -> Field:
    return train(labelled_sample(docs, labels, "quality", SAMPLE_ROWS, FOLDS, HELD_OUT, _line_count, SAMPLE_LINES))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    field = quality_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, field).select("doc_id", "_score")
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
