"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in chunks (by a hash of the row, so that a retry or another split of the input finds them
again). The number of rows that each chunk sends to each shard is drawn exactly: the chunks are
halved again and again, and what the first half sends to the shards is a multivariate hypergeometric
draw from what both send. One sampler (a ratio of uniforms) serves populations of any size. Each
chunk is permuted by itself and cut by its row of the matrix, the rows are exchanged, and each shard
is permuted again.

The matrix has at most MAX_CHUNKS rows of one count a shard, whatever the input.

Rows that agree in all of `identity` lie in one chunk.

Defined results: a null text has size 16 and a null checksum; a null doc_id hashes as such; rows
that repeat are rows of their own; an empty table gives an empty result; further columns are kept
by shard(), but for ones named shard or slot.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.columns import Aside
from tessera.llm.prefix import KEY_BITS, cell_count, cell_of, running_sums

SHARDS = 40
#: Rows aimed at in a chunk, and the bound on chunks.
CHUNK_ROWS, MAX_CHUNKS = 1024, 1 << 16


#: Sides of the sampler's frame for a curve of variance 1 and what it adds for discrete ones (Stadlober 1990).
_FRAME, _MARGIN = 2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e)


def _stirling_rest(z: np.ndarray) -> np.ndarray:
    """log gamma(z) less (z - 1/2) log z - z + log(2 pi) / 2, for z from 1 up."""
    small = np.array([0.0] + [math.lgamma(k) - (k - 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi) for k in range(1, 16)])
    r = 1 / np.maximum(z, 16)
    series = r / 12 - r**3 / 360 + r**5 / 1260 - r**7 / 1680
    return np.where(z < 16, small[np.minimum(z, 15).astype(np.int64)], series)


def _log_mass(x: np.ndarray, top: np.ndarray, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log of the hypergeometric mass at x over that at top.

    Factorials are compared pairwise, so that nothing large is subtracted: the linear parts of the
    four pairs cancel, and of the logarithms only that of one ratio near 1 is left.
    """
    step = (x - top).astype(float)
    out = np.zeros(len(x))
    ends = []
    for at_x, at_top, sign in ((x, top, 1), (good - x, good - top, -1), (n - x, n - top, -1), (bad - n + x, bad - n + top, 1)):
        z, t = at_x.astype(float) + 1, at_top.astype(float) + 1
        out += _stirling_rest(t) - _stirling_rest(z) - (t - 0.5) * np.log1p(sign * step / t)
        ends.append(z)
    return out - step * np.log((ends[0] / ends[1]) * (ends[3] / ends[2]))


def hypergeometric(draw: np.random.Generator, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many good ones are among n taken from good + bad, for each entry."""
    low, high = np.maximum(0, n - bad), np.minimum(good, n)
    out = low.copy()
    total = (good + bad).astype(float)
    share = np.divide(good, total, out=np.zeros(len(total)), where=total > 0)
    mean = n * share
    spread = np.sqrt(mean * (1 - share) * np.maximum(0, total - n) / np.maximum(1, total - 1) + 0.5)
    top = np.clip(np.floor((n + 1.0) * ((good + 1.0) / (total + 2))).astype(np.int64), low, high)
    left = np.flatnonzero(high > low)
    while len(left):
        u, v = 1 - draw.random(len(left)), draw.random(len(left))
        x = np.floor(mean[left] + 0.5 + (_FRAME * spread[left] + _MARGIN) * (v - 0.5) / u)
        inside = (x >= low[left]) & (x <= high[left])
        at, x = left[inside], x[inside].astype(np.int64)
        taken = 2 * np.log(u[inside]) <= _log_mass(x, top[at], good[at], bad[at], n[at])
        out[at[taken]] = x[taken]
        again = ~inside
        again[inside] = ~taken
        left = left[again]
    return out


def communication_matrix(rows: np.ndarray, capacity: np.ndarray, seed: int) -> np.ndarray:
    """An exact draw of the rows x shards table of counts with these margins under a uniform shuffle."""
    draw = np.random.default_rng(seed)
    levels = max(0, int(len(rows) - 1).bit_length())
    padded = np.zeros(1 << levels, np.int64)
    padded[: len(rows)] = rows
    out = np.asarray(capacity, np.int64)[None]
    for level in range(levels):
        first = padded.reshape(len(out), 2, -1)[:, 0].sum(1)
        halves = np.zeros((len(out), 2, out.shape[1]), np.int64)
        rest, total = first, out.sum(1)
        for j in range(out.shape[1]):
            halves[:, 0, j] = hypergeometric(draw, out[:, j], total - out[:, j], rest)
            rest, total = rest - halves[:, 0, j], total - out[:, j]
        halves[:, 1] = out - halves[:, 0]
        out = halves.reshape(-1, out.shape[1])
    return out[: len(rows)]


def shard(docs: DataFrame, identity: list[str], shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    identity: the columns whose hash stands for a row.
    """
    aside = Aside(docs)
    hashed = aside.df.withColumn("_hash", F.xxhash64(F.lit(seed), *[aside(c) for c in identity]))
    n = docs.count()
    chunks = max(1, min(MAX_CHUNKS, -(-n // CHUNK_ROWS)))
    chunked = hashed.withColumn("_chunk", F.pmod("_hash", F.lit(chunks)).cast("int"))
    counts = np.zeros(chunks, np.int64)
    for row in chunked.groupBy("_chunk").count().collect():
        counts[row["_chunk"]] = row["count"]
    n = int(counts.sum())
    capacity = np.full(shards, n // shards) + (np.arange(shards) < n % shards)
    ends = communication_matrix(counts, capacity, seed).cumsum(axis=1)
    schema = T.StructType([T.StructField("_of_chunk", T.IntegerType()), T.StructField("_ends", T.ArrayType(T.LongType()))])
    matrix = docs.sparkSession.createDataFrame([(i, x) for i, x in enumerate(ends.tolist())], schema)

    local = Window.partitionBy("_chunk").orderBy(F.xxhash64(F.lit("local"), "_hash"), "_hash")
    permuted = chunked.withColumn("_rank", F.row_number().over(local).cast("long") - 1)
    sent = permuted.join(matrix, F.col("_chunk") == F.col("_of_chunk"))
    sent = sent.withColumn("shard", F.size(F.filter("_ends", lambda end: end <= F.col("_rank"))))
    key = F.shiftrightunsigned(F.xxhash64(F.lit("again"), F.lit(seed), "_chunk", "_rank"), 64 - KEY_BITS)
    sent = sent.select(*aside.inner, "shard", "_chunk", "_rank", key.alias("_key"), F.lit(1).cast("long").alias("_one"))
    sent = sent.withColumn("_cell", cell_of(F.col("_key"), cell_count(-(-n // shards))))
    return aside.back(running_sums(sent, "shard", "_cell", ["_key", "_chunk", "_rank"], "_one", ("slot", "_shard_rows")), "shard", "slot")


def with_digest(docs: DataFrame) -> DataFrame:
    """docs with size (bytes of the text, and 16) and text_crc32."""
    raw = F.col("text").cast("binary")
    return docs.withColumn("size", (F.coalesce(F.octet_length(raw), F.lit(0)) + 16).cast("long")).withColumn("text_crc32", F.crc32(raw))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_digest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    out = shard(docs, ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
