"""Exact top-k search by inner product: a KD-tree in each shard.

Components are first turned into integers, floor(scale * x). The vectors are dealt evenly into shards,
which are written once, in the narrowest type that holds them. A shard is searched by trees over runs of
its rows, split at medians of the widest component and with a tight box at every node. A query goes
through a tree best first: of the nodes that it has reached it opens the one whose box allows the largest
inner product, and it stops where that bound is below its kth score, which it takes to the next tree.

Queries are rows too: blocks of them meet the shards in waves, each wave with three times as many shards
as all before it. Every block has begun in another shard, and the kth scores that a wave leaves are what
the next wave's traversals start from. Neither vectors nor queries pass through the driver. Each pair of
a block and a shard is shuffled once; both are large, as what is shuffled grows with the number of pairs.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors
are compared with those of their own length; a null id is no query and no candidate; rows that
repeat an id are candidates of their own, but for the query's own id, and queries of their own, each
with its ranks; an empty table or one vector gives an empty result; vectors without components have
the score 0 with each other; components so large that float64 scores might not be exact are scored as
Python integers, and components or scores beyond a long end the query; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.words import give_back
from tessera.session import materialize

K, SCALE, EVERY = 20, 64.0, 20
#: Queries of a block and rows of a shard aimed at, bytes that a piece of either has at most, queries that go through a
#: tree at once, rows of a tree and of a leaf.
BLOCK, SHARD_ROWS, MOST_BYTES, ASKED, TREE_ROWS, LEAF = 1 << 17, 1 << 17, 1 << 25, 4096, 8192, 128
#: What a task gets of a block of queries and a piece of a shard.
PAIR = ("block", "piece", "asked_kind", "names", "asked", "known", "dims", "kind", "ids", "points")
#: Tasks that a wave is dealt over at most.
WAVE_TASKS = 10_000


class Tree:
    """Median splits of the widest component; nodes have tight boxes, leaves are runs of the ordered rows."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        spans, children, stack = [(0, len(ids))], [(-1, -1)], [0]
        low, high = [None], [None]
        while stack:
            node = stack.pop()
            lo, hi = spans[node]
            own = points[order[lo:hi]]
            low[node], high[node] = own.min(0), own.max(0)
            if hi - lo > leaf:
                axis, middle = int(np.argmax(high[node] - low[node])), (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(own[:, axis], middle)]
                children[node] = len(spans), len(spans) + 1
                stack += children[node]
                spans += [(lo, lo + middle), (lo + middle, hi)]
                children += [(-1, -1)] * 2
                low += [None, None]
                high += [None, None]
        self.ids, self.points, self.spans = ids[order], points[order], spans
        self.children, self.low, self.high = np.array(children), np.array(low), np.array(high)

    def search(self, names: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of (query, id, score) that hold every one of a query's k best that beats or ties kth."""
        best, best_id = no_best(len(names), k)
        self.improve(names, queries, kth.astype(np.float64).copy(), best, best_id, k)
        q, j = np.nonzero(~np.isneginf(best))
        return q, best_id[q, j], best[q, j]

    def improve(self, names: np.ndarray, queries: np.ndarray, kth: np.ndarray, best: np.ndarray, best_id: np.ndarray, k: int) -> None:
        """Put what beats or ties kth among each query's best, and raise kth."""
        # the largest inner product of each query with any point of each node's box
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        reached = np.full(bounds.shape, -np.inf, bounds.dtype)
        reached[:, 0] = bounds[:, 0]
        active = np.arange(len(names))
        while len(active):
            node = reached[active].argmax(1)
            bound = reached[active, node]
            go_on = (bound >= kth[active]) & (bound > -np.inf)
            active, node = active[go_on], node[go_on]
            reached[active, node] = -np.inf
            inner = self.children[node, 0] >= 0
            for side in (0, 1):
                child = self.children[node[inner], side]
                reached[active[inner], child] = bounds[active[inner], child]
            who, leaf = active[~inner], node[~inner]
            by_leaf = np.argsort(leaf, kind="stable")
            for part in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1) if len(leaf) else ():
                self._visit(int(leaf[part[0]]), who[part], names, queries, kth, best, best_id, k)

    def _visit(self, leaf: int, who: np.ndarray, names, queries, kth, best, best_id, k: int) -> None:
        """Put a leaf's points among the best of these queries, as far as they beat or tie kth."""
        lo, hi = self.spans[leaf]
        scores, ids = queries[who] @ self.points[lo:hi].T, self.ids[lo:hi]
        row, col = np.nonzero((scores >= kth[who][:, None]) & (ids != names[who][:, None]))
        if not len(row):
            return
        count = np.bincount(row, minlength=len(who))
        some = np.flatnonzero(count)
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        new, new_id = np.full((len(who), count.max()), -np.inf), np.full((len(who), count.max()), np.iinfo(np.int64).max)
        new[row, place], new_id[row, place] = scores[row, col], ids[col]
        own = who[some]
        both, both_id = np.concatenate([best[own], new[some]], 1), np.concatenate([best_id[own], new_id[some]], 1)
        first = np.lexsort((both_id, -both), axis=1)[:, :k]
        best[own], best_id[own] = np.take_along_axis(both, first, 1), np.take_along_axis(both_id, first, 1)
        kth[own] = np.maximum(kth[own], best[own, -1])


def no_best(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)


def whole_vectors(df: DataFrame, id_col: str, vector: str, scale: float) -> DataFrame:
    """_id, _vector (array of doubles that are integers) and _dims of the rows that take part."""
    values = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    sound = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return df.where(F.col(f"`{vector}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & sound).select(
        F.col(f"`{id_col}`").cast("long").alias("_id"), values.alias("_vector"), F.size(F.col(f"`{vector}`")).alias("_dims")
    )


def _narrow(points: np.ndarray) -> np.ndarray:
    """points, which are integers, in the narrowest type that holds them: they are shuffled once for each pair."""
    low, high = points.min(initial=0), points.max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return points.astype(kind)
    return points


def _packed(rows: DataFrame, number: str, most: int, least: int) -> DataFrame:
    """Each task's rows (_id, _vector, _dims) in pieces of at most `most` rows: number, piece, dims, kind, ids, points.

    A number is below `least`, which is the number of tasks; pieces of one number are told apart.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list] = {}
        task, piece = TaskContext.get().partitionId(), 0

        def out(dims: int, kind: str, rows: list) -> pa.RecordBatch:
            nonlocal piece
            piece += 1
            ids, points = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
            return pa.record_batch({number: pa.array([task], pa.int64()), "piece": pa.array([piece], pa.int64()), "dims": pa.array([dims], pa.int32()), "kind": pa.array([kind]), "ids": pa.array([ids.tobytes()], pa.binary()), "points": pa.array([points.tobytes()], pa.binary())})

        for batch in batches:
            own, vectors = batch.column("_dims").to_numpy(), batch.column("_vector")
            ids = batch.column("_id").to_numpy()
            for dims in np.unique(own).tolist():
                at = np.flatnonzero(own == dims)
                points = _narrow(vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dims))
                kind = points.dtype.str
                bound = max(1, min(most, MOST_BYTES // (points.itemsize * max(1, dims))))
                while len(at):
                    rows = held.setdefault((dims, kind), [])
                    room = bound - sum(len(r[0]) for r in rows)
                    rows.append((ids[at[:room]], points[:room]))
                    if len(at) >= room:
                        yield out(dims, kind, held.pop((dims, kind)))
                    at, points = at[room:], points[room:]
        for (dims, kind), rows in held.items():
            yield out(dims, kind, rows)

    return rows.select("_id", "_vector", "_dims").repartition(least).mapInArrow(pack, f"{number} long, piece long, dims int, kind string, ids binary, points binary")


def topk(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vectors, queries: as whole_vectors gives them. query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    n = vectors.count()
    shards = max(1, min(-(-n // 512), max(spark.sparkContext.defaultParallelism, -(-n // shard_rows))))
    asked_rows = queries.count()
    blocks = max(1, min(-(-asked_rows // 2048), max(2 * spark.sparkContext.defaultParallelism, -(-asked_rows // block))))
    trees = materialize(_packed(vectors, "shard", shard_rows, shards).withColumnRenamed("piece", "tree"), "trees")
    asked = materialize(_packed(queries, "block", block, blocks), "queries")
    best, done = None, 0
    while done < shards:
        wave = min(shards - done, max(1, 3 * done))
        found = _wave(trees, asked, best, k, done, wave, shards, blocks)
        if best is not None:
            found = found.unionByName(best)
        order = Window.partitionBy("block", "piece", "q").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        done += wave
        if done >= shards:
            return ranked.select("query_id", "rank", "vec_id", "score")
        best = materialize(ranked.drop("rank"), "best")


def _wave(trees: DataFrame, asked: DataFrame, best: DataFrame | None, k: int, done: int, wave: int, shards: int, blocks: int) -> DataFrame:
    """block, piece, q, query_id, vec_id, score: what each block finds in `wave` shards after the `done` ones it has seen."""
    if best is None:
        knowing = asked.withColumn("known", F.expr("cast(null as array<struct<q:int,kth:double>>)"))
    else:
        kth = best.groupBy("block", "piece", "q").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where((F.col("n") >= k) & (F.abs("kth") < 2**53))
        known = kth.groupBy(F.col("block").alias("of"), F.col("piece").alias("of_piece")).agg(F.collect_list(F.struct("q", F.col("kth").cast("double").alias("kth"))).alias("known"))
        knowing = asked.hint("merge").join(known, (F.col("block") == F.col("of")) & (F.col("piece") == F.col("of_piece")), "left").drop("of", "of_piece")
    tasks = min(WAVE_TASKS, 2 * wave * blocks)
    turn = F.explode(F.sequence(F.lit(done).cast("long"), F.lit(done + wave - 1).cast("long")))
    dealt = knowing.withColumn("turn", turn).withColumn("to", F.pmod(F.col("block") + F.col("turn"), F.lit(shards)))
    dealt = dealt.select("block", "piece", "to", F.col("dims").alias("of_dims"), F.col("kind").alias("asked_kind"), F.col("ids").alias("names"), F.col("points").alias("asked"), "known")
    # the shard's side of the same pairs
    begun = F.pmod(F.col("shard") - F.col("with"), F.lit(shards))
    copies = trees.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).where((begun >= done) & (begun < done + wave)).select("with", "shard", "dims", "kind", "ids", "points")
    on = (F.col("block") == F.col("with")) & (F.col("to") == F.col("shard")) & (F.col("of_dims") == F.col("dims"))
    # a join by broadcast would bring one side through the driver, whose size is judged by compressed files
    pairs = dealt.repartition(tasks, "block", "to", "of_dims").hint("merge").join(copies.repartition(tasks, "with", "shard", "dims"), on)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                yield from _search_pair({c: batch.column(c)[i] for c in PAIR}, k)

    return pairs.select(*PAIR).mapInArrow(search, "block long, piece long, q int, query_id long, vec_id long, score long")


def _search_pair(row: dict[str, pa.Scalar], k: int) -> Iterator[pa.RecordBatch]:
    """One block of queries in one shard's piece."""
    names, ids = (np.frombuffer(row[c].as_buffer(), np.int64) for c in ("names", "ids"))
    dims = row["dims"].as_py()
    queries, points = (np.frombuffer(row[c].as_buffer(), row[kind].as_py()).reshape(n, dims) for c, kind, n in (("asked", "asked_kind", len(names)), ("points", "kind", len(ids))))
    most = max(abs(float(x)) for part in (queries, points) for x in (part.min(initial=0), part.max(initial=0)))
    if most >= 2**63:
        raise ValueError("components are too large for scores that are longs")
    plain = not dims or most**2 * dims >= 2**53
    kind = np.float32 if most**2 * dims < 2**24 else np.float64
    kth = np.full(len(names), -np.inf)
    if (known := row["known"].values) is not None:
        kth[known.field("q").to_numpy()] = known.field("kth").to_numpy()
    trees = [] if plain else [Tree(ids[at : at + TREE_ROWS], points[at : at + TREE_ROWS].astype(kind)) for at in range(0, len(ids), TREE_ROWS)]
    for at in range(0, len(names), ASKED):
        some, asked = names[at : at + ASKED], queries[at : at + ASKED].astype(np.float64 if plain else kind)
        if plain:
            q, found, score = _plain_search(ids, points, some, asked, k)
        else:
            best, best_id = no_best(len(some), k)
            for tree in trees:
                tree.improve(some, asked, kth[at : at + ASKED], best, best_id, k)
            q, j = np.nonzero(~np.isneginf(best))
            found, score = best_id[q, j], best[q, j].astype(np.int64)
        one = {c: pa.array(np.full(len(q), row[c].as_py()), pa.int64()) for c in ("block", "piece")}
        yield pa.record_batch(one | {"q": pa.array(q + at, pa.int32()), "query_id": pa.array(some[q], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.int64())})
    give_back()


def _plain_search(ids: np.ndarray, points: np.ndarray, names: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The k best of these vectors for each query, by Python integers."""
    whole = np.array([[int(x) for x in row] for row in points], object).reshape(points.shape)
    q, found, score = [], [], []
    for i, (name, query) in enumerate(zip(names.tolist(), queries, strict=True)):
        scores = (whole * np.array([int(x) for x in query], object)).sum(1).tolist()
        for less, vec in heapq.nsmallest(k, ((-int(s), v) for s, v in zip(scores, ids.tolist(), strict=True) if v != name)):
            q.append(i)
            found.append(vec)
            score.append(-less)
    return np.array(q, np.int64), np.array(found, np.int64), score


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", SCALE), "vectors")
    return topk(vectors, vectors.where(F.col("_id") % EVERY == 0))


OP10_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
