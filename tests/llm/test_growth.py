"""What keeps operators within bounds on large tables, made to happen on small ones."""

import random

import numpy as np
import pyarrow as pa

from tessera.llm import op2_jaccard, op10_topk
from tessera.llm.words import LOWERED, cut_rows


def test_shared_passages_make_no_large_family(spark, monkeypatch):
    """Where the sketch tells nothing, as on a large corpus, texts that share passages still are no family."""
    r = random.Random(3)
    passages = [" ".join(f"p{i}x{j}" for j in range(8)) for i in range(10)]
    texts = []
    for i in range(300):
        parts = [" ".join(f"d{i}x{k}x{r.random()}" for k in range(20)) for _ in range(3)]
        texts.append(" ".join(x for pair in zip(parts, r.sample(passages, 3), strict=True) for x in pair))
    texts.append(texts[7] + " more")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    profiles, link, largest = op2_jaccard._profiles, op2_jaccard._link_families, []

    def watched(members, limits):
        largest.append(max(x["count"] for x in members.groupBy("family").count().collect()))
        return link(members, limits)

    monkeypatch.setattr(op2_jaccard, "_profiles", lambda raw: (profiles(raw)[0], np.full(op2_jaccard.SKETCH, 1000, np.uint64)))
    monkeypatch.setattr(op2_jaccard, "_link_families", watched)
    got = {x["doc_id"]: x["component_id"] for x in op2_jaccard.jaccard_components(docs).collect()}
    assert got == {i: i for i in range(300)} | {300: 7}
    assert largest[0] < 30


def _shuffled(spark):
    """Bytes that were shuffled in this session."""
    store = spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return store.executorSummary("driver").totalShuffleWrite()


def test_shingles_are_shuffled_once(spark, monkeypatch, tmp_path):
    """Postings go through one shuffle; what finds hot shingles and frequent ones sends far less."""
    r = random.Random(5)
    texts = [(i, " ".join(f"w{r.random()}" for _ in range(300))) for i in range(1500)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs, shingles = spark.read.parquet(str(tmp_path / "docs")), 1500 * 296
    profiles = op2_jaccard._profiles
    monkeypatch.setattr(op2_jaccard, "_profiles", lambda raw: (profiles(raw)[0], np.full(op2_jaccard.SKETCH, 1000, np.uint64)))
    before = _shuffled(spark)
    assert all(x["doc_id"] == x["component_id"] for x in op2_jaccard.jaccard_components(docs).collect())
    assert _shuffled(spark) - before < 10 * shingles


def test_frequent_shingles_are_those_of_many_texts(spark):
    """Each shingle that OFTEN sampled texts hold passes, whatever the number of parts and tasks; few others do."""
    r = random.Random(7)
    passages = [" ".join(f"p{i}x{j}" for j in range(9)) for i in range(40)]
    texts = [" ".join([f"a{i} b{i} c{i} d{i} e{i} f{i}", *r.sample(passages, 3)]) for i in range(900)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("cast(text as binary) AS _raw").repartition(5)
    sampled = {bytes(x["_raw"]).decode() for x in docs.where(f"pmod(xxhash64(_raw), {op2_jaccard.SHARE}) = 0").collect()}
    held = {}
    for t in texts:
        w = t.split()
        for s in {tuple(w[i : i + 5]) for i in range(len(w) - 4)}:
            held.setdefault(s, []).append(t in sampled)
    keys = list(held)
    marks = np.concatenate([op2_jaccard.shingle_sets(cut)[0] for cut in cut_rows(pa.array([" ".join(s).encode() for s in keys], pa.binary()), LOWERED)])
    for total in (1, op2_jaccard.SHARE * op2_jaccard.COUNT_ROWS * 50):
        bits = op2_jaccard._frequent(docs, np.array([total]))
        found = op2_jaccard.passes(bits, marks)
        often = np.array([sum(held[s]) >= op2_jaccard.OFTEN for s in keys])
        assert often.any() and found[often].all()
        assert found[~often].mean() < 0.1


def test_topk_packs_narrowly_and_broadcasts_nothing(spark):
    """A component that fits a byte takes one, and no side of a pair goes through the driver."""
    r = np.random.default_rng(11)
    n, dims = 20_000, 32
    df = spark.createDataFrame([(i, x) for i, x in enumerate((r.integers(-60, 60, (n, dims)) / 64).tolist())], "vec_id long, embedding array<double>")
    vectors = op10_topk.materialize(op10_topk.whole_vectors(df, "vec_id", "embedding", 64.0), "vectors")
    packed = op10_topk._packed(vectors, "shard", 3000, 4).collect()
    assert {x["kind"] for x in packed} == {"|i1"} and sum(len(x["points"]) for x in packed) == n * dims
    found = op10_topk.topk(vectors, vectors.where("_id % 20 = 0"))
    assert found.count() == 20 * n // 20
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_pair_is_searched_by_many_trees(monkeypatch):
    """Whatever the rows of a tree, the queries at once and the types, a pair gives what brute force gives."""
    monkeypatch.setattr(op10_topk, "TREE_ROWS", 50)
    monkeypatch.setattr(op10_topk, "ASKED", 7)
    r = np.random.default_rng(13)
    queries, points = r.integers(-128, 128, (30, 5)).astype(np.int8), r.integers(-3000, 3000, (333, 5)).astype(np.int16)
    names, ids = np.arange(30) * 20, r.permutation(333)
    known = pa.array([[{"q": 3, "kth": 0.0}, {"q": 20, "kth": 100_000.0}]], pa.list_(pa.struct([("q", pa.int32()), ("kth", pa.float64())])))
    for kth in (known[0], pa.nulls(1, known.type)[0]):
        row = {"block": pa.scalar(2), "piece": pa.scalar(1), "names": pa.scalar(names.tobytes(), pa.binary()), "ids": pa.scalar(ids.tobytes(), pa.binary()), "asked_kind": pa.scalar(queries.dtype.str), "kind": pa.scalar(points.dtype.str)}
        row |= {"dims": pa.scalar(5), "asked": pa.scalar(queries.tobytes(), pa.binary()), "points": pa.scalar(points.tobytes(), pa.binary()), "known": kth}
        got = {(x["q"], x["query_id"], x["vec_id"], x["score"]) for b in op10_topk._search_pair(row, 20) for x in b.to_pylist()}
        least = {x["q"]: x["kth"] for x in kth.as_py() or ()}
        for q, query in enumerate(queries.astype(np.int64)):
            scored = sorted((-int(s), i) for s, i in zip(points.astype(np.int64) @ query, ids.tolist(), strict=True) if i != names[q])[:20]
            assert {(q, int(names[q]), i, -s) for s, i in scored if -s >= least.get(q, -np.inf)} == {x for x in got if x[0] == q}
