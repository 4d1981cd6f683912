"""The corpus queries against their SQL, on the smallest tables, and large families and hot shingles of op 2."""

import glob
import os
import random
import time
from collections import Counter

import duckdb
import pytest

from tessera.llm import op2_jaccard, op10_topk, registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()

    def plain(rows):
        return Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)

    assert plain(map(tuple, df.select(*columns).collect())) == plain(want)


def test_sharding_laws(spark):
    rows = registry.QUERIES["op3_sharding"](spark, SF).collect()
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_large_family(spark):
    """A group of near copies and a passage that many unlike texts share, dealt in parts by their pivots."""
    r = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(12))
    texts = []
    for _ in range(600):
        words = list(base)
        words[r.randrange(60)] = f"e{r.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [passage + " " + " ".join(f"q{r.randrange(10**6)}" for _ in range(6)) for _ in range(200)]
    texts += [texts[650] + " x", texts[0] + " y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for t in texts:
        words = t.split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    want = {i: find(i) for i in range(len(sets))}
    began = time.time()
    got = op2_jaccard.jaccard_components(docs, limits=op2_jaccard.Limits(hot=100, family_rows=64))
    assert {x["doc_id"]: x["component_id"] for x in got.collect()} == want
    assert time.time() - began < 400


def test_repeated_queries(spark):
    """Rows that repeat a query's id are queries of their own, and no candidates of each other."""
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0])] + [(i, [float(i), float(100 - i)]) for i in range(1, 18)]
    vectors = op10_topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding", 64.0)
    got = op10_topk.topk(vectors, vectors.where("_id % 20 = 0"), k=20).collect()
    assert len(got) == 34 and Counter(r["rank"] for r in got) == {i: 2 for i in range(1, 18)}
    assert all(r["vec_id"] != 20 for r in got)
    assert {r["vec_id"] for r in got if r["rank"] == 1} == {17, 1}
