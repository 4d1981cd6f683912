"""Cases of the operators that once were lost or refused, against brute force."""

import random

from tessera.llm import op5_licenses, op10_topk


def test_licenses_of_one_shingle(spark):
    """At the start, inside and at the end of documents, and in documents of few words."""
    r = random.Random(12)
    templates = [(f"t{i}", " ".join(f"n{r.randrange(10**6)}" for _ in range(5))) for i in range(100)]

    def filler(n):
        return [f"w{r.randrange(10**6)}" for _ in range(n)]

    rows, want = [], set()
    for name, body in templates:
        for before, after in [(0, 20), (1, 20), (20, 20), (21, 20), (20, 1), (20, 0), (21, 0), (0, 0), (0, 3)] * 5:
            want.add((len(rows), name))
            rows.append((len(rows), " ".join([*filler(before), body, *filler(after)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(x["doc_id"], x["license"]) for x in op5_licenses.scan_licenses(docs, templates).collect()} == want


def test_topk_of_large_and_empty_vectors(spark):
    r = random.Random(13)
    rows = [(i, [r.randrange(-99, 99) / 1.0 for _ in range(4)]) for i in range(60)]
    rows += [(60, [2.0**24] * 4), (61, [2.0**24 - 1, 1.0, 0.0, 2.0**24]), (80, []), (81, []), (83, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = op10_topk.whole_vectors(df, "vec_id", "embedding", 64.0)
    whole = {i: [int(x * 64) for x in v] for i, v in rows}
    want = []
    for q in (x for x in whole if x % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(tuple(x) for x in op10_topk.topk(vectors, vectors.where("_id % 20 = 0")).collect()) == sorted(want)
