"""Each operator on small tables, against brute force; nulls, empty and repeated rows, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import op1_mixing, op2_jaccard, op3_sharding, op4_urls, op5_licenses, op6_substrings, op7_toxicity, op8_quality, op9_decontaminate, op10_topk
from tessera.llm.fmindex import FMIndex, suffix_order

DOCS = "doc_id long, text string, source string, _key string, size string, rank int"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lettered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(seed=1, n=40):
    """Texts with copies, near copies, shared passages, empty, short and null ones."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Über", "ÇA", "A.B", "x\u00a0y"]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.choice([3, 8, 40, 120, 300]))) for _ in range(n)]
    texts += [texts[3], texts[3], texts[4].upper(), "", None, " \t\n", "one", "one", "a a a a a " * 30]
    for i in (2, 5, 9, 11):
        words = spaced(texts[i])
        if len(words) > 20:
            words[len(words) // 2] = "edited"
            texts.append(" ".join(words))
        texts.append(f"start {i} {passage} end {texts[i]}")
    return texts


def frame(spark, texts, ids=None):
    sources = ["b", "a", None, "ü", "b", "b"]
    rows = [(i if ids is None else ids[i], t, sources[i % 6], "k", "s", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_mix(spark):
    texts = corpus()
    docs = frame(spark, texts)
    got = op1_mixing.mix(docs).collect()
    assert len(got) == len(texts) and all(r["_size"] == len(spaced(texts[r["doc_id"]])) for r in got)
    sizes = Counter()
    for r in got:
        sizes[r["source"]] += r["_size"]
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    low, high = 0.0, 1e9
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(min(3 * sizes[s], middle * weight[s]) for s in order) < sum(sizes.values()) else (low, middle)
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert own[0]["_target"] == pytest.approx(min(3 * sizes[s], high * weight[s]), rel=1e-9)
        assert abs(sum(r["_taken"] for r in own) - own[0]["_target"]) <= 0.5
        assert all(0 <= r["_taken"] <= 3 * r["_size"] for r in own)
    again = op1_mixing.mix(docs.repartition(3, "text")).collect()
    assert sorted((r["doc_id"], r["_taken"]) for r in got) == sorted((r["doc_id"], r["_taken"]) for r in again)
    copies = {r["doc_id"]: r["_copies"] for r in got if r["_copies"]}
    assert Counter(r["doc_id"] for r in op1_mixing.mixed(docs).collect()) == copies
    assert op1_mixing.mixed(docs).columns == docs.columns
    assert op1_mixing.mix(docs.limit(0)).count() == 0


def test_jaccard(spark):
    texts = corpus(2)
    sets = []
    for t in texts:
        words = spaced(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    want = sorted((i, len(s), find(i)) for i, s in enumerate(sets))
    small = op2_jaccard.Limits(paired=2, postings=50, hot=1 << 16)
    for limits in (op2_jaccard.Limits(), small, op2_jaccard.Limits(paired=1, hot=2, family_rows=1)):
        got = op2_jaccard.jaccard_components(frame(spark, texts), limits=limits)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert op2_jaccard.jaccard_components(frame(spark, texts).limit(0)).count() == 0
    nulls = frame(spark, ["a b c d e f"] * 3, [None, 7, 9])
    assert {(r[0], r[2]) for r in op2_jaccard.jaccard_components(nulls).collect()} == {(None, 7), (7, 7), (9, 7)}


def test_jaccard_blocks_and_trees():
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for _ in range(150):
        own = base.copy()
        at = r.integers(0, 300, 30)
        own[at] = r.integers(0, 2**63, 30).astype(np.uint64)
        sets.append(np.unique(own[: r.integers(200, 300)]))
    sets += [np.unique(r.integers(0, 2**63, 250).astype(np.uint64)) for _ in range(30)]
    got = op2_jaccard.join_family(sets)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert got == [find(i) for i in range(len(sets))]


def test_shards(spark):
    texts = corpus(4, 300)
    docs = op3_sharding.with_digest(frame(spark, texts).drop("size"))
    for r in docs.collect():
        raw = None if r["text"] is None else r["text"].encode()
        assert r["size"] == 16 + len(raw or b"") and r["text_crc32"] == (None if raw is None else zlib.crc32(raw))
    got = op3_sharding.shard(docs, ["doc_id", "size", "text_crc32"], shards=7).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    counts = Counter(r["shard"] for r in got)
    assert len(counts) == 7 and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert op3_sharding.shard(docs.limit(0), ["doc_id"]).count() == 0
    matrix = op3_sharding.communication_matrix(np.array([5, 0, 9, 6]), np.array([7, 7, 6]), 1)
    assert matrix.sum(1).tolist() == [5, 0, 9, 6] and matrix.sum(0).tolist() == [7, 7, 6]


def test_urls(spark):
    cases = {
        "https://WWW.Example.org/es/1": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x=/es/": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "http://a.com": ("a.com", "", None, "allow"),
        "http://a.net/x": ("a.net", "/x", None, "allow"),
        "org/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "x://?q=http://a.com/de/": ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(cases)], "page_id long, url string, host string, verdict string")
    got = op4_urls.filter_urls(df.unionByName(df)).orderBy("page_id").collect()
    assert [tuple(r)[4:] for r in got[::2]] == list(cases.values()) and len(got) == 2 * len(cases)
    assert op4_urls.filter_urls(df.limit(0)).count() == 0


def test_licenses(spark):
    """Against brute force, with notices whole, cut, changed and spread over parts and passes."""
    r = random.Random(10)

    def shingles(text):
        words = lettered(text)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    def filler(n):
        return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))

    texts = ["licensed under cc by-nc 4 0", "", None, "Released under the MIT", filler(500), "Released under the MIT License."]
    for _, body in op5_licenses.TEMPLATES:
        words = body.split()
        texts += [f"{filler(50)} {body} {filler(50)}", " ".join(words[: len(words) * 9 // 10]), " ".join(words[: len(words) // 2]), " ".join(w if r.random() < 0.97 else "other" for w in words)]
    texts += [texts[0], " ".join(body for _, body in op5_licenses.TEMPLATES)]
    want = set()
    for i, t in enumerate(texts):
        for name, body in op5_licenses.TEMPLATES:
            both = len(shingles(t) & shingles(body))
            if both >= 0.75 * len(shingles(body)):
                want.add((i, name, both, len(shingles(body))))
    docs = frame(spark, texts)
    for how in ({}, {"block": 60, "part": 7}):
        assert {tuple(x) for x in op5_licenses.scan_licenses(docs, **how).collect()} == want
    assert op5_licenses.scan_licenses(docs.limit(0)).count() == 0


def test_substrings(spark):
    texts = corpus(5)
    windows = Counter()
    for t in texts:
        words = spaced(t)
        windows.update(tuple(words[i : i + 35]) for i in range(len(words) - 34))
    want = []
    for i, t in enumerate(texts):
        words = spaced(t)
        gone = set()
        for k in range(len(words) - 34):
            if windows[tuple(words[k : k + 35])] > 1:
                gone |= set(range(k, k + 35))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        want.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    for hot in (op6_substrings.HOT, 2):
        got = op6_substrings.repeated_words(frame(spark, texts), hot=hot)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert op6_substrings.repeated_words(frame(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_shard_search(seed):
    r = random.Random(seed)
    vocabulary = r.choice([1, 2, 5, 50])
    docs = [[r.randrange(vocabulary) for _ in range(r.randint(20, 250))] for _ in range(4)]
    for _ in range(3):
        a, b = r.choice(docs), r.choice(docs)
        i = r.randrange(len(a))
        b[r.randrange(len(b)) : 0] = a[i : i + r.randint(30, 90)]
    texts = [np.array(d, np.uint64).view(np.uint8).reshape(-1, 8)[:, : op6_substrings.WORD_BYTES].tobytes() for d in docs]
    many = [texts.count(t) for t in texts]
    got = [np.zeros(len(d), bool) for d in docs]
    for q, low, high in zip(*op6_substrings.search_shard(texts, many), strict=True):
        got[q][low:high] = True
    counts = Counter(tuple(d[i : i + 35]) for d in docs for i in range(len(d) - 34))
    for d, g in zip(docs, got, strict=True):
        want = np.zeros(len(d), bool)
        for i in range(len(d) - 34):
            if counts[tuple(d[i : i + 35])] > 1:
                want[i : i + 35] = True
        assert (want == g).all()


def test_fm_index():
    text = np.array([2, 3, 2, 3, 1, 3, 2, 2, 3, 1])
    order, _ = suffix_order(np.append(text, 0))
    assert [tuple(np.append(text, 0)[i:]) for i in order] == sorted(tuple(np.append(text, 0)[i:]) for i in range(11))
    index = FMIndex(text, 4)
    low, high = np.array([0]), np.array([index.n])
    for c in (3, 2):
        low, high = index.step(np.array([c]), low, high)
    assert high[0] - low[0] == 3  # 2 3 occurs three times


def test_decontaminate(spark):
    texts = corpus(6)
    items = [(1, " ".join(lettered(texts[2])[:12])), (2, "one"), (3, ""), (4, None), (10, " ".join(lettered(texts[5])[3:15]).upper()), (None, "one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for name, t in items:
        words = lettered(t)
        k = min(8, len(words))
        for i in range(len(words) - k + 1 if words and name is not None else 0):
            windows.setdefault(tuple(words[i : i + k]), set()).add(str(name))
    want = {}
    for i, t in enumerate(texts):
        words, hit, found = lettered(t), set(), set()
        for w, names in windows.items():
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    found |= names
        want[i] = (len(words), len(hit), sorted(found))
    docs = frame(spark, texts)
    for block, segment in ((op9_decontaminate.BLOCK_WORDS, op9_decontaminate.SEGMENT), (5, 500)):
        got = op9_decontaminate.decontaminate(docs, benchmark, block_words=block, segment=segment).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got} == want and len(got) == len(texts)
        assert all(r["contaminated"] == (len(r["items"]) >= 2) and r["n_near"] == 0 for r in got)
    assert op9_decontaminate.decontaminate(docs.limit(0), benchmark).count() == 0
    assert op9_decontaminate.decontaminate(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_proximity(spark):
    """Exact and near matches; a near one may begin before the place where its window would."""
    texts = ["a b c d x e f g h", "a b c d e f g h", "a x x x b c d e f g h", "b a c d e f g h", "a b c d", "e f g h", "b a c d e f g h a b c d e f g h"]
    one = spark.createDataFrame([(1, "a b c d e f g h"), (2, "q r")], "item_id long, text string")
    got = op9_decontaminate.decontaminate(frame(spark, texts), one, slop=1).orderBy("doc_id").collect()
    assert [(r["n_items"], r["n_near"], r["n_hit"]) for r in got] == [(0, 1, 0), (1, 0, 8), (0, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 0), (1, 0, 8)]
    index = op9_decontaminate.build_index(frame(spark, texts))
    spans = {(r["begin"], r["end"], r["exact"]) for r in op9_decontaminate.matches(index, one, slop=1).collect()}
    assert {(0, 9, False), (0, 8, True), (0, 8, False), (8, 16, True)} <= spans
    assert {(r["begin"], r["end"]) for r in op9_decontaminate.matches(index, one).collect()} == {(0, 8), (8, 16)}


def test_postings_that_share_high_bits():
    """Terms that differ only in the bits which places take are told apart."""
    r = np.random.default_rng(1)
    hashes = (r.integers(0, 2, 3000).astype(np.uint64) << np.uint64(40)) | r.integers(0, 4, 3000).astype(np.uint64)
    terms, ends, places = op9_decontaminate.postings(hashes)
    assert terms.tolist() == sorted(set(hashes.tolist()))
    for t, lo, hi in zip(terms, [0, *ends[:-1]], ends, strict=True):
        assert places[lo:hi].tolist() == np.flatnonzero(hashes == t).tolist()
    assert [len(x) for x in op9_decontaminate.postings(np.empty(0, np.uint64))] == [0, 0, 0]


def test_topk(spark):
    r = np.random.default_rng(7)
    rows = [(i, [float(x) for x in np.round(r.normal(size=6), 2)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0, 2.0]), (None, [0.0] * 6)]
    rows += [(i, rows[4][1]) for i in (320, 321, 340)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = op10_topk.whole_vectors(df, "vec_id", "embedding", 64.0)
    assert {x["_id"] for x in vectors.collect()} == {*range(300), 304, 320, 321, 340}
    got = op10_topk.topk(vectors, vectors.where("_id % 20 = 0"), k=20).collect()
    whole = {x["_id"]: np.array(x["_vector"], np.int64) for x in vectors.collect()}
    want = []
    for q in sorted(i for i in whole if i % 20 == 0):
        scored = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q])))[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(tuple(x) for x in got) == want
    small = op10_topk.topk(vectors, vectors.where("_id % 20 = 0"), k=20, block=3, shard_rows=20).collect()
    assert sorted(tuple(x) for x in small) == want
    assert op10_topk.topk(vectors.limit(0), vectors.limit(0)).count() == 0


def test_toxicity(spark):
    r = random.Random(8)
    plain = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = [r.choice(plain) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            words[5] = r.choice(("badword", "baddest"))
        if toxic and i % 8 == 0 or i % 16 == 1:
            words[7] = "woman"
        rows.append((" ".join(words), int(toxic)))
    sample = spark.createDataFrame([(t.encode(), y) for t, y in rows], "_raw binary, _label int")
    model = op7_toxicity.train(sample)
    docs = frame(spark, ["nothing w1 w2 w3", "a badword here w5", "", None, "woman w1 w2", "man w1 w2"]).select("doc_id", "text")
    got = [x["_score"] for x in op7_toxicity.score_toxicity(docs, model).orderBy("doc_id").collect()]
    assert got[1] > 0.5 and max(got[0], got[2], got[3], got[4], got[5]) < 0.3 and all(0 <= s <= 1 for s in got)
    assert abs(got[4] - got[5]) < 0.1
    alone = op7_toxicity.train(sample.limit(0))
    assert op7_toxicity.score_toxicity(docs, alone).where("_score > 0.5").count() == 0


def test_quality(spark):
    r = random.Random(9)

    def good():
        return " ".join(f"word{r.randrange(99)}" for _ in range(12)) + "."

    def bad():
        return r.choice(["BUY!! NOW!! CHEAP!! " * 4, "a | b | c | d | e | f | g", "the the the the the the the the"])

    rows = []
    for i in range(240):
        lines = [good() for _ in range(4)]
        if i % 3 == 0:
            lines[1:3] = [bad(), bad()]
        rows.append(("\n".join(lines).encode(), int(i % 3 != 0)))
    field = op8_quality.train(spark.createDataFrame(rows, "_raw binary, _label int"))
    docs = frame(spark, ["\n".join(good() for _ in range(5)), good() + "\n" + bad() + "\n" + bad(), "", None, "\n\n"]).select("doc_id", "text")
    got = [x["_score"] for x in op8_quality.score_quality(docs, field).orderBy("doc_id").collect()]
    assert got[0] > 0.5 > got[1] and all(0 <= s <= 1 for s in got)
    assert got[2] == got[3] == got[4]
    nothing = op8_quality.train(spark.createDataFrame([], "_raw binary, _label int"))
    assert nothing.score(*op8_quality.lines_of(b"x")) > 0.99


def test_marginals_by_enumeration():
    from itertools import product

    field = op8_quality.Field(2)
    field.weights, field.pairs = np.array([0.7, -0.4]), np.array([[0.3, -0.2], [0.1, 0.5]])
    x = np.random.default_rng(1).normal(size=(5, 2))
    total, ones = 0.0, np.zeros(5)
    for y in product((0, 1), repeat=5):
        p = np.exp(sum(x[i] @ field.weights * y[i] for i in range(5)) + sum(field.pairs[y[i], y[i + 1]] for i in range(4)))
        total, ones = total + p, ones + p * np.array(y)
    assert field.marginals(x) == pytest.approx(ones / total)


def test_dates_are_only_data(spark):
    """Other columns pass through, whatever their types."""
    df = spark.createDataFrame([(1, "a b", date(2020, 1, 1), {"k": 1})], "doc_id long, text string, d date, m map<string,int>")
    out = op9_decontaminate.decontaminate(df, spark.createDataFrame([(1, "a b")], "item_id long, text string")).first()
    assert out["doc_id"] == 1 and out["n_items"] == 1 and out["n_hit"] == 2
    assert op1_mixing.mixed(df.withColumn("source", F.lit(None).cast("string"))).first()["m"] == {"k": 1}
