"""The pipeline's stages against brute force, on a small corpus with odd rows."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from tessera.llm.op1_mixing import mix

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _gone int, shard string"


def lines(r, bad):
    good = [" ".join(f"word{r.randrange(300)}" for _ in range(12)) + "." for _ in range(4)]
    return "\n".join([good[0], *(["SHOUT!! SHOUT!! NOW!! " * 5] * 3 if bad else good[1:])])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    path = tmp_path_factory.mktemp("tables")
    texts = [lines(r, i % 4 == 0) for i in range(120)]
    item = " ".join(f"item{i}" for i in range(20))
    texts[7] += "\n" + item
    texts += [texts[1], texts[1].replace("word", "WORD"), texts[2] + " more.", None, "", "short one"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), i, "x") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[3] + " unnamed " * 30, None, None, None, None, None)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(110)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        kept[name] = docs.collect()
        if name != "shards":
            assert docs.columns == names
        if name == "mix_sources":
            want = Counter()
            for row in mix(before).collect():
                want[(row["doc_id"], row["text"])] += row["_copies"]
            assert Counter((x["doc_id"], x["text"]) for x in kept[name]) == +want
    after = {x["doc_id"] for x in kept["quality"]}
    assert all((i in after) == (i % 4 != 0) for i in range(120))

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    rows = [x for x in kept["quality"] if shingles(x["text"]) and x["doc_id"] is not None]
    gone = set()
    for a in rows:
        for b in rows:
            both = len(shingles(a["text"]) & shingles(b["text"]))
            if b["doc_id"] < a["doc_id"] and 100 * both >= 75 * len(shingles(a["text"]) | shingles(b["text"])):
                gone.add(a["doc_id"])
    named = [x["doc_id"] for x in kept["near_duplicates"] if x["doc_id"] is not None]
    assert sorted(named) == sorted({x["doc_id"] for x in rows} - gone | {x["doc_id"] for x in kept["quality"] if not shingles(x["text"]) and x["doc_id"] is not None})
    assert {x["doc_id"] for x in kept["near_duplicates"]} - {x["doc_id"] for x in kept["benchmark_passages"]} == {7}
    assert len(kept["shards"]) == len(kept["mix_sources"])
    counts = Counter(x["shard"] for x in kept["shards"])
    assert max(counts.values()) - min(counts.values()) <= 1


def test_empty(spark, folder, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
