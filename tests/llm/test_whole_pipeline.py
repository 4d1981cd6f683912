"""near_duplicates keeps one row of each group, whatever the ids."""

from collections import Counter

import corpus_pipeline


def test_repeated_and_null_ids(spark, tmp_path):
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [
        (1, text("a")), (2, text("a")), (2, text("b")),  # id 2: one copy, one text of its own
        (3, text("c")), (3, text("c") + " more"),  # near copies of one id
        (None, text("a")), (None, text("d")), (None, text("d")), (None, text("e")),
        (4, text("f")), (4, text("f")), (5, text("g")), (6, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()))
    third = {(3, text("c")), (3, text("c") + " more")} & set(got)
    assert len(third) == 1
    want = [(1, text("a")), (2, text("b")), *third, (None, text("d")), (None, text("e")), (4, text("f")), (5, text("g")), (6, ""), (None, None)]
    assert got == Counter(want)
