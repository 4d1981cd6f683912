"""Queries over whole tables, against brute force on small ones with odd rows."""

import html
from datetime import datetime

import __spark_entry__
from tessera.functions.text import REMOTE_WORDS
from tessera.plans.enrich import RulesProvider, candidates
from tessera.plans.profile import Profile


def test_all_turns_cleaned(spark, tmp_path):
    texts = ["  plain \n text ", "Größe  und Maß", "a &amp;&nbsp; b", " 　", "x\x1c y", "&#x20AC; 5 &unknown; &copy", "ünï REMOTE", "Hybrid ü", "", None]
    rows = [(i, t % 2, role, text) for i, text in enumerate(texts) for t, role in enumerate(("user", "", None))]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")

    def mode(role, text):
        said = f"{role or ''} {text or ''}".lower()
        return "remote" if any(w in said for w in REMOTE_WORDS) else "hybrid" if "hybrid" in said else "onsite" if role else None

    want = [(i, turn, " ".join(html.unescape(text or "").split()) or None, mode(role, text)) for i, turn, role, text in rows]
    got = __spark_entry__.queries()["all_turns_cleaned"](spark, str(tmp_path))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_stale_jobs(spark, tmp_path):
    """All of them, however many, for each reason."""
    labels = [(i, i % 2, int(i % 5 == 1)) for i in range(0, 240, 3)]
    spark.createDataFrame([(i, 9) for i in range(240)], "doc_id long, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    known = {i: (quality, toxic) for i, quality, toxic in labels}
    want = [i for i in range(240) if i not in known or known[i][0] == 0 or known[i][1] == 1 or i % 7 == 0 or i % 11 == 0]
    assert sorted(r["job_id"] for r in __spark_entry__.queries()["stale_jobs"](spark, str(tmp_path)).collect()) == want


def test_limit_of_candidates(spark):
    profile, provider = Profile("", "", "senior", ()), RulesProvider()
    jobs = spark.createDataFrame([(f"j{i}", f"c{i}", datetime(2026, 1, 1 + i // 2)) for i in range(6)], "job_id string, content_hash string, first_seen_at timestamp_ntz")
    done = [("j5", "c5", profile.fingerprint), ("j4", "old", profile.fingerprint), ("j0", "c0", "other")]
    scored = spark.createDataFrame([(*d, provider.name, provider.model) for d in done], "job_id string, content_hash string, profile_hash string, provider string, model string")
    order = ["j4", "j2", "j3", "j0", "j1"]
    for limit in (None, 0, 2, 9):
        assert [r["job_id"] for r in candidates(jobs, scored, profile, provider, limit).collect()] == order[:limit]


def test_whole_key_components(spark, tmp_path):
    """Texts that differ behind their first 40 characters are only tied by source and size."""
    same = "x" * 40
    rows = [(1, same + "a", "s", 41), (2, same + "bc", "s", 42), (3, same + "bc", "t", 42), (4, "y" * 42, "t", 42), (5, same + "d", "t", 41), (6, same + "e", None, 41)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = __spark_entry__.queries()["whole_key_components"](spark, str(tmp_path))
    assert {r["doc_id"]: r["component"] for r in got.collect()} == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6}
