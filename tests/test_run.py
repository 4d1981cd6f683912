"""Rules, extraction, the store and two runs, over payloads written here."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera.operators.grouping import group_postings
from tessera.operators.rules import irrelevant, posting_problem
from tessera.plans.enrich import ModelProvider, Unavailable, checked, choose_provider, enrich_jobs, outcome_counts
from tessera.plans.extract import annotate, rejections, source_stats
from tessera.plans.profile import Profile
from tessera.plans.run import ChecksFailed, run
from tessera.plans.store import Store, load_checks, load_groups
from tessera.sources.boards import FIELDS
from tessera.sources.payloads import read_payloads

DAY1, DAY2 = datetime(2026, 9, 29, 12), datetime(2026, 9, 30, 12)
PROFILE = Profile("A", "Engineer", "senior", ("Python", "SQL", "Spark"), 70000)
POSTING = "seq long, source string, source_job_id string, url string, title string, company string, location string, work_mode string, salary_min long, salary_max long, salary_currency string, salary_text string, posted_at timestamp_ntz, description string"


def posting(seq, source="remotive", ident="1", url="https://jobs.example/1", title="Data Engineer", company="Contoso Logistics", mode="remote", low=None, high=None, currency=None, pay=None, posted=datetime(2026, 9, 28), text=None):
    return (seq, source, ident, url, title, company, None, mode, low, high, currency, pay, posted, text)


def postings(spark, *rows):
    return spark.createDataFrame(list(rows), POSTING)


def payloads(spark, tmp_path, files):
    for path, body in files.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(body if isinstance(body, str) else json.dumps(body))
    return read_payloads(spark, str(tmp_path), {"greenhouse": {"acme": "Acme"}})


def test_rules(spark):
    cases = [
        (posting(0), None),
        (posting(1, url="javascript:void(0)"), "invalid_url"),
        (posting(2, url="ftp://files.example/x"), "invalid_url"),
        (posting(3, url="https://localhost"), "invalid_url"),
        (posting(4, url="https://a b.com"), "invalid_url"),
        (posting(5, url="HTTPS://a.com"), None),
        (posting(6, posted=datetime(1999, 12, 31)), "invalid_date"),
        (posting(7, posted=datetime(2026, 10, 1)), "invalid_date"),
        (posting(8, posted=datetime(2026, 9, 30, 6)), None),
        (posting(9, posted=None), None),
        (posting(10, low=5000, high=4000), "invalid_salary"),
        (posting(11, low=30), "invalid_salary"),
        (posting(12, high=5_000_000), "invalid_salary"),
        (posting(13, currency="usd"), "invalid_salary"),
        (posting(14, company=None, url=""), "missing_required_field"),
        (posting(15, title="", url="nonsense"), "missing_required_field"),
    ]
    got = postings(spark, *(c[0] for c in cases)).select("seq", posting_problem(DAY1).alias("p")).orderBy("seq").select("p.rule").collect()
    assert [r[0] for r in got] == [c[1] for c in cases]


def test_relevance(spark):
    rows = postings(spark, posting(0), posting(1, mode="hybrid"), posting(2, mode=None), posting(3, title="Office Manager"))
    got = rows.orderBy("seq").select(irrelevant().alias("x")).collect()
    assert [r[0] for r in got] == [None, "not_remote (hybrid)", "not_remote (unknown)", "other_role"]


def test_extraction(spark, tmp_path):
    good = {"id": 1, "title": "Data Engineer", "absolute_url": "https://a.example/1", "location": {"name": "Remote"}, "content": "&lt;p&gt;Hi&lt;/p&gt;", "updated_at": "2026-09-01T00:00:00Z"}
    files = {
        "greenhouse/acme.json": {"jobs": [good, [1, 2], {"id": 7, "title": ""}, good | {"location": "x"}]},
        "greenhouse/none.json": {},
        "lever/bad.json": "{broken",
        "ashby/b.json": {"jobs": [{"id": "u", "title": "Data Engineer", "jobUrl": "https://b.example/u", "isListed": False}, {"id": "v", "title": "ETL Developer", "applyUrl": "https://b.example/v", "isRemote": True}]},
        "remoteok/all.json": [{"legal": "x"}, {"id": "5", "position": "Data Engineer", "epoch": 1758891600, "company": "C"}, 3],
        "unknown/x.json": [],
    }
    read = payloads(spark, tmp_path, files)
    annotated = annotate(read, DAY1).cache()
    rules = {(r["source"], r["rule"]): r["detail"] for r in rejections(annotated).collect()}
    assert rules[("greenhouse", "not_an_object")] == "list"
    assert rules[("greenhouse", "missing_raw_field")] == "title, absolute_url"
    assert ("greenhouse", "unparseable") in rules and ("lever", "unreadable_payload") in rules
    stats = {r["source"]: tuple(r)[1:] for r in source_stats(read, annotated).collect()}
    assert stats == {"greenhouse": (2, 4, 3, 0, 1), "lever": (1, 0, 1, 0, 0), "ashby": (1, 1, 0, 0, 1), "remoteok": (1, 1, 0, 0, 1)}
    kept = {r["source"]: r for r in annotated.where("outcome = 'kept'").collect()}
    assert kept["greenhouse"]["source_job_id"] == "acme:1" and kept["greenhouse"]["company"] == "Acme" and kept["greenhouse"]["description"] == "Hi"
    assert kept["remoteok"]["url"] == "https://remoteok.com/remote-jobs/5"
    annotated.unpersist()


def test_grouping(spark):
    rows = postings(
        spark,
        posting(0, "remoteok", "a", "https://x.example/1?utm_a=1", "Data Engineer", "Acme", pay="low"),
        posting(1, "greenhouse", "b", "https://y.example/2", "Data Engineer (Remote)", "Acme Inc."),
        posting(2, "lever", "c", "https://y.example/2/", "ETL Developer", "Other", low=90000),
        posting(3, "lever", "c", "https://z.example/3", "Again", "Again"),
        posting(4, "jobicy", "d", "https://w.example/4", "Data Engineer", None),
    )
    got = {r["group_seq"]: r for r in group_postings(rows).collect()}
    assert set(got) == {0, 4}
    first = got[0]
    assert [x["source"] for x in first["links"]] == ["greenhouse", "lever", "remoteok"]
    assert (first["canonical_url"], first["company"], first["salary_min"], first["salary_text"]) == ("https://y.example/2", "Acme Inc.", 90000, "low")
    assert got[4]["dedup_key"] is None


def load(spark, store, run_id, now, *rows):
    loaded = load_groups(store, group_postings(postings(spark, *rows)), run_id, now)
    store.commit({"jobs": loaded.jobs, "job_sources": loaded.job_sources}, run_id)
    return loaded.new_jobs, loaded.seen_again, loaded.new_links


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    assert load(spark, store, 1, DAY1, posting(0, text="original")) == (1, 0, 1)
    assert load(spark, store, 2, DAY2, posting(0, text="edited", pay="$90k")) == (0, 1, 0)
    row = store.read("jobs").first()
    assert (row["description"], row["salary_text"], row["first_run_id"], row["last_run_id"]) == ("original", "$90k", 1, 2)
    # 61 days on, the key alone doesn't match; the URL of a fresh job does on the same day
    late = datetime(2026, 11, 30, 12)
    assert load(spark, store, 3, late, posting(0, ident="9", url="https://jobs.example/9")) == (1, 0, 1)
    assert load(spark, store, 4, late, posting(0, ident="10", url="https://jobs.example/10")) == (0, 1, 1)
    assert load_checks(store) == {}
    ghost = spark.createDataFrame([("s", "g", "nowhere", "u", DAY1, DAY1, 4)], store.read("job_sources").schema)
    store.commit({"job_sources": store.read("job_sources").unionByName(ghost)}, 4)
    assert load_checks(store) == {"orphan_source_links": 1}


def test_two_runs(spark, tmp_path):
    def job(n, text="We use PySpark and SQL", **more):
        return {"id": n, "title": "Senior Data Engineer" if n % 2 else "Data Engineer", "url": f"https://jobs.example/{n}", "company_name": f"Firm {n}", "publication_date": "2026-09-25T00:00:00", "description": f"<p>{text}</p>"} | more

    root = str(tmp_path / "db")
    one = payloads(spark, tmp_path / "1", {"remotive/r.json": {"jobs": [job(1), job(2), job(3, url="x"), job(4, title="Cook")]}})
    first = run(spark, one, root, PROFILE, DAY1)
    assert (first.new_jobs, first.seen_again, first.rejected, first.filtered, first.enrich.enriched) == (2, 0, 1, 1, 2)
    assert "| normalize | invalid_url | 1 | remotive | x |" in first.report and "| Python | 2 |" in first.report
    two = payloads(spark, tmp_path / "2", {"remotive/r.json": {"jobs": [job(2), job(5)]}})
    second = run(spark, two, root, PROFILE, DAY2)
    assert (second.new_jobs, second.seen_again, second.enrich.enriched) == (1, 1, 1)
    store = Store(spark, root)
    assert [r["status"] for r in store.read("runs").orderBy("run_id").collect()] == ["ok", "ok"]

    def client():
        def ask(job, profile):
            if job["title"] == "Data Engineer":
                raise ValueError("refused")
            return json.dumps({"seniority": "senior", "stack": ["PySpark", "k8s", "Spark", "Iceberg"], "affinity": 70, "rationale": " ok "})

        return ask

    stats = enrich_jobs(store, ModelProvider(client, "m1"), PROFILE, 3, DAY2)
    assert (stats.candidates, stats.enriched, stats.failed) == (3, 2, 1)


def test_answers(spark):
    good = {"seniority": "mid", "affinity": 3, "stack": ["PySpark", "k8s", "Spark", " Iceberg ", "", "Kàfka"], "rationale": " ok "}
    replies = [good, {}, good | {"affinity": True}, good | {"affinity": 101}, good | {"affinity": 3.5}, good | {"affinity": "3"}, good | {"seniority": "x"}, [], good | {"stack": None, "rationale": None}]
    rows = [(str(i), json.dumps(x), None) for i, x in enumerate(replies)] + [("a", "{broken", None), ("b", None, "refused"), ("c", None, None)]
    got = {r["job_id"]: r for r in checked(spark.createDataFrame(rows, "job_id string, reply string, error string")).collect()}
    assert (got["0"]["stack"], got["0"]["rationale"], got["0"]["affinity"]) == (["Spark", "Kubernetes", "Iceberg", "Kafka"], "ok", 3)
    assert got["8"]["error"] is None and got["8"]["stack"] == []
    assert all(got[i]["error"] and got[i]["affinity"] is None and got[i]["stack"] is None for i in "1234567abc")
    assert got["b"]["error"] == "refused"


def test_outcomes(spark):
    """A provider that is gone ends a task's batch: those jobs are neither scored nor failed."""
    def client():
        def ask(job, profile):
            if job["job_id"] == "3":
                raise Unavailable("credit is used up")
            return json.dumps({"seniority": "mid", "stack": [], "affinity": 1 if job["job_id"] != "1" else 200})

        return ask

    jobs = spark.createDataFrame([(str(i),) for i in range(6)], "job_id string").coalesce(1)
    counts = outcome_counts(ModelProvider(client, "m").enrich(jobs, PROFILE)).first()
    assert (counts.candidates, counts.enriched, counts.failed, counts.stopped, counts.errors) == (6, 2, 1, "credit is used up", ["1: invalid affinity"])


def test_choice():
    assert choose_provider("off") is None and choose_provider("simulated").name == "simulated" and choose_provider("auto").name == "simulated"
    made = ModelProvider(None, "m")
    assert choose_provider("model", made) is made and choose_provider("auto", made) is made
    for mode in ("other", "model"):
        with pytest.raises(ValueError):
            choose_provider(mode)
    assert issubclass(ChecksFailed, Exception) and FIELDS and F
