"""The command line, and a live run whose requests fail."""

import json

from tessera import cli
from tessera.sources.http import JsonClient
from tessera.sources.live import Settings, live_payloads


def write_samples(root):
    for day, numbers in ((1, (1, 2)), (2, (2, 3))):
        target = root / f"day{day}" / "lever" / "acme.json"
        target.parent.mkdir(parents=True)
        jobs = [{"id": f"u{n}", "text": f"Data Engineer {n}", "hostedUrl": f"https://jobs.example/{n}", "categories": {"location": "Remote"}, "workplaceType": "remote", "createdAt": 1758891600000,
                 "descriptionPlain": " First. ", "lists": [{"text": "What  you do", "content": "<li>build &amp; run</li><li>SQL"}], "additionalPlain": "Last.",
                 "salaryRange": {"min": 90000, "max": 120000, "currency": "USD", "interval": "per-year-salary"}} for n in numbers]
        target.write_text(json.dumps(jobs))
        for source, body in (("jobicy", {"jobs": [{"id": 5, "url": "https://j.example/5", "jobTitle": "ETL Developer", "companyName": "B", "jobGeo": "Anywhere", "pubDate": "2026-09-20 10:00:00"}]}), ("himalayas", {"jobs": [{"guid": "https://h.example/7", "title": "Analytics Engineer", "companyName": "H", "applicationLink": "https://h.example/7", "pubDate": 1758891600}]})):
            target = root / f"day{day}" / source / "r.json"
            target.parent.mkdir(parents=True)
            target.write_text(json.dumps(body))
    (root / "boards.toml").write_text('[boards.lever]\nacme = "Acme"\n')


def test_demo_and_report(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "local_session", lambda: spark)
    write_samples(tmp_path / "samples")
    out = tmp_path / "out"
    assert cli.main(["report", "--db", str(tmp_path / "none")]) == 1 and "No runs yet." in capsys.readouterr().out
    assert cli.main(["demo", "--samples", str(tmp_path / "samples"), "--output", str(out)]) == 0
    first, second = ((out / f"report-run-{i}.md").read_text() for i in (1, 2))
    assert "**4 new jobs**, 0 seen again" in first and "**1 new jobs**, 3 seen again, 5 jobs" in second
    capsys.readouterr()
    assert cli.main(["report", "--db", str(out / "store"), "--run", "1"]) == 0 and "**4 new jobs**" in capsys.readouterr().out
    job = cli.Store(spark, str(out / "store")).read("jobs").where("canonical_url = 'https://jobs.example/1'").first()
    assert job["description"] == "First.\n\nWhat you do\n- build & run\n- SQL\n\nLast." and job["company"] == "Acme" and job["salary_text"] == "USD 90,000-120,000 / year"
    rows = {r["company"]: r for r in cli.Store(spark, str(out / "store")).read("jobs").collect()}
    assert rows["B"]["title"] == "ETL Developer" and rows["H"]["title"] == "Analytics Engineer"
    gone = cli.Store(spark, str(out / "store")).expire(2)
    assert gone and cli.Store(spark, str(out / "store")).read("jobs").count() == 5 and cli.Store(spark, str(out / "store")).read("source_stats").select("run_id").distinct().count() == 2


def test_live_run_without_answers(spark, tmp_path):
    client = JsonClient(lambda url: (404, {}, b""), lambda s: None, lambda: 0.0)
    payloads, landed = live_payloads(spark, Settings(("Data Engineer",)), str(tmp_path), client)
    assert payloads.count() == 0 and len(landed.errors) == 4 and not landed.payloads
    odd = JsonClient(lambda url: (200, {}, b'{"jobs": null}'), lambda s: None, lambda: 0.0)
    payloads, landed = live_payloads(spark, Settings(("Data Engineer",)), str(tmp_path / "2"), odd)
    assert payloads.count() == 4 and not landed.errors
