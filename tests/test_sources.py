"""The HTTP client, landing, and incremental runs."""

import json
from datetime import datetime

import pytest

from tessera.sources.http import FetchError, JsonClient
from tessera.sources.live import Settings, land, safe_name
from tessera.streaming.incremental import run_new_files


def client(answers):
    waits, left = [], list(answers)
    made = JsonClient(lambda url: left.pop(0), waits.append, lambda: 0.0)
    return made, waits


def test_retries():
    made, waits = client([(503, {}, b""), (429, {"retry-after": "90"}, b""), (200, {}, b"[1]")])
    assert made.get("https://a.example/x") == [1]
    assert waits == [1.0, 1.0, 30.0, 1.0]


@pytest.mark.parametrize("answers", [[(404, {}, b"")], [(200, {}, b"<")], [(500, {}, b"")] * 4])
def test_failures(answers):
    with pytest.raises(FetchError):
        client(answers)[0].get("https://a.example/x")


def test_landing(spark, tmp_path):
    def transport(url):
        if "himalayas" in url:
            return 200, {}, json.dumps({"jobs": [1, 2], "limit": 2}).encode()
        return (404, {}, b"") if "lever" in url else (200, {}, b'{"jobs": []}')

    settings = Settings(("Data Engineer",), {"greenhouse": {"acme": "Acme"}, "lever": {"x": "X"}})
    done = land(spark, settings, str(tmp_path), JsonClient(transport, lambda s: None, lambda: 0.0))
    assert [k for s, k in done.payloads if s == "himalayas"] == ["Data Engineer#1", "Data Engineer#2"]
    assert [e[:2] for e in done.errors] == [("lever", "x")]
    assert (tmp_path / "remotive" / "Data_Engineer.json").exists() and safe_name("a b/c-d_e") == "a_b_c-d_e"


def test_incremental(spark, tmp_path):
    def put(name, n):
        job = {"id": n, "title": "Data Engineer", "url": f"https://j.example/{n}", "company_name": f"F{n}"}
        target = tmp_path / "in" / "remotive" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps({"jobs": [job]}))

    args = (spark, str(tmp_path / "in"), str(tmp_path / "db"), str(tmp_path / "cp"))
    put("a.json", 1)
    first = run_new_files(*args, provider_mode="off", now=datetime(2026, 9, 29))
    put("b.json", 2)
    second = run_new_files(*args, provider_mode="off", now=datetime(2026, 9, 30))
    assert [(s.new_jobs, s.seen_again) for s in first + second] == [(1, 0), (1, 0)]
