"""The client of a language model, over a transport written here, and the batch that ends."""

import json

import pytest

from tessera.plans.enrich import ModelProvider, Unavailable, outcome_counts
from tessera.plans.model_client import SCHEMA, ModelClient
from tessera.plans.profile import Profile

PROFILE = Profile("A", "Engineer", "senior", ("Python",), 1)
GOOD = json.dumps({"seniority": "mid", "stack": ["k8s"], "affinity": 50, "rationale": "fits"})


def answer(text=GOOD, **more):
    return 200, json.dumps({"content": [{"type": "thinking"}, {"type": "text", "text": text}], "stop_reason": "end_turn"} | more).encode()


def asked(monkeypatch, answers, key="k"):
    sent, waits, left = [], [], list(answers)

    def post(url, headers, body):
        sent.append((url, headers, json.loads(body)))
        got = left.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    if key:
        monkeypatch.setenv("TESSERA_MODEL_KEY", key)
    else:
        monkeypatch.delenv("TESSERA_MODEL_KEY", raising=False)
    ask = ModelClient("https://m.example/v1", "m1", post=post, sleep=waits.append)()
    return lambda: ask({"title": "T", "description": "ü", "job_id": "1"}, PROFILE), sent, waits


def test_request(monkeypatch):
    ask, sent, waits = asked(monkeypatch, [(529, b""), (429, b""), answer()])
    assert ask() == GOOD and waits == [2.0, 4.0]
    url, headers, body = sent[-1]
    assert url == "https://m.example/v1" and headers["x-api-key"] == "k" and body["model"] == "m1"
    assert body["output_config"]["format"]["schema"] == SCHEMA
    assert json.loads(body["messages"][0]["content"]) == {"title": "T", "company": None, "location": None, "salary_text": None, "description": "ü"}
    assert '"skills": ["Python"]' in body["system"][0]["text"] and body["system"][0]["cache_control"]


@pytest.mark.parametrize("got, said", [
    (answer(stop_reason="refusal"), "declined"),
    (answer(stop_reason="max_tokens"), "cut off"),
    ((200, b'{"content": []}'), "no text"),
    ((400, b""), "400"),
    (OSError("gone"), "reached"),
])
def test_errors_cost_one_job(monkeypatch, got, said):
    ask, *_ = asked(monkeypatch, [got])
    with pytest.raises(RuntimeError, match=said):
        ask()


@pytest.mark.parametrize("answers, key", [([(401, b"")], "k"), ([(403, b"")], "k"), ([], None)])
def test_what_ends_the_batch(monkeypatch, answers, key):
    ask, *_ = asked(monkeypatch, answers, key)
    with pytest.raises(Unavailable):
        ask()


def test_no_further_chunk(spark, tmp_path):
    """The chunk after the one in which the service went away is not asked for."""
    log = tmp_path / "asked"

    def client():
        def ask(job, profile):
            with log.open("a") as f:
                f.write("x")
            raise Unavailable("gone")

        return ask

    jobs = spark.createDataFrame([(str(i),) for i in range(40)], "job_id string").coalesce(1)
    counts = outcome_counts(ModelProvider(client, "m", chunk=10).enrich(jobs, PROFILE)).first()
    assert (counts.candidates, counts.enriched, counts.failed, counts.stopped) == (40, 0, 0, "gone")
    assert log.read_text() == "x"
