"""A client that asks a language model over HTTP to score a job: the request, its schema, and what answers mean."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from tessera.plans.enrich import STACK, Unavailable
from tessera.plans.profile import LEVELS, Profile

#: What an answer holds; plans.enrich.checked holds answers to it again.
SCHEMA = {
    "type": "object",
    "properties": {
        "seniority": {"type": "string", "enum": [*LEVELS, "unknown"]},
        "stack": {"type": "array", "items": {"type": "string"}},
        "affinity": {"type": "integer"},
        "rationale": {"type": "string"},
    },
    "required": ["seniority", "stack", "affinity", "rationale"],
    "additionalProperties": False,
}
#: Fields of a job that the model sees.
SHOWN = ("title", "company", "location", "salary_text", "description")
#: Tokens of an answer, attempts at a busy service, and the seconds between them.
MOST_TOKENS, ATTEMPTS, WAIT, TIMEOUT = 8000, 3, 2.0, 120.0

#: url, headers, body -> status and body. OSError stands for a broken transport.
Post = Callable[[str, dict[str, str], bytes], tuple[int, bytes]]


def instructions(profile: Profile) -> str:
    """The same for every job, so that a service can keep it."""
    return "\n".join([
        "You judge job postings for one candidate. Answer with one JSON object:",
        f"seniority - the level that is asked for, one of {', '.join(LEVELS)}, or unknown if the posting is silent;",
        f"stack - technologies that are required or wished for, by their usual names ({', '.join([*STACK][:6])} and the like), no soft skills;",
        "affinity - a whole number from 0 to 100: how far the candidate meets the requirements and the level;",
        "rationale - one or two sentences that name what is met and what is missing.",
        "Of the candidate assume nothing beyond this profile:",
        json.dumps(asdict(profile), sort_keys=True),
    ])


def _post(url: str, headers: dict[str, str], body: bytes) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, body, headers), timeout=TIMEOUT) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


@dataclass(frozen=True)
class ModelClient:
    """Called in a worker, gives ask(job, profile) -> JSON text, as ModelProvider wants it.

    url takes a POST of model, system, messages and an output format; key_variable names the
    environment variable of the worker that holds the key.
    """

    url: str
    model: str
    key_variable: str = "TESSERA_MODEL_KEY"
    headers: dict[str, str] = field(default_factory=dict)
    post: Post = _post
    sleep: Callable[[float], None] = time.sleep

    def __call__(self) -> Callable[[dict, Profile], str]:
        key = os.environ.get(self.key_variable)
        headers = {"content-type": "application/json", "x-api-key": key or "", **self.headers}

        def ask(job: dict, profile: Profile) -> str:
            if not key:
                raise Unavailable(f"{self.key_variable} is not set")
            return read_answer(*self._send(headers, request_body(self.model, job, profile)))

        return ask

    def _send(self, headers: dict[str, str], body: bytes) -> tuple[int, bytes]:
        for attempt in range(ATTEMPTS):
            try:
                status, answer = self.post(self.url, headers, body)
            except OSError as e:
                raise RuntimeError(f"the service can't be reached: {e}") from e
            if status != 429 and status < 500 or attempt + 1 == ATTEMPTS:
                return status, answer
            self.sleep(WAIT * 2**attempt)
        raise AssertionError


def request_body(model: str, job: dict, profile: Profile) -> bytes:
    return json.dumps({
        "model": model,
        "max_tokens": MOST_TOKENS,
        "system": [{"type": "text", "text": instructions(profile), "cache_control": {"type": "ephemeral"}}],
        "messages": [{"role": "user", "content": json.dumps({k: job.get(k) for k in SHOWN}, ensure_ascii=False, default=str)}],
        "output_config": {"effort": "low", "format": {"type": "json_schema", "schema": SCHEMA}},
    }).encode()


def read_answer(status: int, body: bytes) -> str:
    """The text of an answer. Unavailable for a key that isn't taken; RuntimeError costs the job only."""
    if status in (401, 403):
        raise Unavailable(f"the key was refused ({status})")
    if status == 429:
        raise RuntimeError("the service is busy")
    if status >= 400:
        raise RuntimeError(f"the service failed ({status})")
    answer = json.loads(body)
    ended = {"refusal": "the model declined", "max_tokens": "the answer was cut off"}.get(answer.get("stop_reason"))
    if ended:
        raise RuntimeError(ended)
    texts = [part["text"] for part in answer.get("content") or [] if part.get("type") == "text"]
    if not texts:
        raise RuntimeError("the answer holds no text")
    return texts[0]
