"""The profile that jobs are scored against."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass
from pathlib import Path

# Levels from the lowest to the highest.
LEVELS = ("junior", "mid", "senior", "lead")


@dataclass(frozen=True)
class Profile:
    name: str
    headline: str
    seniority: str
    skills: tuple[str, ...]
    min_salary_usd: int | None = None
    summary: str = ""

    def __post_init__(self):
        if self.seniority not in LEVELS:
            raise ValueError(f"seniority must be one of {LEVELS}, not {self.seniority!r}")

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]


def load_profile(path: str) -> Profile:
    read = json.loads(Path(path).read_text(encoding="utf-8"))
    return Profile(read["name"], read["headline"], read["seniority"], tuple(read["skills"]), read.get("min_salary_usd"), read.get("summary", ""))
