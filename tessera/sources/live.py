"""Live payloads: a few dozen polite requests from the driver, landed as files and read back by the scan."""

from __future__ import annotations

import json
import re
import tomllib
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.http import FetchError, JsonClient
from tessera.sources.payloads import no_payloads, read_payloads

# Addresses and parameters of the boards.
BOARD_URLS = {
    "greenhouse": ("https://boards-api.greenhouse.io/v1/boards/{slug}/jobs", {"content": "true"}),
    "lever": ("https://api.lever.co/v0/postings/{slug}", {"mode": "json"}),
    "ashby": ("https://api.ashbyhq.com/posting-api/job-board/{slug}", {"includeCompensation": "true"}),
}
REMOTIVE, REMOTEOK = "https://remotive.com/api/remote-jobs", "https://remoteok.com/api"
JOBICY, HIMALAYAS = "https://jobicy.com/api/v2/remote-jobs", "https://himalayas.app/jobs/api/search"
HIMALAYAS_PAGES, HIMALAYAS_LIMIT = 2, 20


@dataclass
class Settings:
    roles: tuple[str, ...]
    boards: dict[str, dict[str, str]] = field(default_factory=dict)


@dataclass
class Landed:
    """payloads: source and key of each landed file; errors: source, key and reason of what failed."""

    folder: str
    payloads: list[tuple[str, str]] = field(default_factory=list)
    errors: list[tuple[str, str, str]] = field(default_factory=list)


def load_settings(path: str) -> Settings:
    read = tomllib.loads(Path(path).read_text(encoding="utf-8"))
    return Settings(tuple(read["roles"]), read.get("boards", {}))


def safe_name(key: str) -> str:
    return re.sub(r"[^\w-]", "_", key)


def requests(settings: Settings) -> Iterator[tuple[str, str, str, dict]]:
    """source, key, url and parameters of all requests but further pages."""
    for source, (url, params) in BOARD_URLS.items():
        for slug in settings.boards.get(source, {}):
            yield source, slug, url.format(slug=slug), params
    for role in settings.roles:
        yield "remotive", role, REMOTIVE, {"search": role}
    yield "remoteok", "all", REMOTEOK, {}
    for role in settings.roles:
        yield "jobicy", role, JOBICY, {"count": 50, "tag": role}
    for role in settings.roles:
        yield "himalayas", f"{role}#1", HIMALAYAS, {"q": role, "page": 1}


def _writer(spark: SparkSession):
    """write(path, text) through Hadoop's file system, so that the folder may lie where executors read it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def write(path: str, text: str) -> None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(conf).create(target, True)
        out.write(bytearray(text.encode()))
        out.close()

    return write


def land(spark: SparkSession, settings: Settings, folder: str, client: JsonClient | None = None) -> Landed:
    """Every answer goes to <folder>/<source>/<key>.json before anything reads it; a failure costs its request.

    The requests are a few dozen, paced by the client, so the driver makes them.
    """
    client, out, write = client or JsonClient(), Landed(folder), _writer(spark)
    for source, key, url, params in requests(settings):
        page = params.get("page")
        while True:
            try:
                body = client.get(url, params)
            except FetchError as e:
                out.errors.append((source, key, str(e)))
                break
            write(f"{folder.rstrip('/')}/{source}/{safe_name(key)}.json", json.dumps(body))
            out.payloads.append((source, key))
            more = page is not None and isinstance(body, dict) and len(body.get("jobs") or []) >= body.get("limit", HIMALAYAS_LIMIT)
            if not more or page >= HIMALAYAS_PAGES:
                break
            page += 1
            key, params = f"{params['q']}#{page}", params | {"page": page}
    return out


def live_payloads(spark: SparkSession, settings: Settings, folder: str, client: JsonClient | None = None) -> tuple[DataFrame, Landed]:
    """The payloads that were landed (none if every request failed), and what was landed and what failed."""
    landed = land(spark, settings, folder, client)
    return read_payloads(spark, folder, settings.boards) if landed.payloads else no_payloads(spark), landed
