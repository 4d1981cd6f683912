"""JSON over HTTP with retries and a least interval for each host."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

RETRIED = (429, 500, 502, 503, 504)
RETRIES, LONGEST_WAIT, INTERVAL, TIMEOUT = 3, 30.0, 1.0, 30.0

#: url -> status, headers (lower-case names), body. OSError stands for a broken transport.
Transport = Callable[[str], tuple[int, dict[str, str], bytes]]


class FetchError(Exception):
    """A request that can't be answered."""


def _urllib(url: str) -> tuple[int, dict[str, str], bytes]:
    request = urllib.request.Request(url, headers={"Accept": "application/json", "User-Agent": "tessera"})
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
            return answer.status, {k.lower(): v for k, v in answer.headers.items()}, answer.read()
    except urllib.error.HTTPError as e:
        return e.code, {k.lower(): v for k, v in e.headers.items()}, e.read()


class JsonClient:
    def __init__(self, transport: Transport = _urllib, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, interval: float = INTERVAL):
        self.transport, self.sleep, self.clock, self.interval = transport, sleep, clock, interval
        self.last: dict[str, float] = {}

    def get(self, url: str, params: dict | None = None) -> object:
        full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
        host = urllib.parse.urlsplit(full).netloc
        for attempt in range(RETRIES + 1):
            self._keep_apart(host)
            try:
                status, headers, body = self.transport(full)
            except OSError as e:
                status, headers, body = 0, {}, str(e).encode()
            if status in RETRIED or status == 0:
                if attempt < RETRIES:
                    self.sleep(self._wait(headers, attempt))
                    continue
            if status == 0 or status >= 400:
                raise FetchError(f"{host}: {status or body.decode(errors='replace')}")
            try:
                return json.loads(body)
            except ValueError as e:
                raise FetchError(f"{host}: no JSON") from e
        raise FetchError(host)

    @staticmethod
    def _wait(headers: dict[str, str], attempt: int) -> float:
        asked = headers.get("retry-after", "")
        return min(float(asked), LONGEST_WAIT) if asked.isdigit() else float(2**attempt)

    def _keep_apart(self, host: str) -> None:
        if host in self.last and (rest := self.last[host] + self.interval - self.clock()) > 0:
            self.sleep(rest)
        self.last[host] = self.clock()
