"""Pages fetched as a data source: one partition a domain, in which addresses are fetched one after another.

Retries wait longer each time, requests to a domain keep a distance, and after three failures in a row the domain is left
alone for five minutes, when one more request decides. Whoever fetches is passed in, so tests and closed networks need no socket.
"""

from __future__ import annotations

import ipaddress
import json
import random
import re
import time
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id string, url string, status int, body string, etag string, error string, attempts int"
OPEN_AFTER, HALF_OPEN = 3, 300.0  # failures in a row, and seconds until one more try
# Errors of a connection that may pass.
PASSING = ("ECONNABORTED", "ECONNRESET", "ETIMEDOUT", "TIMEOUT")


def backoff_ms(attempt: int, noise: float = 0.0) -> float:
    """Wait before the attempt after the ``attempt``-th."""
    return min(15_000, 500 * 2 ** (attempt - 1)) + 250 * noise


def retryable(status: int | None, error: str | None) -> bool:
    """No response, a passing error of the connection, too many requests, or the server's fault."""
    return status is None or status == 429 or status >= 500 or (error or "").upper() in PASSING


def retryable_column(status: str, error: str):
    """:func:`retryable` as a column."""
    return F.col(status).isNull() | (F.col(status) == 429) | (F.col(status) >= 500) | F.coalesce(F.upper(error).isin(*PASSING), F.lit(False))


def fetch_with(get, url: str, headers: dict, retries: int, sleep=time.sleep, noise=random.random) -> dict:
    """The last answer of up to 1 + ``retries`` attempts; 304 is an answer."""
    for attempt in range(1, retries + 2):
        try:
            status, body, etag = get(url, headers)
            error = None
        except Exception as e:
            status, body, etag, error = None, None, None, str(e)[:200] or type(e).__name__
        done = status is not None and not retryable(status, error)
        if done or attempt == retries + 1:
            return {"status": status, "body": body if status and status < 400 else None, "etag": etag, "error": error or (None if done and status < 400 else f"HTTP {status}"), "attempts": attempt}
        sleep(backoff_ms(attempt, noise()) / 1000)
    raise AssertionError


def is_private(host: str | None) -> bool:
    """A host that must not be fetched: none, a local name, or a private address in any spelling."""
    h = (host or "").rstrip(".").lower()
    if not h or h == "localhost" or h.endswith(".localhost"):
        return True
    try:
        return not ipaddress.ip_address(h).is_global
    except ValueError:
        return bool(re.fullmatch(r"(?:0x[0-9a-f]+|\d+)(?:\.(?:0x[0-9a-f]+|\d+)){0,3}", h))


class _Domain(InputPartition):
    def __init__(self, items: list[dict]):
        self.items = items


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.items = json.loads(options["items"])
        self.retries, self.delay = int(options.get("retries", 2)), float(options.get("delayMs", 0)) / 1000
        self.getter = options.get("getter", "urllib")

    def partitions(self) -> list[InputPartition]:
        by: dict[str, list[dict]] = {}
        for i in self.items:
            by.setdefault(urlsplit(i["url"]).hostname or "", []).append(i)
        return [_Domain(v) for _, v in sorted(by.items())]

    def read(self, partition: _Domain):
        get, failed, since = _getter(self.getter), 0, 0.0
        for n, item in enumerate(partition.items):
            if is_private(urlsplit(item["url"]).hostname):
                yield (item["id"], item["url"], None, None, None, "private_host", 0)
                continue
            if failed >= OPEN_AFTER and time.monotonic() - since < HALF_OPEN:
                yield (item["id"], item["url"], None, None, None, "circuit_open", 0)
                continue
            if n and self.delay:
                time.sleep(self.delay)
            headers = {k: item[v] for k, v in (("If-None-Match", "etag"), ("If-Modified-Since", "last_modified")) if item.get(v)}
            got = fetch_with(get, item["url"], headers, self.retries)
            failed = 0 if got["error"] is None else failed + 1
            since = time.monotonic()
            yield (item["id"], item["url"], got["status"], got["body"], got["etag"], got["error"], got["attempts"])


def _getter(name: str):
    """``urllib``, or ``module:function`` of something called with (url, headers) that returns (status, body, etag)."""
    if name != "urllib":
        import importlib

        module, _, attribute = name.partition(":")
        return getattr(importlib.import_module(module), attribute)

    def get(url: str, headers: dict):
        import urllib.error
        import urllib.request

        class Checked(urllib.request.HTTPRedirectHandler):
            def redirect_request(self, req, fp, code, msg, hdrs, newurl):
                if is_private(urlsplit(newurl).hostname):
                    raise ValueError("private_host")
                return super().redirect_request(req, fp, code, msg, hdrs, newurl)

        try:
            with urllib.request.build_opener(Checked).open(urllib.request.Request(url, headers=headers), timeout=15) as r:
                return r.status, r.read().decode(errors="replace"), r.headers.get("ETag")
        except urllib.error.HTTPError as e:
            return e.code, None, None

    return get


class PageSource(DataSource):
    """Options: items (JSON list of id, url and optionally etag, last_modified), retries, delayMs, getter."""

    @classmethod
    def name(cls) -> str:
        return "eventlake_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def failure_streaks(log: DataFrame) -> DataFrame:
    """(domain, streak, open): failures in a row at the end of a fetch log (domain, at, error)."""
    from eventlake.operators.state import current_streak

    s = current_streak(log, "domain", F.col("error").isNotNull(), "at")
    return s.withColumn("open", F.col("streak") >= OPEN_AFTER)


def failure_reason(error: str, html: str, n_rows: str, allow_empty: str | None = None) -> F.col:
    """Why a source gave no rows; null if it gave some.

    An error is circuit_open, fetch_error if nothing was received, or parse_error. Without one a source that may be empty has an
    empty_schedule; others are csr_detected if the page is empty until its scripts run, or else selectors_stale.
    """
    from eventlake.sources.html import client_rendered

    e = F.col(error)
    empty = F.coalesce(F.col(allow_empty), F.lit(False)) if allow_empty else F.lit(False)
    return (
        F.when(e == "circuit_open", "circuit_open").when(e.isNotNull() & F.col(html).isNull(), "fetch_error").when(e.isNotNull(), "parse_error").when(F.col(n_rows) > 0, F.lit(None))
        .when(empty, "empty_schedule").when(F.coalesce(client_rendered(html), F.lit(False)), "csr_detected").otherwise("selectors_stale")
    )
