"""HTTP pages as a Spark data source: ``spark.read.format("attesta_http")``.

Options: ``urls`` (JSON list) or ``template`` with ``{page}`` and ``pages``; ``partitions``, ``delay``, ``timeout``, ``tries``, ``encoding``,
``cookie``, ``agents`` (JSON list). One row an address: (url, status, body, final_url, error). A page that fails gives a row with its
error, so that one of them does not cost a scan the rest; addresses are dealt over partitions, which are read again if an executor is lost.
"""

from __future__ import annotations

import itertools
import json
import random
import time
import urllib.error
import urllib.request

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRY = frozenset({429, 500, 502, 503, 504})
SCHEMA = "url string, status int, body string, final_url string, error string"


def charset(headers, body: bytes, forced: str | None = None) -> str:
    """The text of a page: in the encoding asked for, the one its header names, UTF-8, or else GB 18030."""
    for name in (forced, headers.get_content_charset() if headers is not None else None, "utf-8"):
        try:
            if name:
                return body.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode("gb18030", "replace")


def fetch(url: str, timeout: float = 25, tries: int = 3, backoff: float = 0.5, headers: dict[str, str] | None = None, encoding: str | None = None) -> tuple[int | None, str | None, str | None, str | None]:
    """(status, text, final address, error); tried again after 429, 5xx and network errors, with doubling pauses or those the server names."""
    for k in range(tries + 1):
        pause = backoff * 2**k
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=timeout) as r:
                return r.status, charset(r.headers, r.read(), encoding), r.geturl(), None
        except urllib.error.HTTPError as e:
            if e.code not in RETRY or k == tries:
                return e.code, None, url, f"HTTP {e.code}"
            after = e.headers.get("Retry-After", "")
            pause = max(pause, float(after)) if after.isdigit() else pause
        except (OSError, ValueError) as e:
            if isinstance(e, ValueError) or k == tries:
                return None, None, url, type(e).__name__
        time.sleep(pause)
    return None, None, url, "not tried"


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.o = options
        self.urls = json.loads(options["urls"]) if "urls" in options else [options["template"].format(page=p) for p in range(1, int(options["pages"]) + 1)]

    def partitions(self):
        n = max(1, min(int(self.o.get("partitions", "8")), len(self.urls)))
        return [InputPartition(self.urls[k::n]) for k in range(n)]

    def read(self, partition):
        agents, delay = json.loads(self.o.get("agents", '["Mozilla/5.0"]')), float(self.o.get("delay", "0"))
        for url in partition.value:
            headers = {"User-Agent": random.choice(agents)} | ({"Cookie": self.o["cookie"]} if "cookie" in self.o else {})
            if delay:
                time.sleep(delay * random.uniform(0.8, 1.2))
            yield (url, *fetch(url, float(self.o.get("timeout", "25")), int(self.o.get("tries", "3")), headers=headers, encoding=self.o.get("encoding")))


class HttpPages(DataSource):
    @classmethod
    def name(cls):
        return "attesta_http"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpPages)


def subscription(url: str, get=fetch, hops: int = 3) -> str:
    """The body of a subscription; one that is an address leads on, ``hops`` times at most, after which it is empty, as one that cannot be fetched is."""
    for _ in range(hops):
        _, body, _, error = get(url)
        text = "" if error else (body or "").strip()
        if not text.startswith(("http://", "https://")):
            return text
        url = text.split()[0]
    return ""


def paged(first: str, get=fetch, size: int = 100) -> list[dict]:
    """All entries of a listing whose address takes ``{page}``: pages are read until one has fewer than ``size`` entries."""
    out: list[dict] = []
    for page in itertools.count(1):
        status, body, _, error = get(first.format(page=page))
        if error:
            raise OSError(f"page {page}: {error}")
        data = json.loads(body)
        batch = data if isinstance(data, list) else next((v for v in data.values() if isinstance(v, list)), [])
        out += batch
        if len(batch) < size:
            return out
