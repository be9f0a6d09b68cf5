"""Driver-side upkeep of local inputs: requests with retries, downloads, and the manifest file."""

from __future__ import annotations

import http.client
import json
import logging
import os
import random
import socket
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..plans.refresh import FIRST_BACKOFF, MOST_BACKOFF

LOG = logging.getLogger(__name__)
ATTEMPTS, JITTER, TIMEOUT = 5, 0.2, 30
AGENT = "littoral/0.1"


def is_retryable(error: BaseException) -> bool:
    """Server errors and broken connections; not what the server refuses for good."""
    if isinstance(error, urllib.error.HTTPError):
        return 500 <= error.code < 600
    return isinstance(error, (urllib.error.URLError, http.client.IncompleteRead, socket.timeout, TimeoutError, ConnectionError))


def with_retries(job: Callable, what: str, attempts: int = ATTEMPTS, on_retry: Callable | None = None, sleep: Callable = time.sleep):
    for attempt in range(1, attempts + 1):
        try:
            return job()
        except Exception as e:
            if attempt == attempts or not is_retryable(e):
                raise
            wait = min(FIRST_BACKOFF * 2 ** (attempt - 1), MOST_BACKOFF) * random.uniform(1 - JITTER, 1 + JITTER)
            LOG.warning("%s failed (%s); attempt %d in %.0f s", what, e, attempt + 1, wait)
            if on_retry:
                on_retry()
            sleep(wait)


def _request(url: str, method: str = "GET") -> urllib.request.Request:
    return urllib.request.Request(url, method=method, headers={"User-Agent": AGENT})


def download(url: str, target: str | Path, attempts: int = ATTEMPTS, sleep: Callable = time.sleep) -> Path:
    """To a file that is there whole or not at all."""
    target = Path(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")

    def job():
        with urllib.request.urlopen(_request(url), timeout=TIMEOUT) as source, open(part, "wb") as out:
            length, done = source.headers.get("Content-Length"), 0
            while block := source.read(1 << 20):
                out.write(block)
                done += len(block)
            if length is not None and done < int(length):
                raise http.client.IncompleteRead(b"", int(length) - done)
        os.replace(part, target)

    try:
        with_retries(job, f"download of {url}", attempts, lambda: part.unlink(missing_ok=True), sleep)
    finally:
        part.unlink(missing_ok=True)
    return target


def remote_metadata(url: str, attempts: int = ATTEMPTS, sleep: Callable = time.sleep) -> dict[str, str | None]:
    def job():
        with urllib.request.urlopen(_request(url, "HEAD"), timeout=TIMEOUT) as reply:
            return {"last_modified": reply.headers.get("Last-Modified"), "etag": reply.headers.get("ETag")}

    return with_retries(job, f"state of {url}", attempts, sleep=sleep)


def load_manifest(path: str | Path) -> dict[str, dict]:
    """Empty where there is none, or none that can be read."""
    try:
        found = json.loads(Path(path).read_text())
        return found if isinstance(found, dict) else {}
    except FileNotFoundError:
        return {}
    except (OSError, ValueError) as e:
        LOG.warning("manifest %s is not readable: %s", path, e)
        return {}


def save_manifest(path: str | Path, manifest: dict[str, dict]) -> None:
    """Keys sorted, put in place at once."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    tmp = path.with_name(path.name + ".tmp")
    tmp.write_text(json.dumps(manifest, indent=2, sort_keys=True))
    os.replace(tmp, path)


def manifest_table(spark: SparkSession, manifest: dict[str, dict]) -> DataFrame:
    rows = [(k, v.get("last_modified"), v.get("etag"), v.get("url")) for k, v in sorted(manifest.items())]
    return spark.createDataFrame(rows, "key string, last_modified string, etag string, url string")


def age_days(path: str | Path, now: float | None = None) -> float:
    try:
        return ((time.time() if now is None else now) - os.stat(path).st_mtime) / 86400
    except FileNotFoundError:
        return float("inf")


def refresh_all(items: Iterable, fetch: Callable, extract: Callable, done: Callable, fetchers: int = 4, extractors: int = 2) -> None:
    """Fetch and extract side by side; an item is ``done`` (recorded) only after its extract. The first failure is raised once what is under way has ended."""
    items, failed = list(items), []
    with ThreadPoolExecutor(max(1, fetchers)) as first, ThreadPoolExecutor(max(1, extractors)) as second:

        def both(item):
            if failed:
                return
            try:
                fetch(item)
                second.submit(extract, item).result()
                done(item)
            except Exception as e:
                LOG.error("%s: %s", item, e)
                failed.append(e)

        list(first.map(both, items))
    if failed:
        raise failed[0]
