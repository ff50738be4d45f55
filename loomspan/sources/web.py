"""A Python data source that fetches pages: a host's pages in one partition, paced and retried inside the reader.

Rows are (url, status, body). Nothing is fetched until a plan that reads the
source runs. ``spark.dataSource.register(WebSource)`` makes it known as "web".
"""

from __future__ import annotations

import heapq
import http.client
import json
import random
import time
import urllib.error
import urllib.request
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Fetcher:
    """Requests with retries. Options: timeout, attempts, userAgent, pause (the scale of the waits, so that tests need not wait), json."""

    def __init__(self, options: dict):
        self.timeout = float(options.get("timeout", "30"))
        self.attempts = int(options.get("attempts", "3"))
        self.agent = options.get("userAgent", "loomspan")
        self.pause = float(options.get("pause", "1"))
        self.json = options.get("json", "false").lower() == "true"

    def fetch(self, url: str, payload: dict | None = None):
        """(status, body); status 0 and no body after the last failed attempt, as are replies that are no success.

        A throttled request waits 4, 8, 16 seconds, a server or network error 2, 4, 6.
        With json a body that is none counts as a network error. A payload is sent as JSON.
        """
        data = None if payload is None else json.dumps(payload).encode()
        headers = {"User-Agent": self.agent} | ({} if data is None else {"Content-Type": "application/json"})
        for attempt in range(1, self.attempts + 1):
            try:
                request = urllib.request.Request(url, data=data, headers=headers)
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    body = reply.read().decode(reply.headers.get_content_charset() or "utf-8", "replace")
                    if not self.json or _is_json(body):
                        return reply.status, body
                status, wait = 0, 2 * attempt
            except urllib.error.HTTPError as error:
                if error.code == 429:
                    wait = 4 * 2 ** (attempt - 1)
                elif error.code >= 500:
                    wait = 2 * attempt
                else:
                    return error.code, None
                status = error.code
            except (OSError, http.client.HTTPException):
                status, wait = 0, 2 * attempt
            except (ValueError, LookupError):  # no URL, or a charset that nobody knows: trying again changes nothing
                return 0, None
            if attempt < self.attempts:
                time.sleep(self.pause * wait * (1 + random.random() / 10))
        return status, None


def _is_json(body: str) -> bool:
    try:
        json.loads(body)
    except ValueError:
        return False
    return True


class HostPartition(InputPartition):
    """Some hosts' URLs, host by host."""

    def __init__(self, hosts: list[list[str]]):
        self.hosts = hosts


def packed(hosts: list[list[str]], most: int) -> list[list[list[str]]]:
    """The hosts in at most so many groups of about the same number of URLs: the longest first, each to the group that has least."""
    groups: list[list[list[str]]] = [[] for _ in range(min(most, len(hosts)))]
    heap = [(0, i) for i in range(len(groups))]
    for urls in sorted(hosts, key=len, reverse=True):
        load, i = heapq.heappop(heap)
        groups[i].append(urls)
        heapq.heappush(heap, (load + len(urls), i))
    return groups


class WebReader(DataSourceReader):
    """Options besides the fetcher's: urls, delay between a host's requests, concurrency (most requests open at once; a host has one at a time), stopAfterMisses."""

    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split() if u]
        self.delay = float(options.get("delay", "0"))
        self.fetcher = Fetcher(options)
        self.concurrency = int(options.get("concurrency", "0"))
        # a numbered walk over one host ends after so many pages in a row without a body
        self.misses = int(options.get("stopAfterMisses", "0"))

    def fetch(self, url: str):
        return self.fetcher.fetch(url)

    def partitions(self):
        hosts: dict[str, list[str]] = {}
        for url in self.urls:
            try:
                host = urlsplit(url).netloc
            except ValueError:
                host = ""
            hosts.setdefault(host, []).append(url)
        groups = packed(list(hosts.values()), self.concurrency or len(hosts))
        return [HostPartition(g) for g in groups] or [HostPartition([])]

    def read(self, partition: HostPartition):
        for urls in partition.hosts:
            missed = 0
            for i, url in enumerate(urls):
                if i and self.delay:
                    time.sleep(self.delay)
                status, body = self.fetch(url)
                yield url, status, body
                missed = 0 if body else missed + 1
                if self.misses and missed >= self.misses:
                    break


class WebSource(DataSource):
    @classmethod
    def name(cls):
        return "web"

    def schema(self):
        return "url string, status int, body string"

    def reader(self, schema):
        return WebReader(self.options)


def json_pages(spark: SparkSession, urls: list[str], **options: str) -> DataFrame:
    """(url, status, json) of the URLs: the parsed body, null where no attempt brought JSON."""
    spark.dataSource.register(WebSource)
    pages = spark.read.format("web").options(urls=" ".join(urls), json="true", **options).load()
    return pages.select("url", "status", F.try_parse_json("body").alias("json"))


def id_urls(base: str, start: int, count: int, step: int = -1) -> list[str]:
    """URLs of consecutively numbered pages, from start by step."""
    return [f"{base}{start + i * step}" for i in range(count)]


def page_urls(base: str, size: int, pages: int | None = None, limit: int | None = None, offset: str = "start", count: str = "max_results") -> list[str]:
    """URLs of a paged listing, page by page: so many pages, or as many as the limit on rows asks for, the last one no larger than needed."""
    if pages is None and limit is None:
        raise ValueError("a number of pages or a limit is needed")
    joint, out, start = "&" if "?" in base else "?", [], 0
    while (pages is None or len(out) < pages) and (limit is None or start < limit):
        take = size if limit is None else min(size, limit - start)
        out.append(f"{base}{joint}{offset}={start}&{count}={take}")
        start += take
    return out


def until_misses(rows, limit: int = 20):
    """Rows (in page order) up to the limit-th consecutive one without a body."""
    missed = 0
    for row in rows:
        missed = 0 if row["body"] else missed + 1
        yield row
        if missed >= limit:
            return
