"""Listings and numbered pages as streams whose offset is the next page: a restart goes on where the last committed batch ended.

Such a site wants one request after the other, so a batch is one step of the
walk, and what it brings is read where the offsets are planned. ``register`` makes the
sources known as "listing" and "numbered".
"""

from __future__ import annotations

import re
import time

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from loomspan.sources.web import Fetcher


class _Walk(SimpleDataSourceStreamReader):
    """Steps from offset to offset; a step that has ended stays where it is."""

    def __init__(self, options: dict):
        self.fetcher, self.delay = Fetcher(options), float(options.get("delay", "0"))
        self.opened = False

    def get(self, url: str):
        if self.opened and self.delay:
            time.sleep(self.delay)
        self.opened = True
        return self.fetcher.fetch(url)

    def read(self, start: dict):
        rows, end = self.step(start) if not start["ended"] else ([], start)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):  # noqa: N802 - the interface's name
        rows, at = [], start
        while at != end and not at["ended"]:
            more, at = self.step(at)
            rows += more
        return iter(rows)

    def commit(self, end: dict) -> None:
        pass


class ListingReader(_Walk):
    """Pages of a listing. Options: base, size, limit; ``entry`` and ``total``, patterns for an entry's start and the announced number.

    The walk ends with a page without entries or with fewer than asked for, at the
    announced total, and at the limit; a page that cannot be had ends it too.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.base, self.size = options["base"], int(options.get("size", "200"))
        self.limit = int(options["limit"]) if "limit" in options else None
        self.entry, self.total = options.get("entry", r"<entry[ >]"), options.get("total", r"totalResults[^>]*>\s*(\d+)\s*<")

    def initialOffset(self):  # noqa: N802
        return {"start": 0, "ended": False}

    def step(self, at: dict):
        start = at["start"]
        take = self.size if self.limit is None else min(self.size, self.limit - start)
        if take <= 0:
            return [], at | {"ended": True}
        joint = "&" if "?" in self.base else "?"
        url = f"{self.base}{joint}start={start}&max_results={take}"
        status, body = self.get(url)
        found = len(re.findall(self.entry, body or ""))
        announced = re.search(self.total, body or "")
        after = start + found
        ended = found < take or after >= (int(announced[1]) if announced else 0) or (self.limit is not None and after >= self.limit)
        return [(url, start, status, body)] if found else [], {"start": after, "ended": bool(ended)}


class NumberedReader(_Walk):
    """Consecutively numbered pages. Options: base, first, step, misses (the walk ends after so many pages in a row without a body), chunk (pages in a batch)."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.base, self.first, self.by = options["base"], int(options["first"]), int(options.get("step", "-1"))
        self.misses, self.chunk = int(options.get("misses", "20")), int(options.get("chunk", "10"))

    def initialOffset(self):  # noqa: N802
        return {"number": self.first, "missed": 0, "ended": False}

    def step(self, at: dict):
        number, missed, rows = at["number"], at["missed"], []
        for _ in range(self.chunk):
            if missed >= self.misses or number < 0:
                break
            url = f"{self.base}{number}"
            status, body = self.get(url)
            missed = 0 if body else missed + 1
            rows.append((url, number, status, body))
            number += self.by
        return rows, {"number": number, "missed": missed, "ended": missed >= self.misses or number < 0}


class _Source(DataSource):
    def schema(self):
        return "url string, position bigint, status int, body string"


class Listing(_Source):
    @classmethod
    def name(cls):
        return "listing"

    def simpleStreamReader(self, schema):  # noqa: N802
        return ListingReader(self.options)


class Numbered(_Source):
    @classmethod
    def name(cls):
        return "numbered"

    def simpleStreamReader(self, schema):  # noqa: N802
        return NumberedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Listing)
    spark.dataSource.register(Numbered)
