"""A paged search index as a data source: conditions become facets of the request, the schema its attributes.

``hits(spark, url, "name string, status string", {"status": ["Active"]})``: the
condition travels with the request, and only hits that meet it come back.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, ShortType, StringType

from loomspan.sources.web import Fetcher

#: Columns of these kinds are made from a hit's values; others are texts.
_NUMBERS = {ShortType: int, IntegerType: int, LongType: int, FloatType: float, DoubleType: float}


class Pages(InputPartition):
    def __init__(self, numbers: list[int]):
        self.numbers = numbers


class SearchReader(DataSourceReader):
    """Options besides the fetcher's: endpoint, hitsPerPage, limit, delay, concurrency."""

    def __init__(self, options: dict, schema):
        self.endpoint = options["endpoint"]
        self.size, self.delay = int(options.get("hitsPerPage", "100")), float(options.get("delay", "0"))
        self.limit = int(options["limit"]) if "limit" in options else None
        self.concurrency = int(options.get("concurrency", "1"))
        self.fetcher, self.schema = Fetcher({**options, "json": "true"}), schema
        self.wanted: list[list[str]] = []

    def request(self, page: int) -> dict:
        # the conditions of the list hold all together, those of an inner one in place of each other
        return {"query": "", "page": page, "hitsPerPage": self.size, "facetFilters": self.wanted, "attributesToRetrieve": self.schema.fieldNames()}

    def _page(self, number: int) -> dict | None:
        status, body = self.fetcher.fetch(self.endpoint, self.request(number))
        return json.loads(body) if status == 200 else None

    def partitions(self):
        """The index says how many pages there are; they are dealt over as many partitions as requests may be open. A limit on rows bounds the pages."""
        first = self._page(0) or {}
        pages = int(first.get("nbPages", 0)) if first.get("hits") else 0
        if self.limit is not None:
            pages = min(pages, -(-self.limit // self.size))
        parts = max(1, min(self.concurrency, pages))
        return [Pages(list(range(k, pages, parts))) for k in range(parts)]

    def read(self, partition: Pages):
        for i, number in enumerate(partition.numbers):
            if i and self.delay:
                time.sleep(self.delay)
            page = self._page(number)
            if page is None or not page.get("hits"):
                return
            for hit in page["hits"]:
                yield tuple(_value(hit.get(f.name), f.dataType) for f in self.schema.fields)


def _value(value, kind):
    if value is None:
        return None
    number = _NUMBERS.get(type(kind))
    if number is not None:
        try:
            return number(value)
        except (TypeError, ValueError):
            return None
    if isinstance(kind, StringType) and not isinstance(value, str):
        return json.dumps(value)
    return value


class FacetReader(SearchReader):
    """Takes conditions on the columns that the option ``facets`` names into the request."""

    def __init__(self, options: dict, schema):
        super().__init__(options, schema)
        self.facets = {x.strip() for x in options.get("facets", "").split(",") if x.strip()}

    def pushFilters(self, filters):  # noqa: N802 - the interface's name
        """Equalities and lists of texts on a facet go into the request; all other conditions are given back to Spark."""
        self.wanted = []
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if column in self.facets and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.wanted.append([f"{column}:{f.value}"])
            elif column in self.facets and isinstance(f, In) and f.value and all(isinstance(v, str) for v in f.value):
                self.wanted.append([f"{column}:{v}" for v in f.value])
            else:
                yield f


class SearchSource(DataSource):
    @classmethod
    def name(cls):
        return "search"

    def schema(self):
        return "name string, slug string, team_size string, status string"

    def reader(self, schema):
        return SearchReader(self.options, schema)


class FacetSource(SearchSource):
    @classmethod
    def name(cls):
        return "search_facets"

    def reader(self, schema):
        return FacetReader(self.options, schema)


def hits(spark: SparkSession, endpoint: str, schema: str, facets: dict[str, list[str]] | None = None, **options: str) -> DataFrame:
    """The hits of an index with the schema's columns, those alone whose facets have one of the given values.

    The conditions are part of the result, so every query of it sends them, with
    its own ones on the same columns. (Spark 4.1 keeps what a loaded source was
    handed first for later queries that hand it nothing; a result without facets
    therefore takes no conditions into the request at all.)
    """
    spark.dataSource.register(SearchSource)
    spark.dataSource.register(FacetSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    load = spark.read.format("search_facets" if facets else "search").schema(schema).options(endpoint=endpoint, facets=",".join(facets or {}), **options).load()
    for column, values in (facets or {}).items():
        if column not in load.columns:
            raise ValueError(f"no column {column} to filter by")
        load = load.where(F.col(column).isin(values))
    return load
