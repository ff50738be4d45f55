"""The product crawl in two phases: category pages give slugs, their pages give products, until enough are saved.

The driver takes the decisions that need what came before (which page is next,
whether enough is saved) and nothing else: pages are fetched, parsed and saved by
Spark, and phase 2 reads its slugs from phase 1's table. Its steps are bounded by
the categories times the pages of each, and then by the slugs over the limit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import ingest
from loomspan.plans.scratch import Scratch
from loomspan.sources import captures, web

#: Slugs wanted for each product that a limit asks for.
SLUGS_A_PRODUCT = 3
#: Product pages fetched in one step where there is no limit.
STEP = 1000
#: (urls) -> rows (url, status, body).
Fetch = Callable[[list[str]], DataFrame]


def web_fetch(spark: SparkSession, **options: str) -> Fetch:
    """Pages through the web source."""
    spark.dataSource.register(web.WebSource)
    return lambda urls: spark.read.format("web").options(urls=" ".join(urls), **options).load()


def discover(fetch: Fetch, categories: list[str], scratch: Scratch, limit: int | None = None, max_pages: int = 6) -> DataFrame:
    """(place, slug) of the products that the categories' pages link to, in the order of first sight.

    A category's pages are opened one after the other until one shows nothing new
    in its category (or cannot be had), max_pages at most; a category is opened
    only while there are fewer slugs than three times the limit. ``categories``
    are URLs; page n > 1 of one has ?page=n.
    """
    found: DataFrame | None = None
    seen = 0
    for c, category in enumerate(categories):
        if limit is not None and seen >= limit * SLUGS_A_PRODUCT:
            break
        own: DataFrame | None = None
        for page in range(1, max_pages + 1):
            url = category if page == 1 else f"{category}?page={page}"
            links = captures.category_slugs(fetch([url]).where("body is not null").select("url", F.col("body").alias("html")))
            if own is not None:
                links = links.join(own, "slug", "left_anti")
            new = scratch.keep(links.select("slug", F.struct(F.lit(c).alias("c"), F.lit(page).alias("p"), "position").alias("at")))
            if new.isEmpty():
                break
            own = new if own is None else own.unionByName(new)
        if own is not None:
            fresh = own if found is None else own.join(found, "slug", "left_anti")
            found = scratch.keep(fresh if found is None else found.unionByName(fresh))
            seen = found.count()
    return found if found is not None else fetch([]).select(F.lit("").alias("slug"), F.struct(F.lit(0).alias("c"), F.lit(0).alias("p"), F.lit(0).alias("position")).alias("at")).limit(0)


def crawl_products(spark: SparkSession, fetch: Fetch, base: str, categories: list[str], path: str, collected_at: Column, limit: int | None = None, max_pages: int = 6, step: int = STEP) -> dict[str, int]:
    """Save products into the table at path until the limit; returns how many slugs, opened pages, products and saved rows there were.

    A step opens as many product pages as rows are still wanted, so no page is
    opened once the limit is reached; without a limit a step opens ``step`` pages.
    """
    scratch = Scratch(spark, "crawl")
    slugs = discover(fetch, categories, scratch, limit, max_pages)
    waiting = scratch.keep(slugs.orderBy("at").select("slug", F.monotonically_increasing_id().alias("place")))
    totals = {"slugs": waiting.count(), "opened": 0, "products": 0, "saved": 0}
    last = -1
    while limit is None or totals["saved"] < limit:
        take = step if limit is None else min(step, limit - totals["saved"])
        chosen = waiting.where(F.col("place") > last).orderBy("place").limit(take).collect()
        if not chosen:
            break
        last = chosen[-1].place
        pages = fetch([f"{base}/{r.slug}" for r in chosen]).select(F.substring_index("url", "/", -1).alias("slug"), F.col("body").alias("html"))
        order = spark.createDataFrame([(r.slug, r.place) for r in chosen], "slug string, place bigint")
        rows = scratch.keep(captures.products(pages).withColumn("slug", F.substring_index("source_url", "/", -1)).join(order, "slug"))
        totals["opened"] += len(chosen)
        totals["products"] += rows.count()
        totals["saved"] += ingest.save(rows, "products", path, "place", collected_at)
    return totals
