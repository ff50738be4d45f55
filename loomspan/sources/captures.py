"""From captured payloads (files) to records. One function for each kind of source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.functions import html, text
from loomspan.plans.ranks import group_ranks
from loomspan.plans.scratch import Scratch

# What each news feed is called, and the author of items without one.
NEWS_SITES = {"techcrunch": "TechCrunch AI", "theverge": "The Verge AI", "mit": "MIT News AI", "arstechnica": "Ars Technica AI", "wired": "Wired AI"}
DEFAULT_AUTHORS = {"mit": "MIT News Office"}

_ATOM = "id string, title string, published string, updated string, summary string, content string, author array<struct<name:string>>, link array<struct<_rel:string,_href:string>>"
_RSS = "title string, link string, pubDate string, `dc:creator` string, description string, category array<string>"
_BOARDS = {
    "remoteok": "position string, company string, url string, date string, epoch bigint, tags variant, description string",
    "jobicy": "jobs array<struct<jobTitle:string,companyName:string,url:string,pubDate:string,jobIndustry:variant,jobDescription:string>>",
    "arbeitnow": "data array<struct<title:string,company_name:string,url:string,created_at:bigint,remote:boolean,tags:variant,description:string>>",
    "remotive": "jobs array<struct<title:string,company_name:string,url:string,publication_date:string,category:string,description:string>>",
}
# The boards' names.
BOARD_NAMES = {"remoteok": "RemoteOK", "jobicy": "Jobicy", "arbeitnow": "Arbeitnow", "remotive": "Remotive"}


def _clean(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def _list(col: Column) -> Column:
    """A variant that holds a list of texts, or one text, as an array."""
    return F.coalesce(F.try_variant_get(col, "$", "array<string>"), F.array(F.try_variant_get(col, "$", "string")))


def atom_papers(spark: SparkSession, path: str) -> DataFrame:
    """Paper records of captured Atom feeds. Entries without an id go; a title's line breaks become spaces."""
    entries = spark.read.format("xml").option("rowTag", "entry").schema(_ATOM).load(path)
    names = F.filter(F.transform("author", lambda a: F.trim(a["name"])), lambda n: n != "")
    return entries.where(_clean(F.col("id")).isNotNull()).select(
        F.replace(F.trim("title"), F.lit("\n"), F.lit(" ")).alias("title"),
        F.when(F.size(names) > 0, names).alias("authors"),
        F.replace(F.trim("id"), F.lit("http://"), F.lit("https://")).alias("paper_url"),
        F.trim("published").alias("published_date"),
        F.lit(None).cast("string").alias("github_url"),
        F.lit(None).cast("int").alias("github_stars"),
    )


def feed_total(feed: Column) -> Column:
    """The number of results that a feed document announces."""
    return F.coalesce(F.nullif(F.regexp_extract(feed, r"totalResults[^>]*>\s*(\d+)\s*<", 1), F.lit("")).try_cast("int"), F.lit(0))


def unwrapped_feeds(spark: SparkSession, path: str) -> DataFrame:
    """(value) of captured feeds as a browser shows them: the text of the page's ``pre``, or the whole page where it has none."""
    raw = spark.read.text(path, wholetext=True)
    inner = F.regexp_extract("value", r"(?is)<pre[^>]*>(.*?)</pre>", 1)
    return raw.select(F.when(inner == "", F.col("value")).otherwise(html.unescape_all(inner)).alias("value"))


def rss_from_pages(spark: SparkSession, path: str, site: str) -> DataFrame:
    """The same columns as ``rss_items`` from feeds that a browser has captured."""
    items = unwrapped_feeds(spark, path).select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)(<item[ >].*?</item>)"), 1)).alias("x"))
    return _rss_rows(items.select(F.from_xml("x", _RSS).alias("i")).select("i.*"), site)


def rss_items(spark: SparkSession, path: str, site: str) -> DataFrame:
    """(title, url, raw_date, author, summary, categories) of captured RSS feeds; items need a title and a link."""
    return _rss_rows(spark.read.format("xml").option("rowTag", "item").schema(_RSS).load(path), site)


def _rss_rows(items: DataFrame, site: str) -> DataFrame:
    return (
        items.where(_clean(F.col("title")).isNotNull() & _clean(F.col("link")).isNotNull())
        .select(
            F.trim("title").alias("title"),
            F.trim("link").alias("url"),
            F.trim("pubDate").alias("raw_date"),
            F.coalesce(_clean(F.col("`dc:creator`")), F.lit(DEFAULT_AUTHORS.get(site))).alias("author"),
            "description",
            F.coalesce("category", F.array().cast("array<string>")).alias("categories"),
        )
        .withColumn("summary", html.html_text(F.col("description"), " "))
        .drop("description")
    )


def atom_items(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from captured Atom feeds: the alternate link, else any, else an id that is a URL; published, else updated."""
    entries = spark.read.format("xml").option("rowTag", "entry").schema(_ATOM).load(path)
    alternate = F.get(F.filter("link", lambda x: x["_rel"] == "alternate"), F.lit(0))["_href"]
    url = F.coalesce(alternate, F.get("link", F.lit(0))["_href"], F.when(F.col("id").startswith("http"), F.col("id")))
    found = entries.select(
        F.trim("title").alias("title"), F.trim(url).alias("url"), F.coalesce("published", "updated").alias("raw_date"), F.trim(F.get("author", F.lit(0))["name"]).alias("author"),
        F.coalesce("content", "summary").alias("_body"), F.array().cast("array<string>").alias("categories"),
    )
    found = found.where((F.col("title") != "") & (F.col("url") != ""))
    return found.withColumn("summary", html.html_text(F.col("_body"), " ")).drop("_body")


def relevant(items: DataFrame) -> DataFrame:
    return items.where(text.is_relevant(F.col("title"), F.col("categories")))


def with_article(items: DataFrame, pages: DataFrame, site: str) -> DataFrame:
    """items with full_text and content_type from captured article pages (url, html); short or missing articles fall back to the summary.

    Filter items before: the parser runs for every row that is left.
    """
    joined = items.join(pages.select("url", F.col("html").alias("_html")), "url", "left")
    body = joined.withColumn("_text", html.article_body_udf(site)(F.col("_html")))
    if site in html.AUTHOR_TAGS:
        body = body.withColumn("author", F.coalesce(html.article_author_udf(site)(F.col("_html")), "author"))
    whole = F.length("_text") >= html.MIN_ARTICLE
    return body.withColumns(
        {
            "full_text": F.when(whole, F.col("_text")).otherwise(F.coalesce(F.nullif("summary", F.lit("")), "title")),
            "content_type": F.when(whole, F.lit("FULL_TEXT")).otherwise(F.lit("SUMMARY")),
            "source_name": F.lit(NEWS_SITES[site]),
        }
    ).drop("_html", "_text")


def board_jobs(spark: SparkSession, path: str, board: str) -> DataFrame:
    """(title, company, job_url, raw_date, is_remote, role_family, description, source_name) of captured job-board replies.

    Rows without title, company or URL go; so does a reply's disclaimer object.
    """
    raw = spark.read.schema(_BOARDS[board]).json(path, multiLine=True)
    if board == "remoteok":
        jobs, tags = raw.where("position is not null"), _list(F.col("tags"))
        cols = ("position", "company", "url", F.coalesce("date", F.col("epoch").cast("string")), F.lit(True), F.concat_ws(" ", "position", F.array_join(tags, " ")), "description")
    elif board == "jobicy":
        jobs = raw.select(F.inline("jobs"))
        cols = ("jobTitle", "companyName", "url", "pubDate", F.lit(True), F.concat_ws(" ", "jobTitle", F.array_join(_list(F.col("jobIndustry")), " ")), "jobDescription")
    elif board == "arbeitnow":
        jobs = raw.select(F.inline("data"))
        cols = ("title", "company_name", "url", F.col("created_at").cast("string"), F.coalesce("remote", F.lit(False)), F.concat_ws(" ", "title", F.array_join(_list(F.col("tags")), " ")), "description")
    elif board == "remotive":
        jobs = raw.select(F.inline("jobs"))
        cols = ("title", "company_name", "url", "publication_date", F.lit(True), F.concat_ws(" ", "category", "title"), "description")
    else:
        raise ValueError(f"unknown board {board}")
    title, company, url, date, remote, words, body = cols
    found = jobs.select(
        _clean(F.col(title)).alias("title"), _clean(F.col(company)).alias("company"), _clean(F.col(url)).alias("job_url"), date.alias("raw_date") if isinstance(date, Column) else F.col(date).alias("raw_date"),
        remote.alias("is_remote"), text.role_family(words, board).alias("role_family"), F.col(body).alias("_html"), F.lit(BOARD_NAMES[board]).alias("source_name"),
    )
    found = found.where("title is not null and company is not null and job_url is not null")
    return found.withColumn("description", html.html_text(F.col("_html"), "\n")).drop("_html")


def latest_thread(spark: SparkSession, path: str) -> str | None:
    """The id of the first story of captured search replies, None where there is none: the thread whose comments are wanted."""
    hits = spark.read.schema("hits array<struct<objectID:string>>").json(path, multiLine=True).select(F.get("hits", F.lit(0))["objectID"].alias("id"))
    found = hits.where("id is not null").limit(1).collect()
    return found[0]["id"] if found else None


def hiring_comments(spark: SparkSession, path: str, story_id: int | str | None = None) -> DataFrame:
    """Job rows of captured comments of at least 30 characters whose header names a company; job_url is the comment's own page.

    With a story, only its top-level comments count; without one (a keyword search) all do. Comments without an id go.
    """
    schema = "hits array<struct<objectID:string,parent_id:bigint,created_at:string,created_at_i:bigint,comment_text:string>>"
    hits = spark.read.schema(schema).json(path, multiLine=True).select(F.inline("hits"))
    rows = hits.where((F.length("comment_text") >= 30) & (F.trim("objectID") != ""))
    if story_id is not None:
        rows = rows.where(F.col("parent_id") == int(story_id))
    url = F.concat(F.lit("https://news.ycombinator.com/item?id="), F.trim("objectID"))
    return parse_comments(rows.select("objectID", url.alias("job_url"), F.coalesce("created_at", F.col("created_at_i").cast("string")).alias("raw_date"), "comment_text"))


def parse_comments(rows: DataFrame) -> DataFrame:
    """Company, title, remote flag and role family from rows with a comment_text column; rows without a company go."""
    plain = rows.withColumn("_html", html.unescape_all(F.col("comment_text")))
    head = F.get(F.split("_html", r"(?i)<p>|<br\s*/?>"), F.lit(0))
    plain = plain.withColumns({"_header": html.html_text(head, " "), "description": html.html_text(F.col("_html"), "\n")}).drop("_html")
    named = plain.withColumns({"company": text.header_company(F.col("_header")), "title": text.header_title(F.col("_header"))}).where("company is not null")
    return named.withColumns(
        {"is_remote": text.is_remote(F.col("description")), "role_family": text.hiring_role_family(F.col("title"), F.col("description")), "source_name": F.lit("Hacker News Hiring")}
    ).drop("_header")


def directory_startups(spark: SparkSession, path: str) -> DataFrame:
    """Startup rows of captured directory replies: named, active, with a page of their own."""
    hits = spark.read.schema("hits array<struct<name:string,slug:string,team_size:string,status:string>>").json(path, multiLine=True).select(F.inline("hits"))
    return hits.where("name != '' and status = 'Active' and slug != ''").select(
        F.trim("name").alias("entity_name"),
        F.concat(F.lit("https://www.ycombinator.com/companies/"), "slug").alias("source_url"),
        text.team_size(F.col("team_size")).alias("employee_count"),
        F.lit("Y Combinator").alias("source_name"),
    )


def pages_of(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of captured pages, one file each; the file's path stands for the URL."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def category_slugs(pages: DataFrame) -> DataFrame:
    """(slug, position) of the products that category pages (url, html) link to, each once, at its first place."""
    links = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit(r"""<a\s[^>]*href\s*=\s*["']([^"']*)["']"""), 1)).alias("position", "href"))
    found = links.select(text.product_slug(F.col("href")).alias("slug"), F.struct("url", "position").alias("place")).where("slug is not null")
    return found.groupBy("slug").agg(F.min("place").alias("place")).select("slug", F.col("place.position").alias("position"))


def crawled_slugs(pages: DataFrame, limit: int | None = None, max_pages: int = 6) -> DataFrame:
    """(slug, place) of the products that crawled category pages (category, page, html) link to, each once, numbered from 0 in the order of first sight.

    Categories and pages count from 0. A category's pages count up to max_pages
    and end with the first one that shows nothing new in its category; the crawl
    ends with the category that brings the slugs to three times the limit.
    """
    links = pages.where(F.col("page") < max_pages).select(
        "category", "page", F.posexplode_outer(F.regexp_extract_all("html", F.lit(r"""<a\s[^>]*href\s*=\s*["']([^"']*)["']"""), 1)).alias("position", "href")
    )
    found = links.select("category", "page", "position", text.product_slug(F.col("href")).alias("slug"))
    first = found.where("slug is not null").groupBy("category", "slug").agg(F.min(F.struct("page", "position")).alias("at"))
    new = first.groupBy("category", F.col("at.page").alias("page")).agg(F.count("*").alias("new"))
    stale = pages.select("category", "page").join(new, ["category", "page"], "left").where("new is null").groupBy("category").agg(F.min("page").alias("end"))
    kept = first.join(stale, "category", "left").where(F.col("end").isNull() | (F.col("at.page") < F.col("end")))
    seen = kept.groupBy("slug").agg(F.min(F.struct("category", "at")).alias("at"))
    if limit is not None:
        # one row a category: how many slugs there were before it
        sums = seen.groupBy(F.col("at.category").alias("category")).agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(W.orderBy("category").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        open_ = sums.select("category", before.alias("before")).where(F.col("before") < 3 * limit).select("category")
        seen = seen.join(open_, F.col("at.category") == F.col("category"), "left_semi")
    ranked = group_ranks(seen.withColumn("_all", F.lit(0)), "_all", ["at"], Scratch(pages.sparkSession, "slugs"), rank="place")
    return ranked.select("slug", "place")


def products(pages: DataFrame) -> DataFrame:
    """Product rows of captured product pages (slug, html); pages without a name go. The product stands for its company."""
    found = pages.select("slug", html.product_page(F.col("html")).alias("p")).where("p.product_name is not null")
    labelled = F.get(F.filter(F.transform("p.labels", lambda x: text.pricing_model(x)), lambda m: m.isNotNull()), F.lit(0))
    offered = F.when((F.col("p.offer") == "0") | F.contains(F.lower("p.offer"), F.lit("free")), F.lit("FREE"))
    return found.select(
        F.col("p.product_name").alias("startup_name"), F.coalesce(labelled, offered).alias("pricing_model"),
        F.concat(F.lit("https://www.saashub.com/"), "slug").alias("source_url"), F.lit("SaaSHub").alias("source_name"),
    )


def papers(pages: DataFrame) -> DataFrame:
    """Paper rows of captured paper pages (url, html); the page's own URL stands in for a missing one."""
    found = pages.select("url", html.paper_page(F.col("html")).alias("p")).where("p.title is not null or p.paper_url is not null")
    return found.select("p.title", "p.authors", F.coalesce("p.paper_url", "url").alias("paper_url"), "p.published_date", "p.github_url")
