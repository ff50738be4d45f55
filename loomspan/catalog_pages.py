"""Named queries whose names and rows come from the pages and documents tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan import catalog
from loomspan.functions import names
from loomspan.operators import resolve
from loomspan.plans.components import components
from loomspan.plans.scratch import Scratch
from loomspan.streaming import ingest as streams

TITLE = r"(?s)<title>(.*?)</title>"


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as entities: (entity_id, clean_name, match_key) from their titles."""
    rows = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("page_id").alias("entity_id"), F.regexp_extract("html", TITLE, 1).alias("raw_name"))
    named = rows.withColumn("clean_name", names.display_name(F.col("raw_name")))
    return Scratch(spark, "titles").keep(named.select("entity_id", "clean_name", names.match_key(F.col("clean_name")).alias("match_key")))


def near_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Every page with the class of its title under confident fuzzy links, and how many other titles its own is linked with.

    Equal titles are one title; a page without one is linked with nothing.
    """
    pages = _titles(spark, sf)
    links = Scratch(spark, "links").keep(resolve.fuzzy_links(pages))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.groupBy(F.col("a").alias("first")).agg(F.count("*").alias("n_links"))
    found = components(links, label="titles").withColumnRenamed("id", "first")
    firsts = pages.where("clean_name != ''").groupBy("clean_name").agg(F.min("entity_id").alias("first"))
    classes = firsts.join(counts, "first", "left").join(found, "first", "left").select("clean_name", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    joined = pages.join(classes, "clean_name", "left")
    return joined.select(F.col("entity_id").alias("page_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "entity_id").alias("component_id"))


def borderline_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of different titles that share a block and are for an arbiter to decide."""
    found = resolve.borderline_pairs(_titles(spark, sf))
    return found.select(F.least("clean_a", "clean_b").alias("title_a"), F.greatest("clean_a", "clean_b").alias("title_b"), F.round("token_sort", 6).alias("token_sort"), F.round("ratio", 6).alias("ratio"))


def title_pair_reduction(spark: SparkSession, sf: str) -> DataFrame:
    found = resolve.pair_reduction(_titles(spark, sf))
    return found.select("entities", "pairs", F.round("reduction", 6).alias("reduction"))


def stream_page_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's URL once, as a stream inserts them into a bucketed table, with its first page's time."""
    rows = catalog._stream(spark, sf, "pages").select("url", F.timestamp_seconds(F.col("page_id")).alias("first_seen_at"))
    out = catalog.inserted(spark, rows, "seen_urls", "first_seen_at")
    return out.select("url", F.unix_timestamp("first_seen_at").alias("first_page"))


def stream_first_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every address (a URL without its query and fragment) once, with the time of its first page, from state that is kept for ever."""
    address = F.regexp_replace("url", "[?#].*$", "")
    rows = catalog._stream(spark, sf, "pages").select(address.alias("address"), F.timestamp_seconds(F.col("page_id")).alias("at"))
    out = catalog.streamed(spark, streams.stream_first_seen(rows, "address", "at"))
    return out.select(F.col("url").alias("address"), F.unix_timestamp("first_seen_at").alias("first_page"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (near_titles, borderline_titles, title_pair_reduction, stream_page_urls, stream_first_pages)}


def oracle_sql() -> dict[str, str]:
    titles = f"""t AS MATERIALIZED (SELECT page_id AS id, {catalog._sql_display("regexp_extract(html, '" + TITLE + "', 1)")} AS c FROM pages), e AS MATERIALIZED (SELECT id, c, {catalog._sql_key('c')} AS k FROM t)"""
    blocks = """b AS (SELECT id, 'key:' || k AS bk FROM e WHERE k <> '' UNION SELECT id, 'tok:' || unnest(regexp_extract_all(lower(c), '[a-z0-9]{3,}')) FROM e
        UNION SELECT id, 'pref:' || substr(k, 1, 3) FROM e WHERE length(k) >= 3),
        kept AS MATERIALIZED (SELECT * FROM b WHERE bk NOT IN (SELECT bk FROM b WHERE bk LIKE 'pref:%' GROUP BY bk HAVING count(*) > 500))"""
    tok = "array_to_string(list_sort(string_split({}, ' ')), ' ')".format

    def scored(percent: int) -> str:
        # the edit distance is no larger than the insert-delete distance, so it rules pairs out before they are scored
        return f"""u AS MATERIALIZED (SELECT min(id) AS id, c, k, {tok('c')} AS s FROM e WHERE c <> '' GROUP BY c, k),
            n AS MATERIALIZED (SELECT x.id AS a, y.id AS b, x.c AS ca, y.c AS cb, x.s AS sa, y.s AS sb FROM u x JOIN u y ON x.id < y.id AND x.k <> y.k AND levenshtein(x.s, y.s) <= {100 - percent} * (length(x.s) + length(y.s)) / 100
                WHERE EXISTS (SELECT 1 FROM kept p JOIN kept q ON p.bk = q.bk WHERE p.id = x.id AND q.id = y.id)),
            r AS MATERIALIZED (SELECT a, b, ca, cb, 200.0 * {catalog._sql_lcs('sa', 'sb')} / (length(sa) + length(sb)) AS token_sort, 200.0 * {catalog._sql_lcs('ca', 'cb')} / (length(ca) + length(cb)) AS ratio FROM n)"""

    return {
        "stream_page_urls": "SELECT url, min(page_id) AS first_page FROM pages WHERE url IS NOT NULL GROUP BY 1",
        "stream_first_pages": "SELECT regexp_replace(url, '[?#].*$', '') AS address, min(page_id) AS first_page FROM pages WHERE url IS NOT NULL GROUP BY 1",
        "near_titles": f"""WITH RECURSIVE {titles}, {blocks}, {scored(98)},
            l AS (SELECT a, b FROM r WHERE token_sort >= 98 AND ratio >= 98), d AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
            w(id, o) AS (SELECT id, id FROM u UNION SELECT w.id, d.b FROM w JOIN d ON d.a = w.o),
            m AS (SELECT u.c, count(DISTINCT d.b) AS n_links, min(w.o) AS component_id FROM u JOIN w USING (id) LEFT JOIN d ON d.a = u.id GROUP BY u.c)
            SELECT e.id AS page_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.id) AS component_id FROM e LEFT JOIN m USING (c)""",
        "borderline_titles": f"""WITH {titles}, {blocks}, {scored(75)}
            SELECT least(ca, cb) AS title_a, greatest(ca, cb) AS title_b, round(token_sort, 6) AS token_sort, round(ratio, 6) AS ratio FROM r WHERE token_sort >= 75 AND token_sort < 98""",
        "title_pair_reduction": f"""WITH {titles}, {blocks}, p AS (SELECT DISTINCT x.id AS a, y.id AS b FROM kept x JOIN kept y ON x.bk = y.bk AND x.id < y.id)
            SELECT n AS entities, p AS pairs, round(1 - p / greatest(n * (n - 1) / 2, 1), 6) AS reduction FROM (SELECT count(*) AS n FROM e), (SELECT count(*) AS p FROM p)""",
    }
