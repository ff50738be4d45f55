"""The engine's named queries over the driver's tables, and their SQL counterparts for DuckDB.

The tables hold no companies, feeds or job posts, so inputs of those kinds are
composed from their columns by fixed expressions, the same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import dates, html, names, similarity, text
from loomspan.operators import export, ingest, resolve
from loomspan.plans.components import components
from loomspan.plans.scratch import Scratch
from loomspan.sources import captures
from loomspan.sources.seed import SEED
from loomspan.streaming import bucketed
from loomspan.streaming import ingest as streams

NOW = "2024-01-30 00:00:00"
SUFFIXES = ["", ", Inc.", " LLC", " GmbH", " Technologies", " Software Group"]
LABELS = ["Free", "Open Source", "Free Trial", "14-day free trial", "Paid plans", "Enterprise", "contact us", "subscription"]
# the references that the tables' names could hold; the SQL needs no others
REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
TITLES = ["Senior Software Engineer", "Remote", "$120k", "Data Wizard", "https://jobs.example.com", "Head of Sales", "python", "full-time"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _now() -> Column:
    return F.lit(NOW).cast("timestamp")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Startups, products and jobs composed from supplier, part and customer."""
    supplier, part, customer = (_t(spark, sf, x) for x in ("supplier", "part", "customer"))
    seeds = [name for name, _, _ in SEED]
    return {
        "startups": supplier.select(
            F.col("s_suppkey").alias("id"), F.concat(_pick(seeds, F.col("s_suppkey")), _pick(SUFFIXES, F.col("s_nationkey"))).alias("entity_name"), F.lit("Y Combinator").alias("source_name"),
            F.concat(F.lit("https://directory.example/"), F.col("s_suppkey").cast("string")).alias("source_url"), F.col("s_nationkey").alias("employee_count"),
        ),
        "products": part.select(
            F.col("p_partkey").alias("id"), F.concat(F.col("p_name"), _pick(SUFFIXES, F.col("p_partkey"))).alias("startup_name"), F.lit("SaaSHub").alias("source_name"),
            F.concat(F.lit("https://products.example/"), F.col("p_partkey").cast("string")).alias("source_url"), text.pricing_model(_pick(LABELS, F.col("p_size"))).alias("pricing_model"),
        ),
        "jobs": customer.select(
            F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 11 == 0, F.lit("  ")).otherwise(F.concat(F.col("c_name"), _pick(SUFFIXES, F.col("c_nationkey")))).alias("company"),
            F.lit(None).cast("string").alias("source_name"), F.concat(F.lit("https://jobs.example/"), F.col("c_custkey").cast("string")).alias("source_url"),
        ),
    }


# ---- SQL counterparts of shared pieces


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_pick(values: list[str], index: str) -> str:
    return f"([{', '.join(map(_quote, values))}])[({index}) % {len(values)} + 1]"


def _sql_display(x: str) -> str:
    out = x
    for reference, value in REFERENCES:
        out = f"replace({out}, {_quote(reference)}, {_quote(value)})"
    out = f"regexp_replace(regexp_replace(trim({out}), '(?i)^https?://', ''), '(?i)^www\\.', '')"
    out = f"trim(split_part({out}, '/', 1))"
    out = f"list_transform([{out}], lambda t: CASE WHEN contains(t, '.') AND NOT regexp_matches(t, '\\s') THEN regexp_replace(t, '{names.DOMAIN_PATTERN}', '') ELSE t END)[1]"
    out = f"trim(regexp_replace({out}, '{names.LEGAL_PATTERN}', '', 'g'))"
    out = f"trim(regexp_replace({out}, '{names.EDGE_PATTERN}', '', 'g'))"
    out = f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"
    return f"coalesce(nullif({out}, ''), trim({x}), '')"


def _sql_key(x: str) -> str:
    return f"lower(regexp_replace({_sql_display(x)}, '[^a-zA-Z0-9]', '', 'g'))"


def _sql_seed_key(x: str) -> str:
    out = f"regexp_replace(regexp_replace(lower(trim(coalesce({x}, ''))), '^https?://', ''), '^www\\.', '')"
    return f"regexp_replace(regexp_replace(split_part({out}, '/', 1), '{names.SEED_PATTERN}', '', 'g'), '[^a-z0-9]', '', 'g')"


def _sql_seeds() -> str:
    rows = ", ".join(f"({i}, {_quote(n)}, {_quote(f)})" for i, (n, d, more) in enumerate(SEED) for f in (n, d, *more))
    return f"SELECT {_sql_seed_key('form')} AS seed_key, arg_max(canonical, i) AS canonical FROM (VALUES {rows}) AS v(i, canonical, form) GROUP BY 1 HAVING seed_key <> ''"


def _sql_tables() -> str:
    seeds = [n for n, _, _ in SEED]
    return f"""
    startups AS (SELECT s_suppkey AS id, {_sql_pick(seeds, 's_suppkey')} || {_sql_pick(SUFFIXES, 's_nationkey')} AS entity_name, 'Y Combinator' AS source_name,
        'https://directory.example/' || s_suppkey AS source_url, s_nationkey AS employee_count FROM supplier),
    products AS (SELECT p_partkey AS id, p_name || {_sql_pick(SUFFIXES, 'p_partkey')} AS startup_name, 'SaaSHub' AS source_name,
        'https://products.example/' || p_partkey AS source_url, {_sql_pricing(_sql_pick(LABELS, 'p_size'))} AS pricing_model FROM part),
    jobs AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN '  ' ELSE c_name || {_sql_pick(SUFFIXES, 'c_nationkey')} END AS company,
        NULL::VARCHAR AS source_name, 'https://jobs.example/' || c_custkey AS source_url FROM customer)"""


def _sql_entities() -> str:
    """CTEs up to ``scoped``: the union of the three branches."""
    branches = [
        f"SELECT {b}::BIGINT << 56 | id AS entity_id, {col} AS raw_name, '{kind}' AS entity_type, coalesce(nullif(source_name, ''), '{source}') AS source_name, source_url FROM {table} WHERE trim({col}) <> ''"
        for b, (table, col, kind, source) in enumerate(resolve.SCOPES)
    ]
    return f"{_sql_tables()}, scoped AS ({' UNION ALL '.join(branches)})"


def _sql_resolved() -> str:
    """CTEs up to ``log``: seed and key links only, which is all that these names give; a key belongs to one seed at most."""
    return f"""{_sql_entities()}, seeds AS ({_sql_seeds()}),
    named AS (SELECT *, {_sql_display('raw_name')} AS clean_name FROM scoped),
    keyed AS (SELECT *, {_sql_key('clean_name')} AS match_key FROM named),
    seeded AS (SELECT k.*, coalesce(r.canonical, c.canonical) AS seed FROM keyed k LEFT JOIN seeds r ON r.seed_key = {_sql_seed_key('raw_name')} LEFT JOIN seeds c ON c.seed_key = {_sql_seed_key('clean_name')}),
    grouped AS (SELECT *, coalesce('s:' || max(seed) OVER (PARTITION BY match_key), 'k:' || match_key) AS g FROM seeded),
    freq AS (SELECT g, clean_name, count(*) AS n FROM grouped WHERE clean_name <> '' GROUP BY ALL),
    usual AS (SELECT g, clean_name AS c FROM freq QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC, length(clean_name), clean_name) = 1),
    votes AS (SELECT g, count(*) AS members, arg_min(seed, entity_id) FILTER (seed IS NOT NULL) AS s, arg_min(clean_name, entity_id) FILTER (clean_name <> '' AND source_name = 'Y Combinator') AS y,
        arg_min(clean_name, entity_id) FILTER (clean_name <> '' AND source_name = 'SaaSHub') AS h, arg_min(raw_name, entity_id) AS r FROM grouped GROUP BY g),
    elected AS (SELECT v.g, members, coalesce(s, y, h, c, r) AS canonical_name FROM votes v LEFT JOIN usual u ON u.g = v.g),
    log AS (SELECT entity_id, raw_name, canonical_name, entity_type,
        CASE WHEN seed IS NOT NULL THEN 'SEED_LIST_MATCH' WHEN members = 1 THEN 'CANONICAL_SINGLETON' WHEN lower(clean_name) = lower(canonical_name) THEN 'EXACT_NORMALIZED' ELSE 'FUZZY_CONFIDENT' END AS match_method,
        CASE WHEN match_method = 'FUZZY_CONFIDENT' THEN 0.95::DOUBLE ELSE 1.0::DOUBLE END AS confidence, source_name, source_url, {_sql_why()} AS explanation FROM grouped JOIN elected USING (g))"""


def _sql_why() -> str:
    """The explanation of a row of the mapping log, from members, seed, clean_name and canonical_name."""
    named = "'{}''' || {} || '''{}'".format
    return (
        f"CASE WHEN members = 1 AND seed IS NOT NULL THEN {named('Matched Tier 0 AI Startup Seed List canonical ', 'seed', '')} WHEN members = 1 THEN 'Unique entity representation' "
        f"WHEN seed IS NOT NULL THEN {named('Merged into Seed List canonical ', 'canonical_name', '')} "
        f"WHEN lower(clean_name) = lower(canonical_name) THEN {named('Identical to canonical entity name ', 'canonical_name', '')} "
        f"ELSE {named('Resolved to canonical entity ', 'canonical_name', ' via cluster similarity')} END"
    )


def _sql_pieces(x: str) -> str:
    """The pieces of text between tags, with the character references that the pages hold decoded, without white space around them and without empty ones."""
    decoded = "regexp_replace(replace(replace(replace(t, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')"
    return f"list_filter(list_transform(string_split_regex({x}, '<[^>]*>'), lambda t: regexp_replace({decoded}, '^\\s+|\\s+$', '', 'g')), lambda t: t <> '')"


def _sql_pricing(x: str) -> str:
    whens = " ".join(f"WHEN contains(lower(trim(l)), {_quote(k)}) THEN {_quote(v)}" for k, v in text.PRICING.items())
    exact = " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in text.PRICING.items())
    return f"list_transform([{x}], lambda l: coalesce(CASE lower(trim(l)) {exact} END, CASE {whens} END))[1]"


def _sql_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {_quote(w)})" for w in words) + ")"


def _sql_lcs(a: str, b: str) -> str:
    """Longest common subsequence of two columns, one list a row of the dynamic program."""
    zeros = f"list_transform(range(length({b})), lambda i: 0)"
    return f"""coalesce(list_max(list_reduce(list_prepend({zeros}, list_transform(range(1, length({a}) + 1), lambda i: [i])), lambda row, x:
        list_reduce(list_prepend([]::INTEGER[], list_transform(range(1, length({b}) + 1), lambda j: [j])), lambda done, j:
            list_append(done, CASE WHEN substr({a}, x[1]::BIGINT, 1) = substr({b}, j[1]::BIGINT, 1) THEN coalesce(row[j[1] - 1], 0) + 1 ELSE greatest(row[j[1]], coalesce(done[j[1] - 1], 0)) END)))), 0)"""


# ---- queries


def freshness_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).where(dates.is_fresh(F.col("ts"), _now()))
    return rows.select("event_id", "user_id", "event_type", dates.iso_utc(F.col("ts")).alias("at"))


def first_seen_state(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    seen = events.where("ts < '2024-01-15'").groupBy(F.col("user_id").cast("string").alias("url")).agg(F.min("ts").alias("first_seen_at"))
    raw = F.when(F.col("event_id") % 3 == 0, dates.iso_utc(F.col("ts"))).when(F.col("event_id") % 3 == 1, F.lit("soon"))
    rows = events.withColumn("url", F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("string")))
    return ingest.judge_freshness(rows, raw, "url", seen, _now()).select("event_id", "fresh", "published_date")


def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf).select("event_id", "user_id", F.when(F.col("event_id") % 50 != 0, F.col("event_type")).alias("event_type"), F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"), "ts")
    new, old = events.where("ts >= '2024-01-03'").drop("ts"), events.where("ts < '2024-01-03'")
    return ingest.insert_ignore(new, ["user_id", "event_type"], ["value"], "event_id", old)


def union_scoped(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.scoped_entities(_tables(spark, sf))


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name in ("region", "nation", "customer", "supplier", "part", "orders"):
        one = _t(spark, sf, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").orderBy(F.desc("o_orderkey")).limit(50).select("o_orderkey", "o_custkey", "o_orderstatus")


def stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    fresh = dates.is_fresh(F.col("ts"), _now())
    return ingest.stage_counts(_events(spark, sf), "event_type", {"raw_fetched": F.lit(True), "survived": fresh, "saved": fresh & (F.col("value") > 10)})


def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    ts, k = F.col("ts"), F.col("event_id") % 13
    week = F.concat(F.year("ts"), F.lit("-W"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"), F.lit("-"), (F.weekday("ts") + 1).cast("string"))
    raw = (
        F.when(k == 0, F.unix_timestamp(ts).cast("string"))
        .when(k == 1, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0000'"))
        .when(k == 2, F.date_format(ts, "dd MMM yyyy HH:mm:ss 'EST'"))
        .when(k == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'-04:00'"))
        .when(k == 5, F.date_format(ts, "yyyy-MM-dd"))
        .when(k == 6, F.concat(F.col("user_id").cast("string"), F.lit(" hours ago")))
        .when(k == 7, F.date_format(ts, "dd MMM yy HH:mm:ss"))
        .when(k == 8, F.date_format(ts, "EEE MMM d HH:mm:ss yyyy"))
        .when(k == 9, F.date_format(ts, "yyyyMMdd'T'HHmmss'+0200'"))
        .when(k == 10, F.date_format(ts, "yyyy-MM-dd HH"))
        .when((k == 11) & (F.year(F.date_trunc("week", ts) + F.expr("INTERVAL 3 DAYS")) == F.year("ts")), week)
        .otherwise(F.lit("not a date"))
    )
    return _events(spark, sf).select("event_id", dates.iso_utc(dates.parse_datetime(raw, _now())).alias("parsed"))


def normalize_entity(spark: SparkSession, sf: str) -> DataFrame:
    rows = resolve.scoped_entities(_tables(spark, sf)).withColumn("clean_name", names.display_name(F.col("raw_name")))
    return rows.select("entity_id", "clean_name", names.match_key(F.col("clean_name")).alias("match_key"))


def seed_matches(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.normalise(resolve.scoped_entities(_tables(spark, sf))).select("entity_id", "seed_canonical")


def _products_named(spark: SparkSession, sf: str) -> DataFrame:
    """One entity for each distinct part name, in normal form."""
    rows = _t(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("entity_id"))
    clean = names.display_name(F.col("p_name"))
    return rows.select("entity_id", clean.alias("clean_name"), names.match_key(clean).alias("match_key"))


def blocking_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.candidate_pairs(_products_named(spark, sf))


def blocking_prefix_cap(spark: SparkSession, sf: str) -> DataFrame:
    customers = _t(spark, sf, "customer")
    rows = customers.select(F.col("c_custkey").alias("entity_id"), names.display_name(F.col("c_name")).alias("clean_name"), names.match_key(F.col("c_name")).alias("match_key"))
    return resolve.block_index(rows).groupBy("block_key").agg(F.count("*").alias("members"))


def similarity_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = _products_named(spark, sf)
    a, b = (rows.select(F.col("entity_id").alias(f"id_{x}"), F.col("clean_name").alias(f"clean_{x}")) for x in "ab")
    pairs = resolve.candidate_pairs(rows).join(a, "id_a").join(b, "id_b")
    scored = resolve.score_pairs(pairs)
    return scored.select("id_a", "id_b", F.round("ratio", 6).alias("ratio"), F.round("token_sort", 6).alias("token_sort"), "tier")


def connected_components(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer linked with the next one; where a nation's key is divisible by five the link has no end."""
    rows = _t(spark, sf, "customer")
    return components(rows.select(F.col("c_custkey").alias("a"), F.when(F.col("c_nationkey") % 5 != 0, F.col("c_custkey") + 1).alias("b")))


def entity_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve(resolve.scoped_entities(_tables(spark, sf)))


def resolution_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Names that only the fuzzy tier or an arbiter's decision can join: long names in pairs that differ in one letter, and short ones in pairs of two words of which the second differs."""
    part = _t(spark, sf, "part").select("p_partkey").distinct().withColumn("j", F.floor(F.col("p_partkey") / 2).cast("string"))
    odd = F.col("p_partkey") % 2 == 1

    def digest(*more: str | Column) -> Column:
        return F.md5(F.concat("j", *[F.lit(x) if isinstance(x, str) else x for x in more]).cast("binary"))

    long = F.concat(digest("a"), F.lit(" "), digest("b"), F.when(odd, F.lit("x")).otherwise(F.lit("y")))
    short = F.concat(digest("c"), F.lit(" "), F.substring(digest(F.when(odd, F.lit("d")).otherwise(F.lit("e"))), 1, 8))
    rows = part.select("j", F.col("p_partkey").cast("long").alias("id"), F.array(long, short).alias("names"))
    entities = rows.select("id", F.posexplode("names").alias("k", "raw_name")).select(
        (F.col("id") * 2 + F.col("k")).alias("entity_id"), "raw_name", F.lit("JOB").alias("entity_type"), F.lit("Job Board").alias("source_name"), F.lit("https://names.example").alias("source_url")
    )
    pairs = rows.groupBy("j").agg(F.min(F.col("names")[1]).alias("clean_a"), F.max(F.col("names")[1]).alias("clean_b")).where("clean_a != clean_b")
    decisions = pairs.select("clean_a", "clean_b", (F.col("j").cast("long") % 2 == 0).alias("is_same"))
    return resolve.resolve(entities, decisions).select("entity_id", "raw_name", "canonical_name", "match_method", "confidence", "explanation")


def mappings_like(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.mappings_like(entity_resolution(spark, sf), "AI")


def saved_total(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.saved_total(stage_metrics(spark, sf))


def insert_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The first 25 rows of a source that are saved."""
    events = _events(spark, sf).select("event_id", "user_id", "event_type", "value", "ts")
    new, old = events.where("ts >= '2024-01-03'").drop("ts"), events.where("ts < '2024-01-03'")
    return ingest.insert_ignore(new, ["user_id", "event_type"], ["value"], "event_id", old, limit=25)


def authors_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    return rows.select("n_regionkey", text.authors_json(F.when(F.col("n_regionkey") < 4, F.col("names"))).alias("authors"))


def save_resolve_export(spark: SparkSession, sf: str) -> DataFrame:
    """Startups, products and jobs saved twice, read back, resolved, logged and read as the log's tab."""
    found, root, at = _tables(spark, sf), Scratch(spark, "saved").root, F.lit(NOW).cast("timestamp")
    none = F.lit(None).cast("string")
    found["jobs"] = found["jobs"].withColumns({"source_name": F.lit(""), "title": none, "published_date": at, "is_remote": F.lit(True), "role_family": none, "job_url": F.col("source_url"), "description": none})
    for name, rows in found.items():
        for _ in range(2):
            ingest.save(rows, name, f"{root}/{name}", "id", at)
    saved = {name: spark.read.parquet(f"{root}/{name}") for name in found}
    resolve.save_mappings(resolve.resolve(resolve.scoped_entities(saved)), f"{root}/log", at)
    return export.tab(spark.read.parquet(f"{root}/log"), "entity_mapping_log")


def canonical_election(spark: SparkSession, sf: str) -> DataFrame:
    log = entity_resolution(spark, sf)
    return log.groupBy("canonical_name").agg(F.count("*").alias("members"), F.min("entity_id").alias("first_id"))


def mapping_summary(spark: SparkSession, sf: str) -> DataFrame:
    log = resolve.resolve(resolve.scoped_entities(_tables(spark, sf)))
    return resolve.method_summary(log)


def compression(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.compression(entity_resolution(spark, sf))


def variant_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.variant_clusters(entity_resolution(spark, sf))


def pair_reduction(spark: SparkSession, sf: str) -> DataFrame:
    found = resolve.pair_reduction(_products_named(spark, sf))
    return found.select("entities", "pairs", F.round("reduction", 6).alias("reduction"))


def _role_family(board: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _t(spark, sf, "conversations").select("conv_id", "turn", text.role_family(F.col("text"), board).alias("role_family"))

    return run


def role_family_hiring(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "conversations")
    return rows.select("conv_id", "turn", text.hiring_role_family(F.col("role"), F.col("text")).alias("role_family"), text.is_remote(F.col("text")).alias("is_remote"))


def relevance_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = _t(spark, sf, "documents")
    return docs.where(text.is_relevant(F.col("text"), F.array("source"))).select("doc_id")


def pricing_models(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "part").select("p_partkey", text.pricing_model(_pick(LABELS, F.col("p_partkey"))).alias("pricing_model"))


def team_sizes(spark: SparkSession, sf: str) -> DataFrame:
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    raw = F.when(k == 0, size).when(k == 1, F.concat(F.lit("1-"), size)).when(k == 2, F.concat(size, F.lit("+"))).when(k == 3, F.lit("n/a"))
    return _t(spark, sf, "part").select("p_partkey", text.team_size(raw).alias("employee_count"))


def header_fields(spark: SparkSession, sf: str) -> DataFrame:
    header = F.concat(F.col("c_name"), F.lit(" | "), _pick(TITLES, F.col("c_custkey")), F.lit(" | "), _pick(TITLES, F.col("c_nationkey")))
    header = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("Hello from "), header)).when(F.col("c_custkey") % 10 == 0, F.col("c_name")).otherwise(header)
    return _t(spark, sf, "customer").select("c_custkey", text.header_company(header).alias("company"), text.header_title(header).alias("title"))


def chunk_html(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "pages").select("page_id", F.md5(text.chunk_html(F.col("html")).cast("binary")).alias("chunk_md5"))


def chunk_comment(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "pages").select("page_id", F.md5(text.chunk_comment(F.col("html")).cast("binary")).alias("chunk_md5"))


def chunk_article(spark: SparkSession, sf: str) -> DataFrame:
    body = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return _t(spark, sf, "documents").select("doc_id", F.md5(text.chunk_article(body, F.col("source")).cast("binary")).alias("chunk_md5"))


def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    pages = _t(spark, sf, "pages")
    return captures.papers(pages.select("page_id", "url", "html").withColumn("url", F.concat(F.col("page_id").cast("string"), F.lit("@"), F.col("url")))).select("title", "paper_url")


def article_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    body = html.article_body_udf("wired")(F.col("html"))
    return _t(spark, sf, "pages").select("page_id", body.alias("body"))


def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "pages").select("page_id", html.html_text(F.col("html"), " ").alias("text"))


def hiring_posts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "conversations").withColumn("comment_text", F.concat(F.lit("Acme "), F.col("conv_id").cast("string"), F.lit(" | "), _pick(TITLES, F.col("turn")), F.lit("<p>"), F.col("text")))
    return captures.parse_comments(rows).select("conv_id", "turn", "company", "title", "is_remote", "role_family")


def url_rules(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    arxiv = F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("https://arxiv.org/abs/24.")).otherwise(F.lit("https://papers.example/")), key, F.lit("v3"))
    repo = F.concat(F.lit("https://GitHub.com/owner"), key, F.lit("/repo"), F.when(F.col("page_id") % 3 == 0, F.lit(".git")).otherwise(F.lit("?tab=1")))
    link = F.concat(F.lit("/tool"), key, F.when(F.col("page_id") % 4 == 0, F.lit("")).otherwise(F.lit("-alternatives")))
    return _t(spark, sf, "pages").select("page_id", text.paper_url(arxiv).alias("paper_url"), text.repo_owner(repo).alias("owner"), text.repo_name(repo).alias("repo"), text.product_slug(link).alias("slug"))


def category_slugs(spark: SparkSession, sf: str) -> DataFrame:
    pages = _t(spark, sf, "pages").select("url", F.replace(F.col("html"), F.lit('">'), F.lit('-alternatives">')).alias("html"))
    return captures.category_slugs(pages).select("slug")


def json_replies(spark: SparkSession, sf: str) -> DataFrame:
    k, props = F.col("event_id") % 4, F.col("props")
    raw = F.when(k == 0, props).when(k == 1, F.concat(F.lit("```json\n"), props, F.lit("\n```"))).when(k == 2, F.concat(F.lit("Sure: "), props, F.lit(" done"))).otherwise(F.concat(F.lit("none {"), props))
    return _t(spark, sf, "events").select("event_id", text.reply_json(raw).alias("reply"))


def author_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "nation").groupBy("n_regionkey").agg(F.to_json(F.array_sort(F.collect_list(F.concat(F.lit(" "), "n_name")))).alias("authors"))
    return rows.select("n_regionkey", text.authors_text(F.col("authors")).alias("authors"))


def enrich_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customers; every third customer's key is unknown."""
    stars = _t(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("o_custkey"), "c_name", "c_nationkey")
    return ingest.enrich(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), stars, "o_custkey", ["c_name", "c_nationkey"])


def _export(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return export.tab(_export_input(spark, sf, table), table)

    return run


def _export_input(spark: SparkSession, sf: str, table: str) -> DataFrame:
    none, when = F.lit(None).cast("string"), F.lit(NOW).cast("timestamp")
    if table in ("startups", "products"):
        rows = _tables(spark, sf)[table]
        rows = rows.withColumn("employee_count", F.when(F.col("id") % 4 != 0, F.col("employee_count"))) if table == "startups" else rows
        return rows.withColumns({"schema_version": F.lit("1.0"), "record_type": none, "collected_at": when})
    if table == "research_papers":
        rows = _t(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("authors"))
        return rows.select(
            F.col("n_regionkey").cast("long").alias("id"), none.alias("schema_version"), none.alias("record_type"), F.lit("arXiv").alias("source_name"), F.concat(F.lit("https://arxiv.org/abs/"), F.col("n_regionkey").cast("string")).alias("paper_url"),
            F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("title"), "authors", none.alias("github_url"), F.when(F.col("n_regionkey") > 2, F.col("n_regionkey")).alias("github_stars"), F.lit("2024-01-01").alias("published_date"), when.alias("collected_at"),
        )
    if table == "jobs":
        docs = _t(spark, sf, "documents")
        return docs.select(
            F.col("doc_id").alias("id"), none.alias("schema_version"), F.lit("JOB").alias("record_type"), F.col("source").alias("source_name"), F.lit("https://board.example").alias("source_url"), none.alias("title"), F.col("lang").alias("company"),
            when.alias("published_date"), (F.col("doc_id") % 2 == 0).alias("is_remote"), text.role_family(F.col("text"), "remotive").alias("role_family"), F.concat(F.lit("https://board.example/"), F.col("doc_id").cast("string")).alias("job_url"), F.col("text").alias("description"), when.alias("collected_at"),
        )
    if table == "news":
        docs = _t(spark, sf, "documents")
        return docs.select(
            F.col("doc_id").alias("id"), none.alias("schema_version"), none.alias("record_type"), F.col("source").alias("source_name"), none.alias("source_url"), F.col("lang").alias("title"), F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"), when.alias("published_date"),
            none.alias("author"), F.lit("").alias("summary"), F.col("text").alias("full_text"), F.when(F.col("doc_id") % 3 == 0, F.lit("SUMMARY")).alias("content_type"), when.alias("collected_at"),
        )
    log = resolve.resolve(resolve.scoped_entities(_tables(spark, sf)))
    return log.withColumn("resolved_at", when).withColumnRenamed("entity_id", "id")


def nested_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = _export_input(spark, sf, "startups").withColumn("collected_at", F.lit("2024-01-30T00:00:00Z"))
    return export.record_lines(rows, "STARTUP")


def nested_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Records of all five types as JSON lines."""
    out = None
    for table, kind in (("startups", "STARTUP"), ("products", "PRODUCT"), ("research_papers", "RESEARCH_PAPER"), ("jobs", "JOB"), ("news", "NEWS")):
        rows = _export_input(spark, sf, table).withColumn("collected_at", F.lit("2024-01-30T00:00:00Z"))
        if table in ("jobs", "news"):
            rows = rows.withColumn("published_date", dates.iso_utc(F.col("published_date")))
        lines = export.record_lines(rows, kind)
        out = lines if out is None else out.unionByName(lines)
    return out


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = _t(spark, sf, name).schema
    # the last letter in brackets makes the path a pattern, which the stream source takes for a file as well as for a folder
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def stream_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stream(spark, sf, "events").select(F.col("user_id").cast("string").alias("url"), F.col("ts").cast("timestamp").alias("ts"))
    out = streamed(spark, streams.stream_first_seen(rows, "url", "ts"))
    return out.select("url", dates.iso_utc(F.col("first_seen_at")).alias("first_seen_at"))


def streamed(spark: SparkSession, found: DataFrame) -> DataFrame:
    """All that a stream gives until its input ends, as its files hold it."""
    scratch = Scratch(spark, "stream")
    started = found.writeStream.format("parquet").option("path", f"{scratch.root}/out").option("checkpointLocation", f"{scratch.root}/state").trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{scratch.root}/out")


def stream_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stream(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.col("ts").cast("timestamp").alias("first_seen_at"))
    out = inserted(spark, rows, "seen_urls", "first_seen_at")
    return out.select("url", dates.iso_utc(F.col("first_seen_at")).alias("first_seen_at"))


def inserted(spark: SparkSession, rows: DataFrame, table: str, arrival: str) -> DataFrame:
    """What a stream of rows leaves in an empty bucketed table."""
    scratch = Scratch(spark, "stream")
    started = (
        rows.writeStream.foreachBatch(bucketed.insert_ignore_batches(f"{scratch.root}/out", table, arrival))
        .option("checkpointLocation", f"{scratch.root}/state")
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return bucketed.BucketedTable(spark, f"{scratch.root}/out", table).read(rows.schema)


TABS = ("startups", "products", "research_papers", "jobs", "news", "entity_mapping_log")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = [
        freshness_filter, first_seen_state, insert_ignore, union_scoped, table_counts, recent_rows, stage_metrics, parse_dates, normalize_entity, seed_matches, blocking_pairs, blocking_prefix_cap, similarity_scores,
        connected_components, entity_resolution, resolution_tiers, mappings_like, saved_total, insert_limited, authors_json, save_resolve_export, canonical_election, mapping_summary, compression, variant_clusters, pair_reduction, role_family_hiring, relevance_filter, pricing_models, team_sizes, header_fields,
        chunk_html, chunk_comment, chunk_article, page_titles, article_paragraphs, page_texts, hiring_posts, url_rules, category_slugs, json_replies, author_lists, enrich_join, nested_records, nested_lines, stream_first_seen, stream_insert_ignore,
    ]
    out = {f.__name__: f for f in plain}
    out |= {f"role_family_{board}": _role_family(board) for board in text.ROLE_KEYWORDS}
    from loomspan import catalog_pages

    return out | {f"export_{table}": _export(table) for table in TABS} | catalog_pages.queries()


def oracle_sql() -> dict[str, str]:
    fresh = f"ts BETWEEN TIMESTAMP '{NOW}' - INTERVAL 24 HOURS AND TIMESTAMP '{NOW}' + INTERVAL 1 HOUR"
    iso = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')".format
    at = iso(f"TIMESTAMP '{NOW}'")
    word = lambda words: rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(words)})($|[^\p{{L}}\p{{N}}_])"
    low = "lower(coalesce(role, '') || ' ' || substr(text, 1, 400))"
    part_names = f"WITH e AS (SELECT min(p_partkey) AS id, {_sql_display('p_name')} AS c, {_sql_key('p_name')} AS k FROM part GROUP BY p_name)"
    blocks = """, b AS (SELECT id, 'key:' || k AS bk FROM e WHERE k <> '' UNION SELECT id, 'tok:' || unnest(regexp_extract_all(lower(c), '[a-z0-9]{3,}')) FROM e
        UNION SELECT id, 'pref:' || substr(k, 1, 3) FROM e WHERE length(k) >= 3),
        kept AS (SELECT * FROM b WHERE bk NOT IN (SELECT bk FROM b WHERE bk LIKE 'pref:%' GROUP BY bk HAVING count(*) > 500)),
        pairs AS (SELECT DISTINCT x.id AS id_a, y.id AS id_b FROM kept x JOIN kept y ON x.bk = y.bk AND x.id < y.id)"""
    tok = "array_to_string(list_sort(string_split({}, ' ')), ' ')".format
    titled = f"list_filter(parts[2:], lambda p: {_sql_title('p')})"
    tab = lambda cells, source: "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in cells.items()) + f" FROM {source}"
    head = lambda kind, source: {"schemaVersion": "'1.0'", "recordType": f"'{kind}'", "source.name": source}
    cut = lambda n: f"CASE WHEN length(text) > {n} THEN substr(text, 1, {n}) || '...' ELSE text END"
    out = {
        "freshness_filter": f"SELECT event_id, user_id, event_type, {iso('ts')} AS at FROM events WHERE {fresh}",
        "first_seen_state": f"""
            WITH seen AS (SELECT user_id, min(ts) AS f FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
            d AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) END AS own, event_id % 7 <> 0 AS named, s.f FROM events e LEFT JOIN seen s ON s.user_id = e.user_id AND e.event_id % 7 <> 0),
            r AS (SELECT event_id, coalesce(own, CASE WHEN named THEN coalesce(f, TIMESTAMP '{NOW}') END) AS ts FROM d)
            SELECT event_id, coalesce({fresh}, false) AS fresh, {iso('ts')} AS published_date FROM r""",
        "insert_ignore": """
            WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 13 <> 0 THEN value END AS value, ts FROM events),
            n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM e WHERE ts >= TIMESTAMP '2024-01-03' AND value IS NOT NULL)
            SELECT event_id, user_id, event_type, value FROM n WHERE user_id IS NULL OR event_type IS NULL
                OR (rn = 1 AND NOT EXISTS (SELECT 1 FROM e o WHERE o.ts < TIMESTAMP '2024-01-03' AND o.user_id = n.user_id AND o.event_type = n.event_type))""",
        "union_scoped": f"WITH {_sql_entities()} SELECT * FROM scoped",
        "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders")),
        "recent_rows": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey DESC LIMIT 50",
        "stage_metrics": f"SELECT event_type, count(*) AS raw_fetched, count(*) FILTER ({fresh}) AS survived, count(*) FILTER ({fresh} AND value > 10) AS saved FROM events GROUP BY 1",
        "parse_dates": f"""SELECT event_id, {iso(f'''CASE event_id % 13 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN ts + INTERVAL 5 HOURS WHEN 3 THEN ts WHEN 4 THEN ts + INTERVAL 4 HOURS
            WHEN 5 THEN date_trunc('day', ts) WHEN 6 THEN TIMESTAMP '{NOW}' - to_hours(user_id)
            WHEN 7 THEN ts WHEN 8 THEN ts WHEN 9 THEN ts - INTERVAL 2 HOURS WHEN 10 THEN date_trunc('hour', ts) WHEN 11 THEN CASE WHEN isoyear(ts) = year(ts) THEN date_trunc('day', ts) END END''')} AS parsed FROM events""",
        "normalize_entity": f"WITH {_sql_entities()}, n AS (SELECT entity_id, {_sql_display('raw_name')} AS clean_name FROM scoped) SELECT entity_id, clean_name, {_sql_key('clean_name')} AS match_key FROM n",
        "seed_matches": f"WITH {_sql_resolved()} SELECT entity_id, seed AS seed_canonical FROM seeded",
        "blocking_pairs": f"{part_names}{blocks} SELECT id_a, id_b FROM pairs",
        "blocking_prefix_cap": f"WITH e AS (SELECT c_custkey AS id, {_sql_display('c_name')} AS c, {_sql_key('c_name')} AS k FROM customer){blocks.split(', pairs AS')[0].rstrip().rstrip(',')} SELECT bk AS block_key, count(*) AS members FROM kept GROUP BY 1",
        "similarity_scores": f"""{part_names}{blocks}, s AS (SELECT id_a, id_b, x.c AS a, y.c AS b, {tok('x.c')} AS ta, {tok('y.c')} AS tb FROM pairs JOIN e x ON x.id = id_a JOIN e y ON y.id = id_b),
            r AS (SELECT id_a, id_b, 200.0 * {_sql_lcs('a', 'b')} / (length(a) + length(b)) AS ratio, 200.0 * {_sql_lcs('ta', 'tb')} / (length(ta) + length(tb)) AS token_sort FROM s)
            SELECT id_a, id_b, round(ratio, 6) AS ratio, round(token_sort, 6) AS token_sort, CASE WHEN token_sort >= 98 AND ratio >= 98 THEN 2 WHEN token_sort >= 75 AND token_sort < 98 THEN 3 END AS tier FROM r""",
        "connected_components": """
            WITH c AS (SELECT c_custkey AS a, CASE WHEN c_nationkey % 5 <> 0 THEN c_custkey + 1 END AS b FROM customer), l AS (SELECT a FROM c WHERE b IS NOT NULL), v AS (SELECT a AS id FROM l UNION SELECT a + 1 FROM l),
            s AS (SELECT id, CASE WHEN id - 1 IN (SELECT a FROM l) THEN 0 ELSE 1 END AS fresh FROM v), g AS (SELECT id, sum(fresh) OVER (ORDER BY id) AS g FROM s)
            SELECT id, min(id) OVER (PARTITION BY g) AS component FROM g""",
        "entity_resolution": f"WITH {_sql_resolved()} SELECT * FROM log",
        "canonical_election": f"WITH {_sql_resolved()} SELECT canonical_name, count(*) AS members, min(entity_id) AS first_id FROM log GROUP BY 1",
        "mapping_summary": f"WITH {_sql_resolved()} SELECT match_method, count(*) AS n, round(avg(CASE WHEN match_method = 'FUZZY_CONFIDENT' THEN 0.95 ELSE 1.0 END), 3)::DOUBLE AS avg_confidence FROM log GROUP BY 1",
        "compression": f"WITH {_sql_resolved()} SELECT count(*) AS total_raw, count(DISTINCT canonical_name) AS distinct_canonical, printf('%.2f%%', (1 - count(DISTINCT canonical_name) / greatest(count(*), 1)) * 100) AS compression_ratio FROM log",
        "variant_clusters": f"WITH {_sql_resolved()} SELECT canonical_name, count(*) AS variant_count, string_agg(raw_name, ' | ' ORDER BY raw_name) AS variants FROM log GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 20",
        "pair_reduction": f"{part_names}{blocks} SELECT n AS entities, p AS pairs, round(1 - p / greatest(n * (n - 1) / 2, 1), 6) AS reduction FROM (SELECT count(*) AS n FROM e), (SELECT count(*) AS p FROM pairs)",
        "role_family_hiring": f"SELECT conv_id, turn, CASE {' '.join(f'WHEN regexp_matches({low}, {_quote(word(w))}) THEN {_quote(f)}' for f, w in zip(text.FAMILIES, text.ROLE_WORDS, strict=True))} END AS role_family, regexp_matches(text, {_quote('(?i)' + word(['remote']))}) AS is_remote FROM conversations",
        "relevance_filter": f"SELECT doc_id FROM documents WHERE {_sql_any(chr(39).join(['lower(text || ', ' ', ' || source)']), text.RELEVANT)}",
        "pricing_models": f"SELECT p_partkey, {_sql_pricing(_sql_pick(LABELS, 'p_partkey'))} AS pricing_model FROM part",
        "team_sizes": "SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN p_size END AS employee_count FROM part",
        "header_fields": f"""
            WITH h AS (SELECT c_custkey, c_name, c_name || ' | ' || {_sql_pick(TITLES, 'c_custkey')} || ' | ' || {_sql_pick(TITLES, 'c_nationkey')} AS x FROM customer),
            g AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'Hello from ' || x WHEN c_custkey % 10 = 0 THEN c_name ELSE x END AS header FROM h),
            p AS (SELECT c_custkey, CASE WHEN contains(header, '|') THEN list_filter(list_transform(string_split(header, '|'), lambda s: trim(s)), lambda s: s <> '' AND NOT regexp_matches(s, '(?i)https?://|www\\.') AND NOT regexp_matches(s, '^[a-zA-Z0-9-]+\\.[a-zA-Z]{{2,}}(/.*)?$')) END AS parts FROM g)
            SELECT c_custkey, CASE WHEN NOT regexp_matches(parts[1], '(?i)^(hi|hello|we\\s+are)\\b') THEN parts[1] END AS company, ({titled})[1] AS title FROM p""",
        "chunk_html": f"""WITH c AS (SELECT page_id, html, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM pages)
            SELECT page_id, md5(CASE WHEN length(html) < 30 THEN html WHEN length(t) <= 12000 THEN t ELSE substr(t, 1, 12000) || ' [...]' END) AS chunk_md5 FROM c""",
        "chunk_comment": r"""WITH c AS (SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM pages),
            d AS (SELECT page_id, html, t, split_part(t, chr(10), 1) AS h, CASE WHEN contains(t, chr(10)) THEN substr(t, strpos(t, chr(10)) + 1) ELSE '' END AS b FROM c),
            e AS (SELECT *, greatest(500, 11950 - length(h)) AS room FROM d)
            SELECT page_id, md5(CASE WHEN length(html) < 30 THEN html WHEN length(t) <= 12000 THEN t ELSE h || chr(10) || CASE WHEN length(b) > room THEN substr(b, 1, room) || chr(10) || '[...truncated...]' ELSE b END END) AS chunk_md5 FROM e""",
        "chunk_article": r"""WITH c AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS x, source FROM documents),
            d AS (SELECT doc_id, x, CASE WHEN coalesce(source, '') <> '' THEN 'Title: ' || source || chr(10) || chr(10) || x ELSE x END AS w FROM c),
            e AS (SELECT *, list_filter(list_transform(string_split(w, chr(10) || chr(10)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS ps FROM d),
            f AS (SELECT *, array_to_string(ps[1:3], chr(10) || chr(10)) || chr(10) || chr(10) || '[...content truncated for brevity...]' || chr(10) || chr(10) || ps[-1] AS ends FROM e)
            SELECT doc_id, md5(CASE WHEN length(x) < 30 THEN x WHEN length(w) <= 12000 THEN w WHEN len(ps) <= 4 THEN substr(w, 1, 12000) || chr(10) || '[...truncated...]'
                WHEN length(ends) > 12000 THEN substr(ends, 1, 12000) || chr(10) || '[...truncated...]' ELSE ends END) AS chunk_md5 FROM f""",
        "page_titles": "SELECT replace(replace(replace(trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS title, page_id || '@' || url AS paper_url FROM pages",
        "url_rules": """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://arxiv.org/abs/24.' || page_id ELSE 'https://papers.example/' || page_id || 'v3' END AS paper_url, 'owner' || page_id AS owner, 'repo' AS repo,
            CASE WHEN page_id % 4 <> 0 THEN 'tool' || page_id END AS slug FROM pages""",
        "category_slugs": r"""WITH h AS (SELECT unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) || '-alternatives' AS href FROM pages)
            SELECT DISTINCT regexp_extract(href, '^/([a-z0-9][\w.-]*)-alternatives$', 1) AS slug FROM h WHERE slug NOT IN ('', 'best')""",
        "json_replies": "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN props END AS reply FROM events",
        "author_lists": "SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS authors FROM nation GROUP BY 1",
        "enrich_join": "SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders LEFT JOIN (SELECT *, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k FROM customer) ON k = o_custkey",
        "nested_records": f"""WITH {_sql_tables()} SELECT to_json({{'schemaVersion': '1.0', 'recordType': 'STARTUP', 'source': {{'name': source_name, 'url': source_url}},
            'content': {{'entityName': entity_name, 'data': {{'employeeCount': CASE WHEN id % 4 <> 0 THEN employee_count END}}}}, 'collectedAt': '2024-01-30T00:00:00Z'}})::VARCHAR AS value FROM startups""",
        "nested_lines": f"""WITH {_sql_tables()}
            SELECT to_json({{'schemaVersion': '1.0', 'recordType': 'STARTUP', 'source': {{'name': source_name, 'url': source_url}},
                'content': {{'entityName': entity_name, 'data': {{'employeeCount': CASE WHEN id % 4 <> 0 THEN employee_count END}}}}, 'collectedAt': {at}}})::VARCHAR AS value FROM startups
            UNION ALL SELECT to_json({{'schemaVersion': '1.0', 'recordType': 'PRODUCT', 'source': {{'name': source_name, 'url': source_url}}, 'content': {{'startupName': startup_name, 'pricingModel': pricing_model}}, 'collectedAt': {at}}})::VARCHAR FROM products
            UNION ALL SELECT to_json({{'schemaVersion': '1.0', 'recordType': 'RESEARCH_PAPER', 'content': {{'title': 'Region ' || n_regionkey, 'authors': list(n_name ORDER BY n_name), 'paper_url': 'https://arxiv.org/abs/' || n_regionkey,
                'github_url': NULL, 'github_stars': CASE WHEN n_regionkey > 2 THEN n_regionkey END, 'published_date': '2024-01-01'}}}})::VARCHAR FROM nation GROUP BY n_regionkey
            UNION ALL SELECT to_json({{'schemaVersion': '1.0', 'recordType': 'JOB', 'source': {{'name': source, 'url': 'https://board.example'}}, 'content': {{'title': NULL, 'company': lang, 'date': {at}, 'is_remote': doc_id % 2 = 0,
                'role_family': {_sql_family('text', 'remotive')}, 'job_url': 'https://board.example/' || doc_id, 'description': text}}, 'collectedAt': {at}}})::VARCHAR FROM documents
            UNION ALL SELECT to_json({{'schemaVersion': '1.0', 'recordType': 'NEWS', 'source': {{'name': source, 'url': NULL}}, 'content': {{'title': lang, 'url': 'https://news.example/' || doc_id, 'published_date': {at}, 'author': NULL, 'summary': '',
                'full_text': text, 'content_type': CASE WHEN doc_id % 3 = 0 THEN 'SUMMARY' ELSE 'FULL_TEXT' END}}, 'collectedAt': {at}}})::VARCHAR FROM documents""",
        "stream_first_seen": f"SELECT user_id::VARCHAR AS url, {iso('min(ts)')} AS first_seen_at FROM events WHERE user_id IS NOT NULL GROUP BY 1",
        "stream_insert_ignore": f"SELECT 'u' || user_id AS url, {iso('min(ts)')} AS first_seen_at FROM events WHERE user_id IS NOT NULL GROUP BY 1",
        "export_startups": f"WITH {_sql_tables()} " + tab(head("STARTUP", "source_name") | {"source.url": "source_url", "content.entityName": "entity_name", "content.data.employeeCount": "CASE WHEN id % 4 <> 0 THEN employee_count::VARCHAR ELSE '' END", "collectedAt": at}, "startups"),
        "export_products": f"WITH {_sql_tables()} " + tab(head("PRODUCT", "source_name") | {"source.url": "source_url", "content.startupName": "startup_name", "content.pricingModel": "coalesce(pricing_model, '')", "collectedAt": at}, "products"),
        "export_research_papers": tab(
            head("RESEARCH_PAPER", "'arXiv'") | {"source.url": "'https://arxiv.org/abs/' || n_regionkey", "content.title": "'Region ' || n_regionkey", "content.authors": "string_agg(n_name, '; ' ORDER BY n_name)", "content.paper_url": "'https://arxiv.org/abs/' || n_regionkey", "content.github_url": "''",
            "content.github_stars": "CASE WHEN n_regionkey > 2 THEN n_regionkey::VARCHAR ELSE '' END", "content.published_date": "'2024-01-01'", "collectedAt": at}, "nation GROUP BY n_regionkey"),
        "export_jobs": tab(
            head("JOB", "coalesce(source, '')") | {"source.url": "'https://board.example'", "content.title": "''", "content.company": "coalesce(lang, '')", "content.date": at, "content.is_remote": "doc_id % 2 = 0", "content.role_family": f"coalesce({_sql_family('text', 'remotive')}, '')",
            "content.job_url": "'https://board.example/' || doc_id", "content.description": cut(500), "collectedAt": at}, "documents"),
        "export_news": tab(
            head("NEWS", "coalesce(source, '')") | {"source.url": "''", "content.title": "coalesce(lang, '')", "content.url": "'https://news.example/' || doc_id", "content.published_date": at, "content.author": "''", "content.summary": "''", "content.full_text": cut(1000),
            "content.content_type": "CASE WHEN doc_id % 3 = 0 THEN 'SUMMARY' ELSE 'FULL_TEXT' END", "collectedAt": at}, "documents"),
        "export_entity_mapping_log": f"WITH {_sql_resolved()} " + tab(
            {c: c for c in ("raw_name", "canonical_name", "entity_type", "match_method")} | {"confidence": "CASE WHEN match_method = 'FUZZY_CONFIDENT' THEN '0.95' ELSE '1.0' END", "source_name": "source_name", "source_url": "source_url", "explanation": "explanation", "resolved_at": at}, "log"),
        "mappings_like": f"WITH {_sql_resolved()} SELECT raw_name, canonical_name, match_method FROM log WHERE raw_name ILIKE '%AI%'",
        "saved_total": f"SELECT count(*) FILTER ({fresh} AND value > 10) AS saved FROM events",
        "insert_limited": """
            WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND value IS NOT NULL)
            SELECT event_id, user_id, event_type, value FROM n WHERE user_id IS NULL OR event_type IS NULL
                OR (rn = 1 AND NOT EXISTS (SELECT 1 FROM events o WHERE o.ts < TIMESTAMP '2024-01-03' AND o.user_id = n.user_id AND o.event_type = n.event_type)) ORDER BY event_id LIMIT 25""",
        "authors_json": "SELECT n_regionkey, CASE WHEN n_regionkey < 4 THEN to_json(list(n_name ORDER BY n_name))::VARCHAR END AS authors FROM nation GROUP BY 1",
        "resolution_tiers": f"""
            WITH p AS (SELECT DISTINCT p_partkey::BIGINT AS id, (p_partkey // 2)::VARCHAR AS j, p_partkey % 2 = 1 AS odd FROM part),
            e AS (SELECT id * 2 AS entity_id, 'l' || j AS g, md5(j || 'a') || ' ' || md5(j || 'b') || CASE WHEN odd THEN 'x' ELSE 'y' END AS clean_name FROM p
                UNION ALL SELECT id * 2 + 1, CASE WHEN j::BIGINT % 2 = 0 THEN 's' || j ELSE 't' || id END, md5(j || 'c') || ' ' || substr(md5(j || CASE WHEN odd THEN 'd' ELSE 'e' END), 1, 8) FROM p),
            m AS (SELECT *, count(*) OVER (PARTITION BY g) AS members, first_value(clean_name) OVER (PARTITION BY g ORDER BY length(clean_name), clean_name) AS canonical_name FROM e),
            w AS (SELECT *, NULL::VARCHAR AS seed, CASE WHEN members = 1 THEN 'CANONICAL_SINGLETON' WHEN lower(clean_name) = lower(canonical_name) THEN 'EXACT_NORMALIZED' ELSE 'FUZZY_CONFIDENT' END AS match_method FROM m)
            SELECT entity_id, clean_name AS raw_name, canonical_name, match_method, CASE WHEN match_method = 'FUZZY_CONFIDENT' THEN 0.95::DOUBLE ELSE 1.0::DOUBLE END AS confidence, {_sql_why()} AS explanation FROM w""",
        "article_paragraphs": f"""
            WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1) AS x FROM pages),
            p AS (SELECT page_id, list_transform(string_split(x, '<p>')[2:], lambda s: array_to_string({_sql_pieces("split_part(s, '</p>', 1)")}, '')) AS ps FROM a)
            SELECT page_id, array_to_string(list_filter(ps, lambda s: length(s) > 20), chr(10) || chr(10)) AS body FROM p""",
        "page_texts": f"""
            WITH a AS (SELECT page_id, regexp_replace(html, '(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->', '<x>', 'g') AS x FROM pages)
            SELECT page_id, array_to_string({_sql_pieces('x')}, ' ') AS text FROM a""",
    }
    out["save_resolve_export"] = out["export_entity_mapping_log"]
    families = " ".join(f"WHEN regexp_matches(low, {_quote(word(w))}) THEN {_quote(f)}" for f, w in zip(text.FAMILIES, text.ROLE_WORDS, strict=True))
    out["hiring_posts"] = f"""
        WITH c AS (SELECT conv_id, turn, 'Acme ' || conv_id AS company, {_sql_pick(TITLES, 'turn')} AS t, 'Acme ' || conv_id || ' | ' || {_sql_pick(TITLES, 'turn')} || chr(10) || text AS d FROM conversations),
        p AS (SELECT *, list_filter([company, t], lambda s: NOT regexp_matches(s, '(?i)https?://|www\\.')) AS parts FROM c),
        n AS (SELECT conv_id, turn, company, ({titled})[1] AS title, d FROM p),
        r AS (SELECT *, lower(coalesce(title, '') || ' ' || substr(d, 1, 400)) AS low FROM n)
        SELECT conv_id, turn, company, title, regexp_matches(d, {_quote('(?i)' + word(['remote']))}) AS is_remote, CASE {families} END AS role_family FROM r"""
    for board in text.ROLE_KEYWORDS:
        out[f"role_family_{board}"] = f"SELECT conv_id, turn, {_sql_family('text', board)} AS role_family FROM conversations"
    from loomspan import catalog_pages

    return out | catalog_pages.oracle_sql()


def _sql_family(x: str, board: str) -> str:
    return "CASE " + " ".join(f"WHEN {_sql_any(f'lower({x})', words)} THEN {_quote(family)}" for family, words in zip(text.FAMILIES, text.ROLE_KEYWORDS[board], strict=True)) + " END"


def _sql_title(p: str) -> str:
    words = "|".join(text.TITLE_WORDS)
    listed = ", ".join(map(_quote, text.NON_TITLES))
    return (
        f"lower({p}) NOT IN ({listed}) AND NOT regexp_matches(lower({p}), '\\$?\\d+k\\b|usd|eur|gbp') AND (regexp_matches({p}, '(?i)\\b({words})\\b') "
        f"OR len(list_filter(string_split({p}, ' '), lambda w: regexp_matches(w, '^\\p{{Lu}}\\p{{L}}*$'))) >= 2)"
    )
