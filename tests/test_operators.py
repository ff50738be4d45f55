import json
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from loomspan.operators import arbiter, export, ingest, resolve
from loomspan.plans.components import components
from loomspan.plans.ranks import group_ranks
from loomspan.plans.scratch import Scratch
from loomspan.sources import captures, web


def test_insert_ignore_like_sqlite(spark):
    rng = random.Random(1)
    value = lambda: rng.choice([None, "a", "b", "c"])
    old = [(i, value(), value(), "x") for i in range(6)]
    new = [(10 + i, value(), value(), rng.choice([None, "v", "w"])) for i in range(40)]
    con = sqlite3.connect(":memory:")
    con.execute("create table t (id int, k1 text, k2 text, v text not null, unique (k1, k2))")
    con.executemany("insert or ignore into t values (?,?,?,?)", old + new)
    want = {r[0] for r in con.execute("select id from t")} - {r[0] for r in old}
    ddl = "id int, k1 string, k2 string, v string"
    got = ingest.insert_ignore(spark.createDataFrame(new, ddl), ["k1", "k2"], ["v"], "id", spark.createDataFrame(old, ddl))
    assert {r.id for r in got.collect()} == want


def test_save_twice_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "https://arxiv.org/abs/1v2", "2024-01-01"), (2, "https://arxiv.org/abs/1", None), (3, None, None)], "n int, paper_url string, published_date string")
    rows = rows.selectExpr("*", "'t' as title", "array('A') as authors", "cast(null as string) github_url", "cast(null as int) github_stars", "'arXiv' source_name")
    for _ in range(2):
        ingest.save(rows, "research_papers", str(tmp_path / "p"), "n", F.lit("2024-01-01").cast("timestamp"))
    found = spark.read.parquet(str(tmp_path / "p")).collect()
    assert [(r.paper_url, r.published_date) for r in found] == [("https://arxiv.org/abs/1", "2024-01-01T00:00:00Z")]


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for x in list(parent)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.id, r.component) for r in got} == want and len(got) == len(want)


def test_components_are_the_same_in_one_task_and_in_rounds(spark, monkeypatch):
    from loomspan.plans import components as module

    rng = random.Random(11)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(None, 3), (7, 7)]
    rows = spark.createDataFrame(links, "a long, b long")
    want = {tuple(r) for r in components(rows).collect()}
    monkeypatch.setattr(module, "FEW_LINKS", -1)
    assert {tuple(r) for r in components(rows).collect()} == want and len({c for _, c in want}) > 10
    with pytest.raises(RuntimeError):
        components(rows, rounds=1)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_group_ranks(spark):
    rows = [(g, k) for g in ("a", None, "c") for k in range({"a": 500, None: 3, "c": 41}[g])]
    random.Random(2).shuffle(rows)
    got = group_ranks(spark.createDataFrame(rows, "g string, k long"), "g", ["k"], Scratch(spark, "t"), 7).collect()
    assert len(got) == len(rows) and all(r["rank"] == r.k for r in got)


ENTITIES = [
    (0, "Demandbase", "Y Combinator"),
    (1, "Demandbase, Inc.", "SaaSHub"),
    (2, "LiveKit", "SaaSHub"),
    (3, "LiveKit Inc", "Job Board"),
    (4, "Salesforce", "SaaSHub"),
    (5, "Salesflare", "SaaSHub"),
    (6, "HubSpot", "SaaSHub"),
    (7, "HubSpot CRM", "SaaSHub"),
    (8, "Open AI", "Job Board"),
    (9, "OpenAI Global LLC", "Job Board"),
    (10, "株式会社", "Job Board"),
    (11, "株式会社", "Job Board"),
    (12, "The Extraordinarily Long Name of a Company for Measuring Things in Water", "SaaSHub"),
    (13, "The Extraordinarily Long Name of a Company for Measuring Thing in Water", "SaaSHub"),
    (14, "Measuring Things in Water The Extraordinarily Long Name of a Company for", "SaaSHub"),
]


def resolved(spark, decisions=None):
    rows = spark.createDataFrame([(i, n, "PRODUCT", s, "u") for i, n, s in ENTITIES], "entity_id long, raw_name string, entity_type string, source_name string, source_url string")
    return {r.entity_id: r for r in resolve.resolve(rows, decisions).collect()}


def test_resolution(spark):
    log = resolved(spark)
    assert log[1].canonical_name == "Demandbase" and log[1].match_method == "EXACT_NORMALIZED"
    assert log[3].canonical_name == log[2].canonical_name == "LiveKit" and log[2].match_method == "SEED_LIST_MATCH"
    assert log[8].canonical_name == log[9].canonical_name == "OpenAI"
    assert log[4].canonical_name != log[5].canonical_name and log[6].canonical_name != log[7].canonical_name
    assert log[10].match_method == log[11].match_method == "CANONICAL_SINGLETON"
    assert log[12].canonical_name == log[13].canonical_name != log[14].canonical_name
    assert {log[12].match_method, log[13].match_method} == {"EXACT_NORMALIZED", "FUZZY_CONFIDENT"}


def test_decisions_link_borderline_names(spark):
    decided = spark.createDataFrame([("HubSpot", "HubSpot CRM", True), ("Salesforce", "Salesflare", False)], "clean_a string, clean_b string, is_same boolean")
    log = resolved(spark, decided)
    assert log[6].canonical_name == log[7].canonical_name and log[4].canonical_name != log[5].canonical_name


def test_prefix_cap_is_strict(spark):
    rows = lambda n: spark.range(n).selectExpr("id as entity_id", "concat('zzz', id) as clean_name", "concat('zzz', id) as match_key")
    kept = lambda n: resolve.block_index(rows(n)).where("block_key = 'pref:zzz'").count()
    assert (kept(500), kept(501)) == (500, 0)


def test_empty_log_keeps_the_old_one(spark, tmp_path):
    log = spark.createDataFrame([("a",)], "raw_name string")
    assert resolve.save_mappings(log, str(tmp_path / "m")) == 1
    assert resolve.save_mappings(log.where("false"), str(tmp_path / "m")) == 0
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1


def test_nested_records(spark):
    rows = spark.createDataFrame([("1.0", "Acme", None, "YC", "u", "t")], "schema_version string, entity_name string, employee_count int, source_name string, source_url string, collected_at string")
    record = json.loads(export.record_lines(rows, "STARTUP").first()[0])
    assert record == {"schemaVersion": "1.0", "recordType": "STARTUP", "source": {"name": "YC", "url": "u"}, "content": {"entityName": "Acme", "data": {"employeeCount": None}}, "collectedAt": "t"}
    with pytest.raises(ValueError):
        export.nested(rows, "NOTHING")


def test_arbiter(spark):
    def model(system, user):
        if "x" in user:
            raise RuntimeError
        return '```json\n{"is_same_entity": true, "canonical_name": "A", "confidence": 0.9, "explanation": "one"}\n```'

    pairs = spark.createDataFrame([("a", "b"), ("x", "y")], "clean_a string, clean_b string")
    got = {r.clean_a: (r.is_same, r.confidence) for r in arbiter.decisions(pairs, model).collect()}
    assert got == {"a": (True, 0.9), "x": (False, 0.5)}
    with pytest.raises(arbiter.ModelsFailed):
        arbiter.with_failover([])("s", "u")
    assert arbiter.with_failover([lambda s, u: 1 / 0, lambda s, u: "ok"])("s", "u") == "ok"


def test_checked_replies(spark):
    rows = spark.createDataFrame([('{"company":"Acme","role_family":"Data"}',), ('{"company":"","role_family":"Data"}',), ('{"company":"A","role_family":"Chef"}',)], "r string")
    assert [r[0] and r[0]["company"] for r in rows.select(arbiter.hiring_extraction(F.col("r"))).collect()] == ["Acme", None, None]


def test_loosely_typed_replies(spark):
    """What counts as a truth value, a number and a text, as the upstream models coerce them."""
    reply = '{{"is_same_entity": {}, "canonical_name": {}, "confidence": {}, "explanation": {}}}'.format
    cases = [
        (reply("true", '"A"', "0.9", '"w"'), (True, 0.9)), (reply('"Yes"', '"A"', '"0.9"', '"w"'), (True, 0.9)), (reply("1", '"A"', "1", '"w"'), (True, 1.0)), (reply("1.0", '""', "true", '""'), (True, 1.0)),
        (reply('"off"', '"A"', '" 0.25 "', '"w"'), (False, 0.25)), (reply("2", '"A"', "0.9", '"w"'), (False, 0.5)), (reply('"maybe"', '"A"', "0.9", '"w"'), (False, 0.5)), (reply("true", "5", "0.9", '"w"'), (False, 0.5)),
        (reply("true", '"A"', "1.5", '"w"'), (False, 0.5)), (reply("true", '"A"', '"high"', '"w"'), (False, 0.5)), (reply("true", '"A"', "0.9", "null"), (False, 0.5)), (reply("true", '"A"', "[0.9]", '"w"'), (False, 0.5)),
        ('{"is_same_entity": true}', (False, 0.5)), ("no JSON", (False, 0.5)), (None, (False, 0.5)),
    ]
    rows = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, r string")
    got = {r.i: (r.d.is_same, r.d.confidence) for r in rows.select("i", arbiter.same_entity(F.col("r")).alias("d")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
    counts = ['{"employee_count": 12}', '{"employee_count": "12"}', '{"employee_count": 12.0}', '{"employee_count": 12.5}', '{"employee_count": 0}', '{"employee_count": "many"}', '{"employee_count": null}', "{}"]
    assert [r[0] for r in spark.createDataFrame([(c,) for c in counts], "r string").select(arbiter.field_value(F.col("r"), "employee_count")).collect()] == ["12", "12", "12", None, None, None, None, None]
    jobs = ['{"company": "A", "is_remote": "yes"}', '{"company": "A", "title": null, "location": "X"}', '{"company": "A", "title": 7}', '{"company": "A", "is_remote": "perhaps"}', '{"company": "A", "is_remote": null}', '{"company": 5}', '{"company": "' + "x" * 101 + '"}']
    got = [r[0] and (r[0].is_remote, r[0].location) for r in spark.createDataFrame([(j,) for j in jobs], "r string").select(arbiter.hiring_extraction(F.col("r"))).collect()]
    assert got == [(True, None), (False, "X"), None, None, None, None, None]


def test_extractions(spark):
    rows = spark.createDataFrame([("<p>team of 12</p>" + "x" * 30, None), ("y" * 40, 5), (None, None)], "html string, employee_count int")
    got = arbiter.fill_field(rows, "employee_count", "html", lambda s, u: '{"employee_count": 12}').collect()
    assert [r.employee_count for r in got] == [12, 5, None]
    news = spark.createDataFrame([("b" * 50, "t")], "body string, title string")
    assert arbiter.summarise_news(news, "body", "title", lambda s, u: '{"summary": "short"}').first().model_summary is None
    assert arbiter.summarise_news(news, "body", "title", lambda s, u: '{"summary": "' + "s" * 30 + '"}').first().model_summary == "s" * 30
    assert arbiter.extract_hiring(rows, "html", lambda s, u: '{"company": "Acme"}').first().job.company == "Acme"


def test_article_fallback(spark):
    items = spark.createDataFrame([("u1", "T", "s"), ("u2", "T", ""), ("u3", "T", "s")], "url string, title string, summary string")
    body = "<article><p>" + "x" * 120 + "</p></article>"
    pages = spark.createDataFrame([("u1", body), ("u2", "<article><p>short</p></article>")], "url string, html string")
    got = {r.url: (r.full_text, r.content_type) for r in captures.with_article(items, pages, "wired").collect()}
    assert got == {"u1": ("x" * 120, "FULL_TEXT"), "u2": ("T", "SUMMARY"), "u3": ("s", "SUMMARY")}


def test_directory_and_products(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"hits": [{"name": " A ", "slug": "a", "team_size": "11-50", "status": "Active"}, {"name": "B", "slug": "b", "status": "Inactive"}, {"name": "C", "slug": "", "status": "Active"}]}))
    assert [(r.entity_name, r.employee_count) for r in captures.directory_startups(spark, str(tmp_path / "c.json")).collect()] == [("A", 50)]
    pages = spark.createDataFrame([("notion", "<title>Notion reviews.</title><div><span>Pricing:</span><a>Freemium</a></div>"), ("none", "<p>x</p>")], "slug string, html string")
    assert [(r.startup_name, r.pricing_model, r.source_url) for r in captures.products(pages).collect()] == [("Notion", "FREEMIUM", "https://www.saashub.com/notion")]


def test_boards(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"legal": "x"}, {"position": "ML Engineer", "company": "A", "url": "u", "epoch": 5, "tags": ["x"], "description": "<p>a</p>"}, {"position": "None", "company": "", "url": "u2"}]))
    got = captures.board_jobs(spark, str(tmp_path / "r.json"), "remoteok").collect()
    assert [(r.title, r.raw_date, r.role_family, r.description) for r in got] == [("ML Engineer", "5", "Engineering", "a")]
    (tmp_path / "j.json").write_text(json.dumps({"jobs": [{"jobTitle": "X", "companyName": "B", "url": "u", "jobIndustry": "Marketing", "jobDescription": "d"}, {"jobTitle": None, "companyName": "B", "url": "u"}]}))
    assert [(r.title, r.role_family) for r in captures.board_jobs(spark, str(tmp_path / "j.json"), "jobicy").collect()] == [("X", "Marketing")]


def test_feeds(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<feed><entry><id>http://arxiv.org/abs/1v1</id><title>T\nU</title><published>2024</published><author><name> A </name></author></entry><entry><title>no id</title></entry></feed>')
    got = captures.atom_papers(spark, str(tmp_path / "a.xml")).collect()
    assert [(r.title, r.authors, r.paper_url) for r in got] == [("T U", ["A"], "https://arxiv.org/abs/1v1")]
    (tmp_path / "r.xml").write_text("<rss><channel><item><title>AI news</title><link>http://n/1</link><pubDate>x</pubDate><description>&lt;p&gt;s&lt;/p&gt;</description><category>c</category></item><item><title>t</title></item></channel></rss>")
    got = captures.relevant(captures.rss_items(spark, str(tmp_path / "r.xml"), "mit")).collect()
    assert [(r.title, r.author, r.summary) for r in got] == [("AI news", "MIT News Office", "s")]


def test_registry(tmp_path):
    from loomspan.sources import config

    assert config.enabled_sources({"sources": {"a": {"enabled": False}, "b": {}, "c": None, "d": {"enabled": True}}}) == ["b", "c", "d"]
    assert config.enabled_sources({}) == []
    assert web.id_urls("http://x/", 5, 3) == ["http://x/5", "http://x/4", "http://x/3"]


def test_export_tabs(spark, tmp_path):
    rows = spark.createDataFrame([(2, None, None, None, "u", "n" * 3, None, None)], "id long, schema_version string, record_type string, source_name string, source_url string, entity_name string, employee_count int, collected_at timestamp")
    export.write_tabs({"startups": rows}, str(tmp_path / "out"))
    got = spark.read.csv(str(tmp_path / "out" / "startups"), header=True).collect()
    assert [(r["schemaVersion"], r["recordType"], r["content.entityName"], r["content.data.employeeCount"]) for r in got] == [("1.0", "STARTUP", "nnn", None)]
    with pytest.raises(ValueError):
        export.tab(rows, "nothing")


def test_absent_tables_have_empty_tabs(spark, tmp_path):
    export.write_tabs({}, str(tmp_path / "out"), spark)
    for name in ("startups", "products", "research_papers", "jobs", "news", "entity_mapping_log"):
        found = spark.read.csv(str(tmp_path / "out" / name), header=True)
        assert found.count() == 0 and len(found.columns) > 4


def test_saved_rows_are_numbered_and_limited(spark, tmp_path):
    at = F.lit("2024-01-30 00:00:00").cast("timestamp")
    news = [(i, "s", "u", f"t{i}", f"http://n/{i % 7}", "2024-01-01 00:00:00", None, "sum" if i % 2 else None, "", "FULL_TEXT") for i in range(20, 0, -1)]
    rows = spark.createDataFrame(news, "n int, source_name string, source_url string, title string, url string, published_date string, author string, summary string, full_text string, content_type string")
    rows = rows.withColumn("published_date", F.col("published_date").cast("timestamp"))
    path = str(tmp_path / "news")
    assert [ingest.save(rows, "news", path, "n", at, limit=x) for x in (3, None, None)] == [3, 4, 0]
    got = spark.read.parquet(path).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 8)) and [r.title for r in got] == [f"t{i}" for i in range(1, 8)]
    assert got[0].full_text == "sum" and got[1].full_text == "" and export.tab(spark.read.parquet(path), "news").count() == 7
    papers = spark.createDataFrame([("P", ["A", "B"], "https://arxiv.org/abs/2401.1v2", None, None, "2024", "arXiv"), ("P", None, "https://arxiv.org/abs/2401.1", None, None, "2024", "arXiv")], "title string, authors array<string>, paper_url string, github_url string, github_stars int, published_date string, source_name string")
    assert ingest.save(papers, "research_papers", str(tmp_path / "p"), "title", at) == 1
    startups = spark.createDataFrame([("s", "u", "A", 1), ("s", "u", "A", 2), ("s", "u", None, 3), ("s", "u", None, 4)], "source_name string, source_url string, entity_name string, employee_count int")
    assert ingest.save(startups, "startups", str(tmp_path / "s"), "employee_count", at) == 3
    products = spark.createDataFrame([("s", "u", "A", "FREE"), ("s", "v", "A", "CHEAP")], "source_name string, source_url string, startup_name string, pricing_model string")
    assert ingest.save(products, "products", str(tmp_path / "q"), "source_url", at) == 2
    assert [r.pricing_model for r in spark.read.parquet(str(tmp_path / "q")).orderBy("id").collect()] == ["FREE", None]
    jobs = spark.createDataFrame([("s", "u", "T", "C", True, "Sales", "j", "d"), ("s", "u", "T", None, True, "Sales", "k", "d")], "source_name string, source_url string, title string, company string, is_remote boolean, role_family string, job_url string, description string").withColumn("published_date", at)
    assert ingest.save(jobs, "jobs", str(tmp_path / "j"), "job_url", at) == 1
    assert set(ingest.init_tables(spark, str(tmp_path))) == {"research_papers", "seen_urls", "entity_mapping_log"} | ({"startups", "products", "jobs"})
    assert ingest.init_tables(spark, str(tmp_path)) == []


def test_hiring_thread(spark, tmp_path):
    (tmp_path / "story.json").write_text(json.dumps({"hits": [{"objectID": "77", "title": "Who is hiring"}]}))
    body = "Acme | Senior Engineer | Remote<p>We build things of all kinds."
    hits = [{"objectID": "1", "parent_id": 77, "created_at": "2024-01-01T00:00:00Z", "comment_text": body}, {"objectID": "2", "parent_id": 1, "created_at_i": 5, "comment_text": body}, {"objectID": " ", "parent_id": 77, "comment_text": body}]
    (tmp_path / "comments.json").write_text(json.dumps({"hits": hits}))
    story = captures.latest_thread(spark, str(tmp_path / "story.json"))
    got = captures.hiring_comments(spark, str(tmp_path / "comments.json"), story).collect()
    assert story == "77" and [(r.job_url, r.company, r.title) for r in got] == [("https://news.ycombinator.com/item?id=1", "Acme", "Senior Engineer")]
    assert captures.hiring_comments(spark, str(tmp_path / "comments.json")).count() == 2  # a keyword search has no thread
    (tmp_path / "none.json").write_text(json.dumps({"hits": []}))
    assert captures.latest_thread(spark, str(tmp_path / "none.json")) is None


def test_feed_as_a_browser_shows_it(spark, tmp_path):
    feed = "<rss><channel><item><title>T</title><link>http://a/b</link><description>&lt;p&gt;S&lt;/p&gt;</description></item></channel></rss>"
    import html as html_lib

    (tmp_path / "page.html").write_text(f"<html><body><pre>{html_lib.escape(feed)}</pre></body></html>")
    assert [(r.title, r.url, r.author, r.summary) for r in captures.rss_from_pages(spark, str(tmp_path / "page.html"), "mit").collect()] == [("T", "http://a/b", "MIT News Office", "S")]


def test_crawled_slugs(spark):
    link = lambda *slugs: "".join(f'<a href="/{s}-alternatives">x</a>' for s in slugs)
    pages = spark.createDataFrame([(0, 0, link("b", "a")), (0, 1, link("a", "c")), (0, 2, link("a")), (0, 3, link("d")), (1, 0, link("c", "e")), (2, 0, link("f")), (1, 1, None)], "category int, page int, html string")
    slugs = lambda **k: [r.slug for r in captures.crawled_slugs(pages, **k).orderBy("place").collect()]
    assert slugs() == ["b", "a", "c", "e", "f"] and slugs(limit=1) == ["b", "a", "c"] and slugs(max_pages=1) == ["b", "a", "c", "e", "f"]


def test_star_counts(spark):
    from loomspan.sources import stars

    def fetch(url):
        if "bad" in url:
            raise OSError
        return {"https://api.github.com/repos/o/r": '{"stargazers_count": 7}'}.get(url, "[]")

    rows = spark.createDataFrame([("https://github.com/o/r.git",), ("https://github.com/o/r.git",), ("https://github.com/bad/r",), ("https://x.org",), (None,)], "u string")
    assert {r.url: r.stars for r in stars.star_counts(rows, "u", fetch).collect()} == {"https://github.com/o/r.git": 7, "https://github.com/bad/r": None, "https://x.org": None}


def test_paging_and_odd_addresses():
    assert web.page_urls("http://x/q?a=1", 200, limit=450)[-1] == "http://x/q?a=1&start=400&max_results=50" and len(web.page_urls("http://x/q", 10, pages=3)) == 3
    reader = web.WebReader({"urls": "http://[bad nonsense://x", "pause": "0", "attempts": "1"})
    assert [r[1:] for p in reader.partitions() for r in reader.read(p)] == [(0, None), (0, None)]
    walk = web.WebReader({"urls": " ".join(f"nope://h/{i}" for i in range(9)), "pause": "0", "attempts": "1", "stopAfterMisses": "3"})
    assert sum(1 for p in walk.partitions() for _ in walk.read(p)) == 3


def test_rate_limits_are_waited_for():
    calls = []

    def limited(system, user):
        calls.append(1)
        raise arbiter.RateLimited

    def broken(system, user):
        calls.append(2)
        raise OSError

    assert arbiter.with_failover([limited, broken, lambda s, u: "ok"], pause=0)("s", "u") == "ok" and calls == [1, 1, 1, 2]
    assert arbiter.probe(broken)["success"] is False and arbiter.probe(lambda s, u: "ok")["reply"] == "ok"


def test_a_new_log_replaces_the_old_one_whole(spark, tmp_path):
    log = resolve.resolve(spark.createDataFrame([(5, "Acme", "JOB", "s", "u"), (9, "Beta", "JOB", "s", "u")], "entity_id long, raw_name string, entity_type string, source_name string, source_url string"))
    at = F.lit("2024-01-30 00:00:00").cast("timestamp")
    path = str(tmp_path / "log")
    assert resolve.save_mappings(log, path, at) == 2 and resolve.save_mappings(log.where("raw_name = 'Acme'"), path, at) == 1
    assert [p.name for p in tmp_path.iterdir()] == ["log"]
    assert [r.raw_name for r in export.tab(spark.read.parquet(path), "entity_mapping_log").collect()] == ["Acme"]
    assert [r.raw_name for r in resolve.mappings_like(spark.read.parquet(path), "CM").collect()] == ["Acme"] and resolve.mappings_like(spark.read.parquet(path), "%").count() == 0


def test_comments(spark):
    rows = spark.createDataFrame([(1, "Acme | Senior Engineer | Remote &amp; more<p>We sell."), (2, "no pipe here at all"), (3, "Hello | x | y<p>z")], "i int, comment_text string")
    got = captures.parse_comments(rows).collect()
    assert [(r.i, r.company, r.title, r.is_remote, r.role_family, r.description) for r in got] == [(1, "Acme", "Senior Engineer", True, "Engineering", "Acme | Senior Engineer | Remote & more\nWe sell.")]


def test_web_source(spark):
    import http.server
    import threading

    hits = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            hits.append(self.path)
            code = 200 if self.path == "/ok" or hits.count(self.path) > 1 else 500
            code = 404 if self.path == "/gone" else code
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(b"body")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    reader = web.WebReader({"urls": f"{base}/ok {base}/flaky {base}/gone", "pause": "0"})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    spark.dataSource.register(web.WebSource)
    assert [(r.status, r.body) for r in spark.read.format("web").option("urls", f"{base}/ok").load().collect()] == [(200, "body")]
    server.shutdown()
    assert [r[1:] for r in rows] == [(200, "body"), (200, "body"), (404, None)]
    pages = [{"body": b} for b in ("x", None, None, "y", None, None, None, "z")]
    assert len(list(web.until_misses(pages, 3))) == 7
