"""Sources against a local server: facets, walks that resume, crawls that stop, few open requests, JSON bodies; and the boards and feeds without a test so far."""

import http.server
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from loomspan.operators import ingest, resolve
from loomspan.sources import captures, crawl, search, walks, web


class Site:
    """A server that answers with what ``reply(path, payload)`` gives (a text, or None for 404) and keeps a log."""

    def __init__(self, reply, wait=0.0):
        self.log, self.payloads, self.open, self.most, site = [], [], 0, 0, self
        lock = threading.Lock()

        class Handler(http.server.BaseHTTPRequestHandler):
            def answer(self, payload):
                with lock:
                    site.log.append(self.path)
                    site.payloads.append(payload)
                    site.open += 1
                    site.most = max(site.most, site.open)
                time.sleep(wait)
                body = reply(self.path, payload)
                with lock:
                    site.open -= 1
                self.send_response(404 if body is None else 200)
                self.end_headers()
                self.wfile.write((body or "").encode())

            def do_GET(self):  # noqa: N802
                self.answer(None)

            def do_POST(self):  # noqa: N802
                self.answer(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.server.shutdown()


HITS = [{"name": f"c{i}", "slug": f"s{i}", "team_size": i, "status": ["Active", "Inactive", "Public"][i % 3], "more": "x"} for i in range(23)]


def _index(path, payload):
    hits = [h for h in HITS if all(any(h[f.split(":")[0]] == f.split(":")[1] for f in either) for either in payload["facetFilters"])]
    size, page = payload["hitsPerPage"], payload["page"]
    return json.dumps({"nbPages": -(-len(hits) // size), "hits": [{k: h[k] for k in payload["attributesToRetrieve"]} for h in hits[page * size : page * size + size]]})


def test_search_hands_filters_and_columns_to_the_index(spark):
    schema, options = "name string, team_size int, status string", {"hitsPerPage": "4"}
    with Site(_index) as site:
        active = search.hits(spark, site.url, schema, {"status": ["Active"]}, **options)
        some = active.where("team_size > 5 and name like 'c%'")
        assert sorted((r.name, r.team_size) for r in some.collect()) == sorted((h["name"], h["team_size"]) for h in HITS if h["status"] == "Active" and h["team_size"] > 5)
        assert {json.dumps(p["facetFilters"]) for p in site.payloads} == {'[["status:Active"]]'} and site.payloads[0]["attributesToRetrieve"] == ["name", "team_size", "status"]
        # two pages of active hits: one request to count them and one for each page
        assert [p["page"] for p in site.payloads] == [0, 0, 1]
        # each query of one DataFrame sends its own conditions
        assert active.count() == 8 and active.where("status = 'Public'").count() == 0 and active.count() == 8
        site.payloads.clear()
        either = search.hits(spark, site.url, schema, {"status": ["Active", "Public"]}, **options)
        assert either.count() == 15 and site.payloads[0]["facetFilters"] == [["status:Active", "status:Public"]]
        site.payloads.clear()
        rows = search.hits(spark, site.url, schema, **options)
        assert rows.where("name = 'c3' or status = 'Public'").count() == 8 and rows.where("status = 'Active'").count() == 8 and rows.count() == 23
        assert all(p["facetFilters"] == [] for p in site.payloads)
        with pytest.raises(ValueError, match="no column"):
            search.hits(spark, site.url, "name string", {"status": ["Active"]})
    limited = search.SearchReader({"endpoint": site.url, "limit": "5", "hitsPerPage": "4", "attempts": "1"}, rows.schema)
    assert [p.numbers for p in limited.partitions()] == [[]]


def _feed(total, size_of=lambda start, take: take):
    def reply(path, _):
        query = dict(x.split("=") for x in path.split("?")[1].split("&"))
        start, take = int(query["start"]), int(query["max_results"])
        n = max(0, min(size_of(start, take), total - start))
        return f"<feed><opensearch:totalResults>{total}</opensearch:totalResults>{''.join(f'<entry><id>{start + i}</id></entry>' for i in range(n))}</feed>"

    return reply


def _walk(spark, form, options, out, state, batches):
    """Run a stream until so many batches have been written or the walk has ended, then stop it."""
    stream = spark.readStream.format(form).options(**options).load().writeStream.format("parquet").option("path", out).option("checkpointLocation", state).start()
    for _ in range(100):
        time.sleep(0.1)
        if len([p for p in stream.recentProgress if p.numInputRows]) >= batches:
            break
        if stream.exception() is not None:
            raise stream.exception()
    stream.stop()


def test_a_listing_is_walked_once_over_restarts(spark, tmp_path):
    walks.register(spark)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    with Site(_feed(23)) as site:
        options = {"base": f"{site.url}/q?x=1", "size": "5"}
        _walk(spark, "listing", options, out, state, 2)
        _walk(spark, "listing", options, out, state, 99)
        rows = spark.read.parquet(out).collect()
        starts = [int(p.split("start=")[1].split("&")[0]) for p in site.log]
        assert sorted(r.position for r in rows) == [0, 5, 10, 15, 20]
        assert sorted(set(starts)) == [0, 5, 10, 15, 20]
        # what a committed batch holds is not asked for again; a page that was planned and not committed may be, once
        assert len(starts) <= 6


def test_where_walks_end():
    with Site(_feed(10)) as site:
        reader = walks.ListingReader({"base": site.url + "/q?x=1", "size": "5"})
        at, seen = reader.initialOffset(), []
        while not at["ended"]:
            rows, at = reader.read(at)
            seen += list(rows)
        assert len(seen) == 2 and len(site.log) == 2 and list(reader.read(at)[0]) == []
        limited = walks.ListingReader({"base": site.url + "/q?x=1", "size": "4", "limit": "6"})
        assert len(list(limited.readBetweenOffsets({"start": 0, "ended": False}, {"start": 6, "ended": True}))) == 2 and "max_results=2" in site.log[-1]
    with Site(_feed(10, lambda start, take: 3)) as site:  # a short page is the last
        assert walks.ListingReader({"base": site.url + "/q?x=1", "size": "5"}).read({"start": 0, "ended": False})[1] == {"start": 3, "ended": True}
    with Site(lambda path, _: "body" if int(path[1:]) in (95, 90, 60) else None) as site:
        reader = walks.NumberedReader({"base": f"{site.url}/", "first": "99", "misses": "7", "chunk": "4"})
        at, rows = reader.initialOffset(), []
        while not at["ended"]:
            more, at = reader.read(at)
            rows += list(more)
        # misses go on counting over batches: 90 has a body, 83 is the seventh without one after it
        assert [r[1] for r in rows if r[3]] == [95, 90] and rows[-1][1] == 83 and site.log == [f"/{n}" for n in range(99, 82, -1)]


def _shop(path, _):
    if path.startswith("/cat"):
        number, page = int(path[4]), int(path.split("page=")[1]) if "page=" in path else 1
        first = {0: [0, 3, 3], 1: [2, 4, 6], 2: [20, 20]}[number]
        at = first[page - 1] if page <= len(first) else first[-1]
        return "".join(f'<a href="/product{at + i}-alternatives">x</a>' for i in range(3))
    if path == "/product1":
        return "<html><body>nothing</body></html>"
    return f"<title>{path[1:].title()} reviews</title>"


def test_a_crawl_opens_no_page_too_many(spark, tmp_path):
    at = F.lit("2024-01-01").cast("timestamp")
    with Site(_shop) as site:
        names = spark.createDataFrame([("product5", _shop("/product5", None)), ("product1", _shop("/product1", None))], "slug string, html string")
        found = {r.startup_name for r in captures.products(names).collect()}
        assert len(found) == 1  # a page without a name is no product
        categories = [f"{site.url}/cat{i}" for i in range(3)]
        totals = crawl.crawl_products(spark, crawl.web_fetch(spark, attempts="1"), site.url, categories, f"{tmp_path}/p", at, limit=3)
        # category 0: pages 1 and 2 are new, 3 is not; category 1 still opens (6 slugs < 9), which brings 2 to 8; category 2 does not (9 slugs)
        assert site.log[:3] == ["/cat0", "/cat0?page=2", "/cat0?page=3"] and not any(p.startswith("/cat2") for p in site.log)
        opened = [p for p in site.log if p.startswith("/product")]
        # three wanted: 0, 1 and 2 are opened, 1 gives nothing, then one more
        assert opened == ["/product0", "/product1", "/product2", "/product3"] and totals["opened"] == 4 and totals["saved"] == totals["products"] == 3
        again = crawl.crawl_products(spark, crawl.web_fetch(spark, attempts="1"), site.url, categories[:1], f"{tmp_path}/p", at)
        assert again == {"slugs": 6, "opened": 6, "products": 5, "saved": 2}


def test_no_more_requests_open_than_allowed(spark):
    spark.dataSource.register(web.WebSource)
    with Site(lambda path, _: "x", wait=0.2) as site:
        hosts = [f"http://127.0.0.{i}:{site.server.server_port}" for i in range(1, 7)]
        urls = [f"{site.url}/{i}" for i in range(6)]
        assert [len(p.hosts) for p in web.WebReader({"urls": " ".join(f"{h}/{k}" for n, h in enumerate(hosts) for k in range(n + 1)), "concurrency": "2"}).partitions()] in ([3, 3], [2, 4], [4, 2])
        loads = sorted(sum(map(len, g)) for g in web.packed([["u"] * n for n in (7, 5, 4, 3, 1)], 2))
        assert loads == [10, 10] and web.packed([], 3) == []
        # one host is one partition, whatever is allowed: its requests come one by one
        assert spark.read.format("web").options(urls=" ".join(urls), concurrency="3").load().count() == 6 and site.most == 1


def test_bodies_that_are_no_json_are_tried_again(spark):
    asked = []

    def reply(path, _):
        asked.append(path)
        return '{"a": [1, 2]}' if path == "/good" or asked.count(path) > 1 and path == "/late" else "<html>"

    with Site(reply) as site:
        got = {r.url.rsplit("/", 1)[1]: (r.status, r.a) for r in web.json_pages(spark, [f"{site.url}/{p}" for p in ("good", "late", "bad")], pause="0").select("url", "status", F.try_variant_get("json", "$.a[1]", "int").alias("a")).collect()}
    assert got == {"good": (200, 2), "late": (200, 2), "bad": (0, None)} and asked.count("/bad") == 3 and asked.count("/late") == 2


@pytest.mark.parametrize("board,reply,want", [
    ("arbeitnow", {"data": [{"title": " Data Engineer ", "company_name": "A", "url": "u1", "created_at": 1706500000, "remote": None, "tags": ["it"], "description": "<p>x</p><p>y</p>"}, {"title": "T", "company_name": "", "url": "u2"}]}, ("Data Engineer", "A", "u1", "1706500000", False, "x\ny")),
    ("remotive", {"jobs": [{"title": "Designer", "company_name": "B", "url": "u3", "publication_date": "2024-01-29T10:00:00", "category": "Design", "description": "d"}, {"title": "no url", "company_name": "C"}]}, ("Designer", "B", "u3", "2024-01-29T10:00:00", True, "d")),
])
def test_boards_without_a_list_of_their_own(spark, tmp_path, board, reply, want):
    (tmp_path / "r.json").write_text(json.dumps(reply))
    rows = captures.board_jobs(spark, str(tmp_path / "r.json"), board).collect()
    assert [(r.title, r.company, r.job_url, r.raw_date, r.is_remote, r.description) for r in rows] == [want]


def test_atom_items(spark, tmp_path):
    (tmp_path / "f.xml").write_text("""<feed><entry><title> One </title><id>tag:1</id><link rel="self" href="http://x/self"/><link rel="alternate" href="http://x/1"/><published>2024-01-29</published><author><name>Ann</name></author><content>&lt;p&gt;Body&lt;/p&gt;</content></entry>
        <entry><title>Two</title><id>http://x/2</id><updated>2024-01-30</updated><summary>Short</summary></entry><entry><title></title><id>http://x/3</id></entry><entry><title>Four</title><id>tag:4</id></entry></feed>""")
    rows = {r.title: r for r in captures.atom_items(spark, str(tmp_path / "f.xml")).collect()}
    assert set(rows) == {"One", "Two"}
    assert (rows["One"].url, rows["One"].raw_date, rows["One"].author, rows["One"].summary) == ("http://x/1", "2024-01-29", "Ann", "Body")
    assert (rows["Two"].url, rows["Two"].raw_date, rows["Two"].author, rows["Two"].summary) == ("http://x/2", "2024-01-30", None, "Short")


def test_counts_come_from_the_run_itself(spark, tmp_path):
    rows = spark.range(100)
    stages = {"fetched": F.lit(True), "fresh": F.col("id") % 2 == 0, "saved": F.col("id") % 10 == 0}
    out, seen = ingest.observed(rows, stages)
    out.where("id % 10 = 0").write.parquet(f"{tmp_path}/o")
    assert seen.get == {"fetched": 100, "fresh": 50, "saved": 10}
    listener = ingest.StageListener()
    spark.streams.addListener(listener)
    try:
        for part in range(2):
            rows.write.mode("append").parquet(f"{tmp_path}/in{part}")
        stream, _ = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in[0-9]"), None
        stream.observe("stages", *[F.count_if(t).alias(n) for n, t in stages.items()]).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        for _ in range(50):
            if listener.totals.get("fetched") == 200:
                break
            time.sleep(0.1)
        assert listener.totals == {"fetched": 200, "fresh": 100, "saved": 20}
    finally:
        spark.streams.removeListener(listener)


def test_a_point_lookup_reads_one_row_group(spark, tmp_path):
    n = 60_000
    log = spark.range(n).select(F.md5(F.col("id").cast("string").cast("binary")).alias("raw_name"), F.concat(F.lit("c"), F.col("id") % 50).alias("canonical_name"))
    assert resolve.save_mappings(log, f"{tmp_path}/log", group_bytes=200_000) == n
    import pyarrow.parquet as pq

    groups = sum(pq.ParquetFile(p).num_row_groups for p in (tmp_path / "log").glob("*.parquet"))
    name = log.first().raw_name
    found = resolve.mapping_of(spark.read.parquet(f"{tmp_path}/log"), name)
    assert [r.raw_name for r in found.collect()] == [name]
    plan = found._jdf.queryExecution().executedPlan()
    assert "EqualTo(raw_name" in plan.toString()
    scanned = spark.read.parquet(f"{tmp_path}/log").where(F.col("raw_name") == name).select(F.col("_metadata.row_index"))
    execution = scanned._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    read = leaves.apply(0).metrics().apply("numOutputRows").value()
    assert groups > 4 and 0 < read <= 2 * n / groups
