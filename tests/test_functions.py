import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loomspan.functions import dates, html, names, similarity, text


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("x"))).collect()]


NAMES = [
    ("Demandbase, Inc.", "Demandbase", "demandbase"),
    ("https://livekit.io/", "livekit", "livekit"),
    ("Acme Software Group", "Acme", "acme"),
    ("The Software House", "The House", "thehouse"),
    ("Software", "Software", "software"),
    ("Foo Pty. Ltd.", "Foo", "foo"),
    ("Foo Co.uk", "Foouk", "foouk"),
    ("foo.co.uk", "foo", "foo"),
    ("acme.io.com", "acme.io", "acme"),
    ("AT&amp;T", "AT&T", "att"),
    (", Inc.", ", Inc.", "inc"),
    ("A/B Labs", "A", "a"),
    ("  ", "", ""),
    (None, "", ""),
]


def test_names(spark):
    raw = [n[0] for n in NAMES]
    assert apply(spark, raw, names.display_name) == [n[1] for n in NAMES]
    assert apply(spark, raw, lambda c: names.match_key(names.display_name(c))) == [n[2] for n in NAMES]


def test_seed_key(spark):
    assert apply(spark, ["Weights & Biases", "https://www.OpenAI.com/x", "Hugging Face, Inc.", "c.ai", None], names.seed_key) == ["weightsbiases", "openaicom", "huggingface", "cai", ""]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_similarity_against_brute_force(spark):
    rng = random.Random(5)
    pairs = [("".join(rng.choices("abc d", k=rng.randint(0, 12))), "".join(rng.choices("abc d", k=rng.randint(0, 12)))) for _ in range(60)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = rows.orderBy("i").select(similarity.ratio(F.col("a"), F.col("b")), similarity.token_sort_ratio(F.col("a"), F.col("b"))).collect()
    for (a, b), (plain, tokens) in zip(pairs, got, strict=True):
        for x, y, value in ((a, b, plain), (" ".join(sorted(a.split())), " ".join(sorted(b.split())), tokens)):
            want = 100.0 if not x and not y else 200.0 * lcs(x, y) / (len(x) + len(y))
            assert value == pytest.approx(want), (x, y)


def test_long_strings_span_several_words(spark):
    rng = random.Random(6)
    pairs = [("".join(rng.choices("abcdef gh", k=rng.randint(40, 150))), "".join(rng.choices("abcdef gh", k=rng.randint(40, 150)))) for _ in range(25)]
    pairs += [(x, x[:20] + x[25:]) for x, _ in pairs[:5]] + [("é" * 60, "é" * 49), ("", "a"), ("a" * 96, "a" * 48)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in rows.orderBy("i").select(similarity.common_length(F.col("a"), F.col("b"))).collect()]
    assert got == [lcs(a, b) for a, b in pairs]


def test_known_scores(spark):
    rows = spark.createDataFrame([("Pipeline CRM", "Pipeliner CRM"), ("HubSpot", "HubSpot CRM")], "a string, b string")
    assert [round(r[0], 2) for r in rows.select(similarity.token_sort_ratio(F.col("a"), F.col("b"))).collect()] == [96.0, 77.78]


def test_dates(spark):
    now = F.lit("2026-09-04 12:00:00").cast("timestamp")
    cases = {
        "20240101": "1970-08-23T06:15:01Z",
        "1725456789123": None,
        "2 hours ago": "2026-09-04T10:00:00Z",
        "5 mins ago": "2026-09-04T11:55:00Z",
        "1 month ago": "2026-08-05T12:00:00Z",
        "yesterday": "2026-09-03T12:00:00Z",
        "Just now": "2026-09-04T12:00:00Z",
        "Fri, 04 Sep 2026 17:18:00 +0000": "2026-09-04T17:18:00Z",
        "4 Sep 2026 17:18 EST": "2026-09-04T22:18:00Z",
        "2026-09-04T13:51:35-04:00": "2026-09-04T17:51:35Z",
        "2026-09-04": "2026-09-04T00:00:00Z",
        "2026-09-04 10:00:00": "2026-09-04T10:00:00Z",
        "2026-13-40": None,
        "soon": None,
        "": None,
        None: None,
    }
    assert apply(spark, list(cases), lambda c: dates.iso_utc(dates.parse_datetime(c, now))) == list(cases.values())


def test_freshness_ends(spark):
    now = dt.datetime(2024, 1, 10, 12)
    stamps = [now - dt.timedelta(hours=24), now - dt.timedelta(hours=24, seconds=1), now + dt.timedelta(hours=1), now + dt.timedelta(hours=1, seconds=1)]
    assert apply(spark, stamps, lambda c: dates.is_fresh(c, F.lit(now)), "timestamp") == [True, False, True, False]


def test_labels(spark):
    assert apply(spark, ["1-10", "501-1000", "1000+", "6132", "n/a", "11-x", None], text.team_size) == [10, 1000, 1000, 6132, None, None, None]
    assert apply(spark, ["Free Trial", "14-day free trial", "Open Source", "contact us", None], text.pricing_model) == ["FREEMIUM", "FREE", "FREE", None, None]
    assert apply(spark, ["Senior Data Scientist", "ML engineer", "said it", None], lambda c: text.role_family(c, "remotive")) == ["Data", "Engineering", "Engineering", None]


def test_headers(spark):
    headers = ["Acme | Senior Engineer | Remote", "https://a.io | Bob Corp | $100k | Data Wizard", "Hi there | x", "just text", "Hiring: X | Engineer", "A | 12 | B", None]
    assert apply(spark, headers, text.header_company) == ["Acme", "Bob Corp", None, None, "Hiring: X", "A", None]
    assert apply(spark, headers, text.header_title) == ["Senior Engineer", "Data Wizard", None, None, "Engineer", None, None]


def test_urls_and_authors(spark):
    assert apply(spark, ["https://arxiv.org/abs/2401.00001v3", "https://x.org/v3"], text.paper_url) == ["https://arxiv.org/abs/2401.00001", "https://x.org/v3"]
    assert apply(spark, ['["A "," ","B"]', "A, B", None, "[bad"], text.authors_text) == ["A; B", "A, B", "", "[bad"]
    assert apply(spark, ["/notion-alternatives", "/best-alternatives", "/x"], text.product_slug) == ["notion", None, None]


def test_replies(spark):
    replies = ['{"a":1}', '```json\n{"a": 2}\n```', 'well {"a":3} ok', "broken {", None]
    assert apply(spark, replies, text.reply_json) == ['{"a":1}', '{"a": 2}', '{"a":3}', None, None]


def test_chunks(spark):
    long = "Head\n" + "y" * 13000
    assert apply(spark, ["x" * 29, "<b>hi</b> there, this is long enough", None], text.chunk_html) == ["x" * 29, "hi there, this is long enough", None]
    got = apply(spark, [long], text.chunk_comment)[0]
    assert got.startswith("Head\n") and got.endswith("\n[...truncated...]") and len(got) == 5 + 12000 - 4 - 50 + 18


def test_html_text_and_papers(spark):
    page = '<html><head><title>T | Papers with Code</title><script type="application/ld+json">bad</script><script type="application/ld+json">{"@graph":[{"@type":"ScholarlyArticle","headline":"H","author":[{"name":"A"},"B"],"url":"u","sameAs":["x","https://arxiv.org/abs/1"],"codeRepository":["https://GitHub.com/o/r"]}]}</script></head><body><p>a<b>b</b></p></body></html>'
    meta = '<title>T | Papers with Code</title><meta name="citation_author" content="A"><meta name="citation_publication_date" content="2024/01/02"><a href="https://github.com/o/r/issues">i</a><a href="https://github.com/o/r">r</a>'
    rows = spark.createDataFrame([(1, page), (2, meta), (3, "")], "i int, html string").select("i", html.paper_page(F.col("html")).alias("p")).orderBy("i").select("p.*").collect()
    assert (rows[0].title, rows[0].authors, rows[0].paper_url, rows[0].github_url) == ("H", ["A", "B"], "https://arxiv.org/abs/1", "https://GitHub.com/o/r")
    assert (rows[1].title, rows[1].authors, rows[1].published_date, rows[1].github_url) == ("T", ["A"], "2024-01-02", "https://github.com/o/r")
    assert rows[2].title is None
    assert apply(spark, ["<p>a</p><p>b &amp; c</p>", None], lambda c: html.html_text(c, "\n")) == ["a\nb & c", None]


def test_product_page():
    page = '<title>Notion reviews. Is it good?</title><div><span>Pricing:</span><a>Free Trial</a></div>'
    assert html.product_fields(page)[:2] == ["Notion", ["Pricing:", "Free Trial"]]
    assert html.product_fields('<div class="font-bold">Foo</div><div itemtype="http://schema.org/Offer"><b itemprop="price">0</b></div>') == ["Foo", [], "0"]


def test_article_lengths():
    body = lambda n: "<article><p>" + "x" * n + "</p><p>" + "y" * 20 + "</p></article>"
    assert html.article_body(body(21), "wired") == "x" * 21
    assert html.article_body("<p>no container, whatever its length</p>", "wired") == ""


def test_more_spellings_of_dates(spark):
    now = F.lit("2026-09-05 00:00:00").cast("timestamp")
    want = {
        "04 Sep 26 17:18:00 GMT": "2026-09-04T17:18:00Z", "4 Sep 70 17:18": "1970-09-04T17:18:00Z", "Fri Sep  4 17:18:00 2026": "2026-09-04T17:18:00Z", "Sep 4 17:18:00 2026": "2026-09-04T17:18:00Z",
        "20260904T135135Z": "2026-09-04T13:51:35Z", "20260904T1351+0200": "2026-09-04T11:51:00Z", "2026-09-04T13": "2026-09-04T13:00:00Z", "2026-09-04T13:51:35,5": "2026-09-04T13:51:35Z", "2026-W36-5": "2026-09-04T00:00:00Z",
        "2026W36": "2026-08-31T00:00:00Z", "2026-09-04T13:51-04:00": "2026-09-04T17:51:00Z", "2026-W54-1": None, "Foo 4 17:18:00 2026": None, "20261304T000000": None,
    }
    rows = spark.createDataFrame([(k,) for k in want], "raw string")
    assert {r.raw: r.at for r in rows.select("raw", dates.iso_utc(dates.parse_datetime(F.col("raw"), now)).alias("at")).collect()} == want


def test_article_bodies_by_site():
    long = "This paragraph is long enough to count as one of the text, and it goes on for a while."
    page = f"<body><article><p>{long} One</p></article><div class='x duet--article--body'><p>{long}<b> Two </b>!<p>short</div><div class='entry-content wide'><p>{long} Three</p></div>"
    page += f"<div itemprop='articleBody'><p>{long} Four</p></div><div data-testid='BodyWrapper'><p>{long} Five</p></div><div class='news-article--content'><p>{long} Six</p></div><span class='news-article--author'> A B </span></body>"
    assert {site: html.article_body(page, site).split()[-1] for site in html.ARTICLE_CONTAINERS} == {"techcrunch": "Three", "theverge": "while.Two!", "mit": "Six", "arstechnica": "Four", "wired": "Five"}
    alone = f"<article><p><b>{long}<br><p>{long} Two</article>"
    assert html.article_body(alone, "techcrunch") == "" and all(html.article_body(alone, s) == f"{long}\n\n{long} Two" for s in ("theverge", "mit", "arstechnica", "wired"))
    assert html.article_author(page, "mit") == "A B" and html.article_author(page, "wired") is None


def test_character_references(spark):
    import html as html_lib

    texts = ["Nestl&eacute;", "AT&amp;T", "&amp;lt;", "A & B", "&", "", None, "&#233;&#xE9;&#X41;", "x&hellip;y&mdash;z", "&unknown; &eacute", "M&amp M &ltb", "&&amp;&", "Zo&euml; &Auml;&Ouml;&szlig; &bull;", "&#0; &#xD800;", "&copy 2024 &rsquo;"]
    want = [None if t is None else html_lib.unescape(t) for t in texts]
    assert apply(spark, texts, names.unescape) == want
    assert apply(spark, ["Nestl&eacute; GmbH"], names.display_name) == ["Nestlé"]


def test_all_character_references(spark):
    """Every name of the standard list with and without its semicolon, and every kind of number, against the standard decoder."""
    import html
    from html.entities import html5

    bodies = [n.removesuffix(";") for n in html5]
    cases = [f"A &{b}{end} B" for b in sorted(set(bodies)) for end in (";", "", "x", "=1")]
    numbers = [*range(0, 300), 0x2019, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**12]
    cases += [f"{x}&#{n}{end}" for n in numbers for x in ("", "a&") for end in (";", "", "z", ";;")] + [f"&#{x}{n:X}{end}" for n in numbers for x in "xX" for end in (";", "", " 1")]
    cases += ["&", "&&amp;", "&#;", "&#x;", "&#xg;", "&;", "a & b", "&amp", "&ampamp;", "&notit;", "&notin;", "Sotheby&#146;s", "&#00065;", "&#x0000041", "é&eacute;&Eacute"]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string").repartition(4)
    got = {r.i: r.u for r in rows.select("i", names.unescape(F.col("t")).alias("u")).collect()}
    wrong = [(c, got[i], html.unescape(c)) for i, c in enumerate(cases) if got[i] != html.unescape(c)]
    assert not wrong, (len(wrong), wrong[:5])
