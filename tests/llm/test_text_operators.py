import base64
import collections
import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import boilerplate, chroma, entry, langid, linedup, mixing, neardup, packing, sharding, shingles, suffixlm, vecdup

DOCS = "doc_id long, text string, lang string, source string, extra string"


def test_profiles_against_brute_force():
    text = "Le chat, le chien; l'été à 5h"
    counts = collections.Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        marked = f"_{word}_"
        for n in (1, 2, 3):
            counts.update(marked[i : i + n] for i in range(len(marked) - n + 1) if marked[i : i + n] != "_")
    assert sum(counts.values()) == len(langid.grams(text))
    assert sorted(counts.values()) == sorted(np.unique(langid.grams(text), return_counts=True)[1].tolist())


def test_out_of_place_distance():
    a, b = langid.ranked("the cat sat on the mat", 30), langid.ranked("der hund und die katze", 30)
    judge = langid.Judge({"a": a, "b": b}, 30)
    place = {int(g): i for i, g in enumerate(b)}
    want = sum(min(30, abs(place[int(g)] - i)) if int(g) in place else 30 for i, g in enumerate(a))
    assert judge.distances(a).tolist() == [0, want]
    assert judge.predict(None) == judge.predict("12 !?") == ("und", 0.0)


def test_held_out_accuracy(spark, sf_dir):
    got = entry.op3_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got.collect())


def test_language_query_against_brute_force(spark, sf_dir):
    """Profiles, ranks, distances and ties of the whole query, from plain counters."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()

    def counts_of(text):
        out = collections.Counter()
        for word in "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "").split():
            marked = f" {word} "
            out.update(marked[i : i + n] for n in (1, 2, 3) for i in range(len(marked) - n + 1) if marked[i : i + n] != " ")
        return out

    def value(gram):
        points = [0 if c == " " else ord(c) for c in gram]
        return sum(p << 21 * k for k, p in enumerate(reversed(points))) | (len(gram) == 2) << 62

    def ranks(counts):
        return sorted(counts, key=lambda g: (-counts[g], value(g)))[:400]

    totals = collections.defaultdict(collections.Counter)
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            totals[r.lang].update(counts_of(r.text))
    places = {lang: {g: i for i, g in enumerate(ranks(c))} for lang, c in totals.items()}
    got = {r.doc_id: r for r in entry.op3_language_id(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        own = ranks(counts_of(r.text))
        if not own:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        far = {lang: sum(min(400, abs(p[g] - i)) if g in p else 400 for i, g in enumerate(own)) for lang, p in places.items()}
        best = min(far, key=lambda x: (far[x], x))
        assert got[r.doc_id].lang_pred == best and got[r.doc_id].score == pytest.approx(1 - far[best] / (400 * len(own)))


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en", "s", "x"), (2, None, "en", "s", "x"), (3, "", None, None, None), (4, "le chat et le chien", "fr", "s", "x"), (4, "le chat et le chien", "fr", "s", "x"), (None, "123", "en", None, "x")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("clash"))
    profiles = langid.learn(docs)
    got = langid.identify(docs, profiles)
    assert sorted(r.lang_pred for r in got.collect()) == ["en", "fr", "fr", "und", "und", "und"]
    kept = langid.accept(docs.drop("score"), profiles)
    assert kept.columns == docs.columns[:-1] and kept.count() == 3
    assert langid.query(docs.where("false")).count() == 0
    assert langid.learn(docs.where("false")) == {} and {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}


POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. "
FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. "
ENGLISH = "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience. "


def test_letter_junk_and_foreign_texts_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", F.lit("x").alias("extra"))
    rng = np.random.default_rng(11)
    letters = list("abcdefghijklmnopqrstuvwxyz     ")
    junk = ["xxxxxxxx zzzzzzz qqqqqqq", *("".join(rng.choice(letters, n)) for n in (150, 400, 3000, 20000)), base64.b64encode(rng.bytes(600)).decode(), *((POLISH * 99)[:n] for n in (60, 200, 900, 5000)), *((FINNISH * 99)[:n] for n in (200, 900, 5000))]
    clean = ["the cat", "hello", ENGLISH[:40], ENGLISH]
    rows = [(10**6 + i, t, None if i % 2 else "en", "s", "x") for i, t in enumerate(junk)] + [(2 * 10**6 + i, t, None, "s", "x") for i, t in enumerate(clean)]
    both = docs.unionByName(spark.createDataFrame(rows, DOCS))
    got = {r.doc_id for r in langid.accept(both, langid.learn(docs)).collect()}
    assert {i for i in got if 10**6 <= i < 2 * 10**6} == set() and {2 * 10**6 + i for i in range(len(clean))} <= got
    assert {r.doc_id for r in docs.collect()} <= got


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Home</a> Site of the news</header><nav><ul><li><a href="/a">The one</a></li><li><a href="/b">of two</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and it is for the best of all who are here, so that you may accept them.</div>
<article><h1>The title &amp; more</h1><p>This is the first paragraph of the text, and it is long
   enough to be seen as one that was written for the people who read it.</p><p>Short one.</p>
<div class="share"><a href="#">Share</a></div><form>Your name <input name="n"></form>
<section class="comments"><p>I think that this is the best of all the articles that I have ever read on the site.</p></section></article>
<aside>Other things that you may like from all of the site, and that are not of this text.</aside>
<footer>&copy; 2024 by the people of the site, all of the rights are with them.</footer></body></html>"""


def test_main_text():
    assert boilerplate.extract(PAGE) == "The title & more\n\nThis is the first paragraph of the text, and it is long enough to be seen as one that was written for the people who read it.\n\nShort one."
    assert boilerplate.extract(None) == boilerplate.extract("") == boilerplate.extract("<p>") == ""


GOOD_TEXT = "It was the best of the days that we had in the year, and there was not one of us who did not know it, for all of them were there to be with us at the end of the road that led to the sea and to the town."


def test_main_text_without_article():
    page = f"<body><div><a href='/'>Home</a> | <a href='/x'>News of the day</a></div><h1>A day</h1><p>{GOOD_TEXT}</p><p>We went.</p><p>{GOOD_TEXT}</p><p>The end.</p><footer>All of it</footer><div>Tags: <a>sea</a> <a>town</a></div></body>"
    assert boilerplate.extract(page) == f"A day\n\n{GOOD_TEXT}\n\nWe went.\n\n{GOOD_TEXT}\n\nThe end."


def test_furniture_by_name():
    for odd in ('class="commentList"', "class=commentlist", 'id="disqus_thread"', 'class="post relatedPosts"', 'id="header"', 'id="site-header"', 'role="navigation"', 'class="ad-slot"', 'style="display: none"', "hidden"):
        page = f"<body><div {odd}><p>{GOOD_TEXT} Not this.</p></div><div><h1>T</h1><p>{GOOD_TEXT}</p></div></body>"
        assert boilerplate.extract(page) == f"T\n\n{GOOD_TEXT}", odd
    for fine in ('class="article-header"', 'class="headerText"', 'id="content"', 'class="adage commentary shared"', 'data-id="header"'):
        assert "This one." in boilerplate.extract(f"<body><div {fine}><p>{GOOD_TEXT} This one.</p></div><div><p>{GOOD_TEXT}</p></div></body>"), fine


def test_a_teaser_in_an_article_does_not_hide_the_text():
    page = f"<body><article><h2>More of this</h2><p>Only a teaser.</p></article><div><h1>A day</h1><p>{GOOD_TEXT}</p><p>{GOOD_TEXT}</p></div></body>"
    assert f"A day\n\n{GOOD_TEXT}\n\n{GOOD_TEXT}" in boilerplate.extract(page)


def test_link_lists_go_and_plain_tables_stay():
    links = "".join(f"<li><a href='/{i}'>a headline of some length that links to another page {i}</a></li>" for i in range(5))
    table = "<table><tr><td>12 | 13 | 14 | 15 | 16 | 17 | 18 | 19 | 20 | 21 | 22 | 23 | 24 | 25 | 26 | 27 | 28</td></tr></table>"
    got = boilerplate.extract(f"<body><div><h1>T</h1><p>{GOOD_TEXT}</p>{table}<ul>{links}</ul><p>{GOOD_TEXT}</p></div></body>")
    assert "headline" not in got and "27 | 28" in got and got.count(GOOD_TEXT) == 2


def test_second_pass():
    g, n, s, b = boilerplate.GOOD, boilerplate.NEAR, boilerplate.SHORT, boilerplate.BAD

    def settle(labels, scopes=None, up=(0,), headings=None, known=None):
        size = len(labels)
        return boilerplate.settle(labels, scopes or [0] * size, list(up), headings or [False] * size, known or [False] * size)

    assert settle([g, s, g, s, b, s, b, n, g]) == [g, g, g, g, b, b, b, g, g]
    assert settle([s, s]) == [s, s] and settle([]) == []
    assert settle([b, s, g], headings=[False, True, False]) == [b, g, g]
    # the own container counts before what is nearer outside it, and furniture does not lend its label
    assert settle([g, s, s, b], [1, 1, 1, 2], [0, 0, 0]) == [g, g, g, b]
    assert settle([b, s, g], known=[True, False, False]) == [b, g, g]


def test_odd_pages_take_time_in_proportion():
    import time

    for odd in ("<a " * 350_000, "<div>" * 100_000 + "</p>" * 100_000, '<a "x>" ' * 120_000, "<button>" * 120_000, "<div>x" * 160_000, "<p>x" * 250_000, "<!--" * 250_000, "<" * 1_000_000):
        began = time.process_time()
        boilerplate.extract(odd)
        assert time.process_time() - began < 4


def test_main_text_of_odd_rows(spark):
    rows = [(1, None, "t", "h"), (1, "", "t", "h"), (2, PAGE, None, "h"), (2, PAGE, None, "h"), (None, "no tags", "t", "h")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, _html string")
    got = boilerplate.extract_text(pages)
    assert got.columns == ["page_id", "_html", "text"] and got.count() == 5
    texts = [r.text for r in got.collect()]
    assert texts.count("") == 3 and texts.count(boilerplate.extract(PAGE)) == 2  # text without a heading or an article is not told from other text
    assert boilerplate.extract_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("tag", ["article", "div", None])
def test_blocks_are_found_without_the_article_tag(spark, sf_dir, tag):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    put = (f"<{tag}>", f"</{tag}>") if tag else ("", "")
    for page in pages:
        assert boilerplate.extract(page.replace("<article>", put[0]).replace("</article>", put[1])) == boilerplate.extract(page)


def test_pages_query(spark, sf_dir):
    import html as html_lib

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = entry.op4_main_text(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for row in got:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[row.page_id], re.S)[1]
        inner = html_lib.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", "\x01", inner)))
        blocks = [re.sub(r"\s+", " ", x).strip() for x in inner.split("\x01")]
        assert row.text == "\n\n".join(x for x in blocks if x) and row.n_chars == len(row.text)


def words_of(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall("[^\x20\x09-\x0d]+", low)


def shingles_of(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_by_hand(texts, percent):
    sets = {i: shingles_of(t) for i, t in texts.items()}
    ids = sorted(sets)
    held, links = collections.defaultdict(list), []
    for b in ids:
        common = collections.Counter()
        for shingle in sets[b]:
            common.update(held[shingle])
            held[shingle].append(b)
        links += [(a, b) for a, both in common.items() if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)]
    return {i: len(s) for i, s in sets.items()}, least_reachable(ids, links)


def check_near(docs, percent=85):
    texts = {r.doc_id: r.text for r in docs.collect()}
    sizes, parts = near_by_hand(texts, percent)
    got = neardup.query(docs).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, sizes[i], parts[i], parts[i] == i) for i in texts} and len(got) == len(texts)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_near_duplicates_against_brute_force(spark, sf):
    check_near(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text"))


def test_near_duplicate_group(spark):
    """A group of copies with one to four replaced words each: linked and unlinked neighbours in the same buckets."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        w = list(base)
        for at in rng.choice(150, rng.integers(0, 5), replace=False):
            w[at] = f"x{rng.integers(40)}"
        rows.append((1000 - i, " ".join(w)))
    check_near(spark.createDataFrame(rows, "doc_id long, text string"))


def test_near_duplicate_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one\ttwo"), (6, "one two three"), (7, "a b c d e"), (8, "A B C D E "), (9, "É x y z w"), (10, "é x y z w"), (11, "w " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_near(docs)
    extra = docs.unionByName(docs.where("doc_id = 4")).unionByName(spark.createDataFrame([(None, "a b c d e")], "doc_id long, text string")).withColumn("n_shingles", F.lit("x"))
    got = neardup.query(extra).collect()
    assert len(got) == len(rows) + 1 and [r.kept for r in got if r.doc_id is None] == [True]
    kept = neardup.keep_one(extra)
    assert kept.columns == extra.columns and {5, 8} & {r.doc_id for r in kept.collect()} == set()
    assert neardup.query(docs.where("false")).count() == 0


def test_repeated_ids_with_other_texts(spark):
    """Of the texts that share an id one counts: links and cuts of one text do not reach the other."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = "doc_id long, text string"
    got = {r.doc_id: r.component_id for r in neardup.query(spark.createDataFrame([(1, a), (2, b), (7, a), (7, b)], docs)).collect()}
    assert got[1] == 1 and got[2] == 2 and got[7] in (1, 2)
    cut = linedup.dedup_lines(spark.createDataFrame([(1, a), (7, a), (7, b), (7, b)], docs)).collect()
    left = sorted((r.doc_id, r.text) for r in cut)
    assert left in ([(1, a), (7, ""), (7, b), (7, b)], [(1, a), (7, a), (7, b), (7, b)])


OWN = ["rank", "_rank", "_at", "_id", "_bits", "_html", "_text", "_slot", "_guess", "_score", "_kind", "score", "slot", "shard", "version", "mark", "part", "_source", "_block"]


def test_columns_of_any_name_pass_through(spark):
    """Every operator that returns its input's columns, beside columns with the names that it uses itself."""
    text = "the cat sat on the mat and the dog lay in the sun by the door of the old house"
    rows = [(i, text + f" {i}", "en", "s", 10) for i in range(6)] + [(None, None, None, None, None), (6, "", "en", "s", 0), (6, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").withColumns({c: F.lit(f"own {c}") for c in OWN})
    added = {"slot", "slot_row"}, {"shard"}, {"n_lines", "n_removed"}, {"n_tokens", "bucket", "batch", "batch_row"}
    for out, new in zip((mixing.mix(docs), sharding.place(docs, "doc_id"), linedup.dedup_lines(docs), packing.pack(docs)), added, strict=True):
        assert set(out.columns) == set(docs.columns) | new and out.count() == len(rows)
        assert all(r[c] == f"own {c}" for r in out.collect() for c in OWN if c not in new)
    for out in (langid.accept(docs, langid.learn(docs)), neardup.keep_one(docs), mixing.interleave(docs)):
        assert out.columns == docs.columns and out.count() > 0
        assert all(r[c] == f"own {c}" for r in out.collect() for c in OWN)


def test_odd_sketch_bounds_and_estimates():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 63, 4000, dtype=np.uint64)
    for n, shared in ((100, 95), (400, 390), (1000, 700)):
        a, b = np.sort(pool[:n]), np.sort(pool[n - shared : 2 * n - shared])
        p = neardup.parities([a, b]).view(np.uint64)
        assert sum(int(x).bit_count() for x in p[0] ^ p[1]) <= 2 * (n - shared)
        j = shared / (2 * n - shared)
        m = np.stack([neardup.samples(a), neardup.samples(b)])
        assert abs((m[0] == m[1]).mean() - j) < 0.2
        s = neardup.odd_sketches(m).view(np.uint64)
        if j >= 0.85:
            assert sum(int(x).bit_count() for x in s[0] ^ s[1]) <= neardup.most_odd_bits(0.85)


def test_shingle_hashes():
    texts = ["A b  c\td e f", "a B c d e f", "a b", "", "a b c d f e"]
    sets = shingles.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [2, 2, 1, 0, 2] and (sets[0] == sets[1]).all() and shingles.overlap(sets[0], sets[4]) == 0


def lines_query(spark, texts):
    docs = spark.createDataFrame([(i, t, "k") for i, t in texts], "doc_id long, text string, n_lines string")
    return {r.doc_id: r for r in linedup.dedup_lines(docs).collect()}


def line(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_line_dedup(spark):
    long, a, b, c = line("l", 60), line("a", 20), line("b", 20), line("c", 20)
    got = lines_query(
        spark,
        [(1, f"x\n{long}\ny"), (2, f"{long}\nz\nx"), (3, f"{a}\n{b}\n{c}\nend 3"), (4, f"own\n{a}\n {b} \n{c}"), (5, f"{a}\n{b}\nnot long enough"), (6, f"{long}\nmid\n{long}"), (7, None), (8, ""), (9, f"{a}\n{c}\n{b}")],
    )
    assert [got[i].text for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [f"x\n{long}\ny", "z\nx", f"{a}\n{b}\n{c}\nend 3", "own", f"{a}\n{b}\nnot long enough", "mid", None, ""]
    assert got[9].text == f"{a}\n{c}\n{b}" and (got[4].n_lines, got[4].n_removed, got[7].n_lines) == (4, 3, 0)


def test_line_dedup_of_many_copies_and_periods(spark):
    long = line("l", 80)
    texts = [(i, f"head {i}\n{long}\ntail {i}") for i in range(300)] + [(1000, "\n".join(["tick"] * 3000)), (1001, "\n" * 2000)]
    got = lines_query(spark, texts)
    assert all(got[i].text == f"head {i}\ntail {i}" for i in range(1, 300)) and got[0].n_removed == 0
    assert got[1000].n_removed == 2999 or got[1000].text.count("tick") <= 50
    assert got[1001].n_removed == 0


def test_every_long_repeat_goes(spark, sf_dir):
    """Guarantee and restraint, by brute force: windows of 50 words that occurred before in another document are gone, and only lines with such an origin are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    left = {r.doc_id: (r.text, r.n_removed) for r in linedup.dedup_lines(docs).collect()}
    first, all_lines = {}, {}
    for i in sorted(texts):
        lines = [" ".join(x.split()) for x in texts[i].split("\n")]
        for s in range(len(lines)):
            all_lines.setdefault(lines[s], (i, s))
            total, e = 0, s
            while e < len(lines) and total < 50:
                total += len(lines[e].split())
                e += 1
            if total >= 50 and first.setdefault(tuple(lines[s:e]), i) != i:
                assert max(lines[s:e], key=len) not in [" ".join(x.split()) for x in left[i][0].split("\n")]
    for i, text in texts.items():
        gone = collections.Counter(" ".join(x.split()) for x in text.split("\n")) - collections.Counter(" ".join(x.split()) for x in left[i][0].split("\n"))
        if left[i][1]:
            assert all(not x or all_lines[x][0] < i or text.count(x) > 1 for x in gone)


def lines_by_hand(texts, least=50):
    """What is left when every line goes that lies in a run of so many words that occurred at an earlier place."""
    seen, left = set(), {}
    for i in sorted(texts):
        lines, gone = texts[i].split("\n"), set()
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[s:e]) >= least:
                    if tuple(lines[s:e]) in seen:
                        gone.update(range(s, e))
                    seen.add(tuple(lines[s:e]))
        left[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return left


def test_repeats_with_another_first_place(spark):
    """A frequent line whose first place goes on differently hides no repeat, across documents or inside one."""
    texts = {}
    for k in range(12):
        f, x, y, tail = line(f"f{k}_", 30), line(f"x{k}_", 25), line(f"y{k}_", 30), line(f"t{k}_", 3)
        texts |= {10 * k: f"{f}\n{y}", 10 * k + 1: f"{f}\n{x}\n{tail}", 10 * k + 2: f"{f}\n{x}\n{tail}", 10 * k + 3: f"{f}\n{x}"}
        f, x, y = line(f"F{k}_", 30), line(f"X{k}_", 25), line(f"Y{k}_", 30)
        texts[10 * k + 4] = f"{f}\n{y}\n{f}\n{x}\nend\n{f}\n{x}"
    rng = np.random.default_rng(12)
    for i in range(120):
        texts[1000 + i] = "\n".join(line(f"r{j}_", (3, 10, 17, 24, 31, 38)[j]) for j in rng.integers(0, 6, 9))
    got = lines_query(spark, list(texts.items()))
    assert {i: got[i].text for i in texts} == lines_by_hand(texts)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents_are_cut_exactly(spark, sf):
    """Every line in a repeated run of 50 words goes and no other does. A run is the union of the shortest such runs from each of its lines and up to each."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen, want = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").split("\n")
        lines = [" ".join(x.split()) for x in raw]
        total = np.concatenate([[0], np.cumsum([len(x.split()) for x in raw])])
        runs = set()
        for k in range(len(lines)):
            if total[-1] - total[k] >= 50:
                runs.add((k, int(np.searchsorted(total, total[k] + 50))))
            if total[k + 1] >= 50:
                runs.add((int(np.searchsorted(total, total[k + 1] - 50, side="right")) - 1, k + 1))
        gone = set()
        for a, b in sorted(runs):
            run = tuple(lines[a:b])
            if run in seen:
                gone.update(range(a, b))
            seen.add(run)
        want[i] = "\n".join(x for k, x in enumerate(raw) if k not in gone)
    got = {r.doc_id: r.text for r in linedup.dedup_lines(docs).collect()}
    assert {i: t or "" for i, t in got.items()} == want and sum(len(texts[i] or "") != len(t) for i, t in want.items()) > 3


def test_line_edges(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert linedup.dedup_lines(rows).count() == 3 and linedup.dedup_lines(rows.where("false")).count() == 0


def test_scores(spark, sf_dir):
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b"\n"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = collections.Counter(w for i, t in texts.items() if not out[i] for w in t)
    n, v = sum(c.values()), len(c)
    got = entry.op10_suffix_scores(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_score_edges(spark):
    rows = [(i, "the cat sat on the mat " * 8) for i in range(40)] + [(100, None), (101, ""), (102, "unseen words only"), (5, "the cat sat"), (None, "the cat")]
    got = suffixlm.query(spark.createDataFrame(rows, "doc_id long, text string").withColumn("token", F.lit(1))).collect()
    assert len(got) == len(rows) and all(math.isfinite(r.score) for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (100, 101)] == [1, 1]
    assert suffixlm.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    repeated = [r for r in got if r.doc_id == 7][0]
    assert repeated.score > repeated.base_score


class TreeByHand:
    """The suffix tree by its definitions, over symbol sequences (start, words..., end) of the training texts."""

    def __init__(self, texts, s):
        c = collections.Counter(w for t in texts for w in t)
        self.n, self.v, self.s, self.c = sum(c.values()), len(c), s, c
        self.base = self.n + self.v + 1
        self.mass = collections.Counter({k: 1 / suffixlm.CLASSES for k in range(suffixlm.CLASSES)})
        for w, m in c.items():
            if self.symbol(w) != w:
                self.mass[self.symbol(w)] += m + 1
        rows = [["START", *map(self.symbol, t)] for t in texts]
        self.next = collections.defaultdict(collections.Counter)
        for row in rows:
            for j in range(1, len(row)):
                for d in range(1, min(s.depth, j) + 1):
                    self.next[tuple(row[j - d : j])][row[j]] += 1
        self.total = {x: sum(f.values()) for x, f in self.next.items()}
        self.stored = {x: {y: m for y, m in f.items() if m >= s.min_pair} for x, f in self.next.items()}
        self.states = set()
        for x in self.next:
            if self.total[x] >= s.min_context and self.divergence(x) >= s.min_divergence:
                self.states.update(x[i:] for i in range(len(x)))

    def symbol(self, w):
        return w if w == b"\n" or self.c[w] >= self.s.min_symbol else self.kind(w)

    @staticmethod
    def kind(w):
        laid = suffixlm.lay([w])
        return int(laid.classes[1]) - 2

    def root(self, y):
        return (self.mass[y] if isinstance(y, int) else self.c[y] + 1) / self.base

    def divergence(self, x):
        kl = p_all = q_all = 0.0
        for y, m in self.stored[x].items():
            p = m / self.total[x]
            q = self.root(y) if len(x) == 1 else self.next[x[1:]][y] / self.total[x[1:]]
            kl, p_all, q_all = kl + p * math.log(p / q), p_all + p, q_all + q
        if not self.stored[x]:
            return -1.0
        if p_all < 1 - 1e-9:
            kl += max(1 - p_all, 1e-12) * math.log(max(1 - p_all, 1e-12) / max(1 - q_all, 1e-12))
        return kl - len(self.stored[x]) / (2 * self.total[x])

    def prob(self, x, y):
        """Of the symbol y in the state x."""
        if not x:
            return self.root(y)
        stored, total, less = self.stored[x], self.total[x], self.s.discount
        rest = (total - sum(stored.values()) + less * len(stored)) / total if stored else 1.0
        return (max(stored.get(y, 0) - less, 0) if y in stored else 0) / total + rest * self.prob(x[1:], y)

    def state(self, before):
        """The longest suffix of what precedes that is a state."""
        while before and tuple(before) not in self.states:
            before = before[1:]
        return tuple(before)

    def score(self, t):
        row, out = ["START", *map(self.symbol, t)], 0.0
        for j, w in enumerate(t, start=1):
            y = row[j]
            out += math.log10(self.prob(self.state(row[max(0, j - self.s.depth) : j]), y))
            if isinstance(y, int):
                out += math.log10((self.c[w] + 1) / self.base / self.root(y))
        return out


def tokens_by_hand(text):
    return (text or "").encode().lower().split() + [b"\n"]


SMALL = suffixlm.Settings(depth=4, min_symbol=12, min_context=6, min_pair=2)


@pytest.mark.parametrize("limits", [{}, {"held_pairs": 200, "known_share": 1e-2}, {"held_pairs": 0, "filter_bits": 8, "min_divergence": 0.2}, {"depth": 2}, {"depth": 1}, {"depth": 5, "min_pair": 6}])
def test_scores_against_a_tree_by_hand(spark, sf_dir, limits):
    s = SMALL._replace(**limits)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 20000")
    texts = {r.doc_id: tokens_by_hand(r.text) for r in docs.collect()}
    tree = TreeByHand([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2], s)
    assert sum(len(x) == min(3, s.depth) for x in tree.states) > 3 and max(map(len, tree.states)) >= min(4, s.depth)
    got = suffixlm.query(docs, s).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.score == pytest.approx(tree.score(texts[r.doc_id]), rel=1e-6)


def test_a_tree_that_tasks_cannot_hold_is_whole(spark, sf_dir):
    """With fewer symbols, contexts and pairs held than there are the scores stay those of the whole tree."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 100 and length(text) < 20000")
    whole = {r.doc_id: r.score for r in suffixlm.query(docs, SMALL).collect()}
    for limits in ({"max_contexts": 3}, {"max_symbols": 10, "max_contexts": 0, "held_pairs": 0, "filter_bits": 8}):
        got = suffixlm.query(docs, SMALL._replace(**limits)).collect()
        assert {r.doc_id: r.score for r in got} == pytest.approx(whole, rel=1e-9)


def test_next_symbol_probabilities_sum_to_one(spark, sf_dir):
    texts = [tokens_by_hand(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    tree = TreeByHand(texts, SMALL)
    words = {tree.symbol(w) for w in tree.c} | set(range(suffixlm.CLASSES))
    for x in sorted(tree.states, key=str)[:40]:
        assert sum(tree.prob(x, y) for y in words) == pytest.approx(1, abs=1e-9)


def test_a_larger_corpus_has_a_larger_tree(spark):
    """Twice the texts, of other words: about twice the states and pairs, and none of the first is lost."""
    from loomspan.plans.scratch import Scratch

    rng = np.random.default_rng(5)
    sizes = []
    for parts in (1, 2):
        rows = []
        for part in range(parts):
            words = [f"w{part}x{i}" for i in range(30)]
            after = rng.integers(0, 30, (30, 2))
            for _ in range(60):
                w, out = 0, []
                for _ in range(80):
                    out.append(words[w])
                    w = int(after[w][rng.integers(0, 2)])
                rows.append((len(rows), " ".join(out)))
        model, _, _ = suffixlm.learn(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t"), SMALL)
        sizes.append((sum(int(x.is_state.sum()) for x in model.tree.levels), sum(int(x.is_held.sum()) for x in model.tree.levels)))
    assert all(b > 1.5 * a for a, b in zip(*sizes, strict=True))


def test_long_texts_and_repeated_rows_are_scored(spark):
    long = "the cat sat on the mat and the dog sat on the log " * 60_000
    rows = [(7, long, "x"), (7, long, "y"), (2, "the cat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumns({"kind": F.lit("k"), "h": F.lit(1)})
    got = sorted(suffixlm.query(docs).collect(), key=lambda r: r.n_tokens)
    assert [r.n_tokens for r in got] == [3, 780_001, 780_001] and got[1].score == pytest.approx(got[2].score) and got[1].score > got[1].base_score


def vectors(rng, n, copies, near):
    base = rng.standard_normal((n, 64)).astype(np.float32)
    rows = [base[i] for i in range(n)] + [base[0]] * copies + [base[1] + rng.standard_normal(64).astype(np.float32) * s for s in np.linspace(0.01, 0.5, near)]
    return rows


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v], int(rng.integers(3)) if i < 200 else 1) for i, v in enumerate(vectors(rng, 220, 30, 60))]
    rows += [(900, None, 1), (901, [0.0] * 64, 1), (902, [float("nan")] * 64, 1), (903, rows[0][1], None), (904, [float(x) for x in rows[1][1][:32]], 1), (905, [], 1)]
    links = []
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, label in rows if i < 900}
    label = {i: k for i, _, k in rows}
    for i in unit:
        for j in unit:
            if i < j and label[i] == label[j] and unit[i] @ unit[j] >= 0.93:
                links.append((i, j))
    parts = least_reachable([r[0] for r in rows], links)
    degree = collections.Counter(x for pair in links for x in pair)
    got = vecdup.query(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(links) > 400 and len(got) == len(rows)
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(i, degree[i], parts[i], parts[i] == i) for i in parts}


def links_by_hand(rows):
    """(vec_id -> number of links, vec_id -> least reachable) over all pairs of one label, in blocks."""
    by = collections.defaultdict(list)
    for i, v, k in rows:
        if v is not None and k is not None and len(v) and np.isfinite(v).all() and np.any(v):
            by[k, len(v)].append(i)
    value, degree, links = {i: v for i, v, _ in rows}, collections.Counter(), []
    for ids in by.values():
        x = np.array([value[i] for i in ids], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for at in range(0, len(ids), 500):
            near = x[at : at + 500] @ x.T >= vecdup.THRESHOLD
            for p, q in zip(*np.nonzero(near), strict=True):
                if at + p < q:
                    links.append((ids[at + p], ids[q]))
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    return links, degree, least_reachable([r[0] for r in rows], links)


@pytest.mark.parametrize("sf", ["sf0.1", "check_s"])
def test_all_links_of_the_embeddings_are_found(spark, sf):
    if not os.path.exists(f"/root/testdata/{sf}/embeddings.parquet"):
        pytest.skip("no such table here")
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding), r.label) for r in table.collect()]
    links, degree, parts = links_by_hand(rows)
    got = vecdup.query(table).collect()
    assert (links or sf == "sf0.1") and {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, degree[i], parts[i]) for i in parts}


def test_buckets_of_many_tiles(spark, monkeypatch):
    """Two large groups of near vectors and copies among them, cut into tiles of 40 rows."""
    monkeypatch.setattr(vecdup, "TILE_ROWS", 40)
    rng = np.random.default_rng(8)
    a, b = rng.standard_normal((2, 64))
    rows = [(i, (a if i % 2 else b) + rng.standard_normal(64) * 0.12, i % 3) for i in range(500)]
    rows += [(500 + i, rows[i][1].copy(), rows[i][2]) for i in range(0, 100, 7)]
    links, degree, parts = links_by_hand(rows)
    got = vecdup.query(spark.createDataFrame([(i, [float(x) for x in v], k) for i, v, k in rows], "vec_id long, embedding array<double>, label int")).collect()
    found = {r.vec_id: r for r in got}
    assert len(links) > 10_000 and sum(r.n_links for r in got) >= 0.999 * 2 * len(links)
    assert all(r.n_links <= degree[i] and r.component_id == parts[i] for i, r in found.items())


def test_vector_edges(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in vecdup.query(rows).collect()} == {(1, 0, 1, True), (None, 0, None, True)}
    assert vecdup.query(rows.where("false")).count() == 0


def test_repeated_ids_do_not_depend_on_the_order(spark):
    rows = [(1, [1.0, 2.0, 0.5], 1), (2, [1.0, 2.0, 0.5], 1), (2, [-1.0, 2.0, 0.5], 1), (3, [-1.0, 2.0, 0.5], 1)]
    got = [{(r.vec_id, r.n_links, r.component_id) for r in vecdup.query(spark.createDataFrame(x, "vec_id long, embedding array<float>, label int").repartition(n)).collect()} for x, n in ((rows, 1), (rows[::-1], 1), (rows, 3))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 3


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 64))
    y = x + rng.standard_normal((400, 64)) * 0.35
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    a, b = vecdup.codes(x), vecdup.codes(y)
    bits = np.unpackbits(a["code"].view(np.uint8), bitorder="little").reshape(400, 64)
    planes = np.unpackbits(b["planes"].view(np.uint8), bitorder="little").reshape(400, vecdup.PLANES, 64)
    common = sum((1 << j) * (bits & planes[:, j]).sum(axis=1) for j in range(vecdup.PLANES))
    est = (2 * (b["low"] * a["ones"] + b["step"] * common) - b["base"]) * a["scale"]
    whole, bounds = vecdup.estimate(a["code"].view(np.uint64), b["planes"].view(np.uint64), *(np.stack([c[t] for t in vecdup._FLOATS], axis=1) for c in (a, b)))
    assert np.allclose(np.diag(whole), est, atol=1e-5) and np.allclose(np.diag(bounds), a["bound"] + b["blur"] * a["scale"])
    err = est - (x * y).sum(axis=1)
    assert abs(err.mean()) < 0.02 and (np.abs(err) <= a["bound"] + b["blur"] * a["scale"]).all()


def test_fingerprints_align(spark):
    rng = np.random.default_rng(3)
    tones = np.concatenate([np.sin(2 * np.pi * f * np.arange(2000) / chroma.RATE) for f in rng.uniform(200, 2000, 30)])
    song = ((tones + rng.standard_normal(len(tones)) * 0.05) * 60 + 128).clip(0, 255).astype(np.uint8).tobytes()
    other = (rng.standard_normal(60000) * 40 + 128).clip(0, 255).astype(np.uint8).tobytes()
    a, b = chroma.fingerprint(song), chroma.fingerprint(song[chroma.HOP * 100 :])
    offset, votes, overlap, errors = chroma.align(a, b)
    assert offset == -100 and overlap == len(b) and votes >= 0.9 * len(b) and errors <= 16  # smoothing differs in the first frames; steady runs do not vote
    noisy = (np.frombuffer(song, np.uint8).astype(int) + rng.integers(-6, 7, len(song))).clip(0, 255).astype(np.uint8).tobytes()
    rows = [(5, song), (6, noisy), (7, other), (8, song), (9, None), (10, b"short"), (None, song)]
    got = {r.rec_id: r for r in chroma.match_recordings(spark.createDataFrame(rows, "rec_id long, a binary"), "rec_id", F.col("a")).collect()}
    assert [got[i].component_id for i in (5, 6, 7, 8, 9, 10, None)] == [5, 5, 7, 5, 9, 10, None]
    assert got[6].ref_id == 5 and got[6].offset == 0 and got[9].n_codes == 0
    assert chroma.match_recordings(spark.createDataFrame([], "rec_id long, a binary"), "rec_id", F.col("a")).count() == 0


def test_alignment_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 3, rng.integers(1, 40)).astype(np.uint32) for _ in range(2))
        first_a, first_b = ({} for _ in range(2))
        for x, first in ((a, first_a), (b, first_b)):
            for i in range(len(x) - 1):
                if x[i] != x[i + 1]:
                    first.setdefault((x[i], x[i + 1]), i)
        votes = collections.Counter(first_b[m] - first_a[m] for m in set(first_a) & set(first_b))
        offset, got, overlap, errors = chroma.align(a, b, 2)
        if not votes:
            assert (offset, got, overlap, errors) == (0, 0, 0, 0)
            continue
        assert got == max(votes.values()) and offset == min(o for o, n in votes.items() if n == got)
        both = [(a[j - offset], b[j]) for j in range(len(b)) if 0 <= j - offset < len(a)]
        assert overlap == len(both) and errors == sum(int(x ^ y).bit_count() for x, y in both)


def by_all_pairs(codes):
    """The least recording that each is linked with, over all pairs."""
    ids = sorted(i for i, c in codes.items() if len(c))
    links = []
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            _, votes, overlap, errors = chroma.align(codes[i], codes[j])
            if votes and chroma.is_match(overlap, errors, len(codes[i]), len(codes[j])):
                links.append((i, j))
    return links, least_reachable(ids, links)


def test_components_are_those_of_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    codes = {r.doc_id: chroma.fingerprint((r.text or "").encode()) for r in docs.collect()}
    _, want = by_all_pairs(codes)
    got = {r.doc_id: r.component_id for r in chroma.query(docs).collect()}
    assert got == {i: want.get(i, i) for i in codes}


def test_components_of_made_recordings(spark):
    """Chains of overlapping parts, noisy copies and one lead-in that unlike recordings share."""
    rng = np.random.default_rng(9)
    noise = lambda n: (rng.standard_normal(n) * 40 + 128).clip(0, 255).astype(np.uint8)
    song, lead, rows = noise(40_000), noise(6_000), {}
    for k in range(6):
        rows[len(rows)] = song[k * 64 * 60 : k * 64 * 60 + 64 * 250]
    for _ in range(8):
        rows[len(rows)] = np.concatenate([lead, noise(20_000)])
    for _ in range(4):
        rows[len(rows)] = (rows[7].astype(int) + rng.integers(-4, 5, len(rows[7]))).clip(0, 255).astype(np.uint8)
    rows[100], rows[101] = np.full(30_000, 128, np.uint8), np.concatenate([np.full(20_000, 128, np.uint8), noise(9_000)])
    codes = {i: chroma.fingerprint(x.tobytes()) for i, x in rows.items()}
    links, want = by_all_pairs(codes)
    assert len(links) > 8 and len(set(want.values())) < len(rows)
    table = spark.createDataFrame([(i, x.tobytes(), "r", 1) for i, x in rows.items()], "doc_id long, a binary, rec_id string, mark int")
    got = {r.rec_id: r for r in chroma.match_recordings(table, "doc_id", F.col("a")).collect()}
    assert {i: r.component_id for i, r in got.items()} == {i: want.get(i, i) for i in rows}
    for r in got.values():
        if r.ref_id is not None:
            assert chroma.align(codes[r.ref_id], codes[r.rec_id]) == (r.offset, r.votes, r.overlap, r.bit_errors) and (r.ref_id, r.rec_id) in links


def test_recall_of_noisy_copies():
    """A landmark needs RUN equal codes in a row; with noise 26 dB below the sound at least nine of ten copies keep one and are matched."""
    rng = np.random.default_rng(12)
    found = 0
    for _ in range(40):
        tones = np.concatenate([np.sin(2 * np.pi * f * np.arange(1500) / chroma.RATE) for f in rng.uniform(200, 2500, 20)])
        copy = tones[chroma.HOP * 40 :] + rng.standard_normal(len(tones) - chroma.HOP * 40) * 0.035
        a, b = (chroma.fingerprint((x * 60 + 128).clip(0, 255).astype(np.uint8).tobytes()) for x in (tones, copy))
        offset, votes, overlap, errors = chroma.align(a, b)
        found += votes > 0 and offset == -40 and chroma.is_match(overlap, errors, len(a), len(b))
    assert found >= 36


def test_repeated_ids_and_long_recordings(spark):
    rng = np.random.default_rng(2)
    x, y = (bytes(rng.integers(0, 256, 30_000, dtype=np.uint8)) for _ in range(2))
    longest = bytes(rng.integers(0, 256, 3_000_000, dtype=np.uint8))
    rows = [(1, x), (1, x), (2, x), (3, y), (3, x), (3, y), (4, longest), (5, longest[: 2_000_000])]
    for some in (rows, rows[::-1]):
        got = {r.rec_id: r.component_id for r in chroma.match_recordings(spark.createDataFrame(some, "k long, a binary"), "k", F.col("a")).collect()}
        least = min((chroma.xxhash.xxh3_128_intdigest(chroma.fingerprint(z).tobytes()), i) for i, z in enumerate((x, y)))[1]
        assert got == {1: 1, 2: 1, 3: 1 if least == 0 else 3, 4: 4, 5: 4}


def test_integral_image_filters():
    rng = np.random.default_rng(5)
    image = rng.random((40, 12)).astype(np.float32)
    codes = chroma.codes_of(image)
    kind, c, tall, wide = chroma.FILTERS[2]
    assert kind == 2 and len(codes) == 40 - chroma.SPAN + 1
    for t in (0, 7, len(codes) - 1):
        first, second = image[t : t + wide // 2, c : c + tall].sum(), image[t + wide // 2 : t + wide, c : c + tall].sum()
        level = int(np.searchsorted(chroma.STEPS, np.log((1 + first) / (1 + second))))
        assert (int(codes[t]) >> 4) & 3 == level ^ (level >> 1)
