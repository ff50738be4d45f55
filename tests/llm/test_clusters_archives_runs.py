"""Ball-tree clustering, WARC archives and runs of repeated words, against SQL and brute force."""

import collections
import glob
import gzip
import hashlib
import os
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import balltree, entry, periodic, warc
from tests.oracle import compare

VECTORS = "vec_id long, embedding array<float>, label int, _at string, id string, cluster string"
PAGES = "page_id long, url string, html string, key string, shard string, refers_to string"


# ---- clustering


def test_clusters_match_sql(spark, sf_dir):
    compare(spark, sf_dir, entry.op11_centroid_clusters, balltree.oracle())


def _plain_rounds(ids, values, k, rounds, salt):
    order = sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"{salt}:{ids[i]}".encode()).hexdigest())
    centroids = [values[i] for i in order[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for v in values:
            own[place(v)[1]].append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j], strict=True)] if own[j] else c for j, c in enumerate(centroids)]
    return {i: place(v)[::-1] for i, v in zip(ids, values, strict=True)}, centroids


@pytest.mark.parametrize("size", [1.0, 300_000.0])
def test_clusters_of_balls_against_brute_force(spark, size):
    """Tight groups, equal vectors and ties; large integers, which leave the exact doubles."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, size / 4, (6, 4))
    values = np.concatenate([np.repeat(centres, 40, axis=0) + rng.normal(0, size / 900, (240, 4)), np.zeros((30, 4)), np.tile([[size, 0, 0, 0], [-size, 0, 0, 0]], (10, 1))]).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "i long, v array<float>").repartition(3)
    got, centroids = balltree.cluster(frame, "i", "v", 4, 256, 7, 3, "s", tree_rows=64, leaf=4)
    whole = [[int(np.floor(float(x) * 256)) for x in v] for v in values]
    want, finals = _plain_rounds(range(len(rows)), whole, 7, 3, "s")
    assert {r.i: (r.cluster, r.distance) for r in got.collect()} == want
    assert centroids.tolist() == [list(c) for c in finals]


def test_whole_balls_are_handed_over_and_leaves_only_where_needed():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (8, 16))
    points = np.repeat(centres, 500, axis=0) + rng.integers(-9, 10, (4000, 16))
    tree, order = balltree.Tree.build(points)
    balls, owners, rows, labels = tree.walk(centres)
    assert tree.counts[balls].sum() + len(rows) == 4000 and len(rows) < 200 and len(balls) < 400
    label, distance = tree.assign(centres)
    apart = ((points[order][:, None, :] - centres[None]) ** 2).sum(2)
    assert (label == apart.argmin(1)).all() and (distance == apart.min(1)).all()
    for node in range(len(tree.counts)):
        held = tree.points[tree.starts[node] : tree.starts[node] + tree.counts[node]]
        assert (held.sum(0) == tree.sums[node]).all()
        assert np.sqrt(((held - tree.sums[node] / tree.counts[node]) ** 2).sum(1).max()) <= tree.radius[node]


def test_clusters_do_not_depend_on_partitions(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    answers = [sorted(map(tuple, balltree.query(vectors.repartition(n)).collect())) for n in (1, 7)]
    assert answers[0] == answers[1]


def test_cluster_edges(spark):
    good = [0.5] * 64
    rows = [(1, good, 1, "x", "y", "z"), (1, good, 1, "x", "y", "z"), (None, [0.25] * 64, None, None, None, None), (3, None, 1, "", "", ""), (4, [1.0] * 63, 1, "", "", ""), (5, [1.0] * 63 + [None], 1, "", "", "")]
    rows += [(6, [float("nan")] * 64, 1, "", "", ""), (7, [float("-inf")] + good[1:], 1, "", "", ""), (8, [1e30] + good[1:], 1, "", "", ""), (9, [], 1, "", "", "")]
    got = balltree.query(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.vec_id is None, r.vec_id, r.cluster, r.distance) for r in got) == [(False, 1, 0, 0), (False, 1, 0, 0), (True, None, 2, 0)]
    assert {r.inertia for r in got} == {0} and got[0].centroid_sha256 != got[2].centroid_sha256
    empty = balltree.query(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and set(empty.columns) == {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"}


# ---- archives


def test_archive_matches_sql(spark, sf_dir):
    compare(spark, sf_dir, entry.op12_warc_archive, warc.oracle())


def _files(root):
    return {os.path.basename(p): open(p, "rb").read() for p in glob.glob(f"{root}/*.warc.gz")}


def test_archives_are_the_same_bytes_however_rows_are_dealt(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000)).unionByName(pages.limit(3))
    found = []
    for n, parts in ((1, "3"), (9, "11")):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            manifest = warc.write_archive(pages.repartition(n), f"{tmp_path}/{n}", shard_bytes=40_000, roll_bytes=8_000).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        files = _files(f"{tmp_path}/{n}")
        assert {r.file: r.sha1 for r in manifest} == {k: hashlib.sha1(v).hexdigest() for k, v in files.items()}
        assert len({r.shard for r in manifest}) > 2 and any(r.file.endswith("-0001.warc.gz") for r in manifest)
        assert all(r.bytes == len(files[r.file]) and r.records for r in manifest)
        assert sorted(x for x in os.listdir(f"{tmp_path}/{n}") if not x.startswith(".")) == sorted([*files, "manifest"])
        found.append(files)
    assert found[0] == found[1]


def test_archive_by_hand(spark, tmp_path):
    """Records as another program reads them: headers, order, digests, references."""
    rows = [(3, "http://a/x y", "same", "", "", ""), (9, "http://b/\r\nWARC-Type: x", "same", "", "", ""), (5, None, None, "", "", ""), (-2, "http://é", "", "", "", ""), (None, "u", "same", "", "", ""), (7, "z", "grüße\r\n\r\nWARC/1.1", "", "", ""), (9, "http://c", "same", "", "", "")]
    root = f"{tmp_path}/a"
    warc.write_archive(spark.createDataFrame(rows, PAGES), root)
    data = gzip.decompress(b"".join(_files(root).values()))
    at, seen = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        headers = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:])
        block = data[end + 4 : end + 4 + int(headers["Content-Length"])]
        at = end + 4 + len(block) + 4
        assert data[at - 4 : at] == b"\r\n\r\n" and headers["WARC-Block-Digest"] == "sha1:" + warc.digest_py(block)
        seen.append((headers, block.partition(b"\r\n\r\n")[2]))
    assert [h["WARC-Type"] for h, _ in seen] == ["warcinfo", "response", "revisit", "revisit", "response", "response", "response", "revisit"]
    assert [h.get("X-Row-ID") for h, _ in seen[1:]] == [None, "-2", "3", "5", "7", "9", "9"]
    by = {h.get("X-Row-ID"): h for h, _ in seen[1:-1]}
    assert by["3"]["WARC-Refers-To"] == by["9"]["WARC-Record-ID"] and by["-2"]["X-Refers-To-Row-ID"] == "5" and seen[-1][0]["WARC-Refers-To"] == by["9"]["WARC-Record-ID"]
    assert by["3"]["WARC-Target-URI"] == "http://a/x%20y" and by["5"]["WARC-Target-URI"] == "urn:row:5" and len({h["WARC-Record-ID"] for h, _ in seen}) == 8
    assert {p.decode() for h, p in seen[1:] if h["WARC-Type"] == "response"} == {"same", "", "grüße\r\n\r\nWARC/1.1"}
    back = {(r.id, r.record_type): r for r in warc.read_archive(spark, root).collect()}
    assert bytes(back[7, "response"].payload).decode() == "grüße\r\n\r\nWARC/1.1" and back[3, "revisit"].payload_bytes == 4 and back[3, "revisit"].refers_to == 9
    assert all(r.payload_digest == r.declared_digest for r in back.values())


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    rows = [(1, "a", "x", "", "", ""), (2, "b", "x", "", "", ""), (3, "c", "long enough", "", "", ""), (4, "d", "long enough", "", "", "")]
    warc.write_archive(spark.createDataFrame(rows, PAGES), f"{tmp_path}/a", least_revisit=5)
    assert {r.id: (r.record_type, r.refers_to) for r in warc.read_archive(spark, f"{tmp_path}/a").collect()} == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_archive_commit_and_damage(spark, tmp_path):
    root = f"{tmp_path}/a"
    rows = spark.createDataFrame([(i, f"u{i}", f"page {i}", "", "", "") for i in range(50)], PAGES)
    manifest = warc.write_archive(rows, root, shard_bytes=100)
    with pytest.raises(ValueError, match="already"):
        warc.write_archive(rows, root)
    # files that no manifest row names, as a lost attempt leaves them, are not read
    open(f"{root}/part-999999-0000.warc.gz", "wb").write(b"left over")
    assert warc.read_archive(spark, root).count() == 50
    # the renaming job may run again after all or some files have their names
    first = manifest.first()
    assert manifest.mapInArrow(warc._commit(root, f"{root}/_work-gone"), "bytes bigint").count() >= 1
    path = f"{root}/{first.file}"
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-20])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archive(spark, root).count()
    os.remove(path)
    with pytest.raises(Exception, match="neither written nor committed"):
        manifest.mapInArrow(warc._commit(root, f"{root}/_work-gone"), "bytes bigint").collect()


def test_long_and_empty_archives(spark, tmp_path):
    long = "".join(random.Random(1).choices("abcdefgh <>", k=3_000_000))
    got = warc.query(spark.createDataFrame([(1, "u", long, "", "", ""), (2, "u", None, "", "", "")], PAGES)).collect()
    assert {(r.page_id, r.payload_bytes, r.payload_digest) for r in got} == {(1, 3_000_000, warc.digest_py(long.encode())), (2, 0, warc.digest_py(b""))}
    assert warc.query(spark.createDataFrame([], PAGES)).collect() == []


# ---- runs


def _brute(words, least=6, periods=4):
    n, runs = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j + q - i >= max(least, periods * q):
                    runs.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in runs.items()), key=lambda r: (r[0], r[2]))


def _left(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 5, 8])]
        words = [rng.choice(letters) for _ in range(rng.choice([0, 3, 6, 10, 30, 80, 200]))]
        for _ in range(rng.choice([0, 1, 2])):
            at = rng.randrange(len(words) + 1)
            block = words[at : at + rng.randint(1, 40)] or ["x"]
            words[at:at] = block * rng.randint(2, 12)
        yield words


@pytest.mark.parametrize("least,periods", [(6, 4), (1, 4), (9, 5), (30, 4)])
def test_runs_against_brute_force(least, periods):
    texts = list(_texts(least * periods, 400))
    got = periodic.runs_of([" ".join(t).encode() for t in texts], [None] * len(texts), None, least, periods)
    for words, (runs, left) in zip(texts, got, strict=True):
        want = _brute(words, least, periods)
        assert runs == want and left.decode() == _left(words, want)


def test_nested_runs_and_long_ones():
    inner = ["a"] * 7 + ["b"]
    cases = [inner * 5, (inner * 4 + ["c"]) * 4, ["a"] * 3000, (["x", "y"] * 400 + ["x"]) * 5, [str(i) for i in range(300)] * 4 + ["0"]]
    got = periodic.runs_of([" ".join(t).encode() for t in cases], [None] * len(cases))
    assert [r for r, _ in got] == [_brute(t) for t in cases]
    with pytest.raises(ValueError, match="four periods"):
        periodic.runs_of([b"a a a a a a"], [None], None, 4, 2)


def test_mask_keeps_every_run():
    assert periodic.least_overlap() == 5 and periodic.least_overlap(9, 5) == 8 and periodic.least_overlap(1, 4) == 3
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 9, 8, 7, 1, 2, 3, 1, 2])
    mask = periodic.repeated(words, np.zeros(len(words), dtype=np.int64), 5)
    assert mask.tolist() == [True] * 12 + [False] * 3 + [True] * 5
    # the second document holds the k-gram once: it is no repeat
    assert not periodic.repeated(words, np.array([0] * 6 + [1] * 14), 5)[:6].any()


def test_runs_query_against_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in entry.op13_periodic_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    seen = 0
    for d in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", d.text or "") if w]
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = _brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best) and r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(_left(words, runs).encode()).hexdigest()
        seen += bool(runs)
    assert seen > 5


def test_run_edges(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000)) + " " + "la " * 20_000
    rows = [(1, None, "a", "b", "c"), (2, "", "a", "b", "c"), (3, " \t\n", "a", "b", "c"), (None, "a a a a a a", "a", "b", "c"), (5, "A a " * 9, None, None, None), (5, "A a " * 9, None, None, None), (7, long, "", "", "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed string, id string")
    got = {(r.doc_id, i): r for i, r in enumerate(periodic.collapse(frame).collect())}
    found = sorted(((k[0] or 0), [tuple(x) for x in r.runs], r.collapsed) for k, r in got.items() if k[0] != 7)
    assert found == [(0, [(0, 6, 1)], "a"), (1, [], ""), (2, [], ""), (3, [], ""), (5, [(0, 18, 2)], "A a"), (5, [(0, 18, 2)], "A a")]
    assert [tuple(x) for r in got.values() if r.doc_id == 7 for x in r.runs] == [(0, 60_000, 5000), (60_000, 20_000, 1)]
    assert periodic.query(frame.limit(0)).collect() == []
    none = {r.doc_id: r for r in periodic.query(frame).collect()}[1]
    assert none.n_runs == 0 and none.start is None and none.collapsed_sha256 == hashlib.sha256(b"").hexdigest()
