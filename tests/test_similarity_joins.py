"""Similarity joins, pair counts and listings against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.operators import resolve, simjoin


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], (before + 1 if x == y else max(row[j], row[j - 1]))
    return row[-1]


def _alike(texts, percent):
    return {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if texts[i] and texts[j] and 200 * _lcs(texts[i], texts[j]) >= percent * (len(texts[i]) + len(texts[j]))}


def _texts(seed, many):
    """Texts of all lengths with near copies; half of them hold the same long phrase."""
    rng, out = random.Random(seed), []
    for _ in range(many):
        base = rng.choice(["", "international holdings of "]) + "".join(rng.choice("abcdefgh é") for _ in range(rng.choice([2, 30, 60, 90])))
        out.append(base)
        for _ in range(3):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(text) + 1)
                if rng.random() < 0.5 and at < len(text):
                    del text[at]
                else:
                    text.insert(at, rng.choice("abcxyz"))
            out.append("".join(text))
    return out


@pytest.mark.parametrize("percent,frequent", [(98, 64), (98, 1), (90, 2), (100, 1)])
def test_segment_join_loses_no_pair(spark, percent, frequent):
    texts = _texts(percent + frequent, 35)
    rows = spark.createDataFrame([*enumerate(texts), (None, "abc"), (990, None), (991, "")], "id long, text string")
    got = simjoin.segment_join(rows, percent, frequent).collect()
    assert {(r.a, r.b) for r in got} == _alike(texts, percent) and len(got) == len({(r.a, r.b) for r in got})
    assert all(r.text_a == texts[r.a] and r.text_b == texts[r.b] for r in got)


def test_segment_join_does_not_compare_all_names_with_one_word(spark):
    """100,000 long names share words; only planted pairs differ in one character. No operator makes rows by the square of a group."""
    n = 100_000
    base = spark.range(n).select("id", F.concat(F.md5(F.col("id").cast("string").cast("binary")), F.lit(" international holdings "), F.md5((F.col("id") + n).cast("string").cast("binary"))).alias("text"))
    near = base.where("id % 1000 = 0").select((F.col("id") + n).alias("id"), F.concat("text", F.lit("x")).alias("text"))
    got = simjoin.segment_join(base.unionByName(near), 98).select("a", "b").collect()
    assert {(r.a, r.b) for r in got} == {(i, i + n) for i in range(0, n, 1000)}
    with pytest.raises(ValueError, match="90 to 100"):
        simjoin.segment_join(base, 75)


def test_bags_never_exceed_the_distance(spark):
    texts = _texts(4, 12)
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("bag", simjoin.bag(F.col("text")))
    a, b = (rows.select(*[F.col(c).alias(f"{c}_{x}") for c in rows.columns]) for x in "ab")
    pairs = a.join(b, F.col("id_a") < F.col("id_b")).select("id_a", "id_b", simjoin.bags_apart(F.col("bag_a"), F.col("bag_b")).alias("apart")).collect()
    assert any(r.apart > 20 for r in pairs)
    assert all(r.apart <= len(texts[r.id_a]) + len(texts[r.id_b]) - 2 * _lcs(texts[r.id_a], texts[r.id_b]) for r in pairs)


def test_bags_of_any_character(spark):
    """Every class is filled and wraps, the highest included."""
    letters = [chr(i) for i in range(32, 127)] + ["é", "語"]
    rows = spark.createDataFrame([(c, n) for c in letters for n in (1, 8, 15, 16, 40)], "c string, n int").withColumn("bag", simjoin.bag(F.expr("repeat(c, n)")))
    got = rows.withColumn("k", F.pmod(F.xxhash64("c"), F.lit(16)).cast("int")).collect()
    assert {r.k for r in got} >= {0, 15} and all((r.bag >> 4 * r.k) & 15 == r.n % 16 and r.bag & ~(15 << 4 * r.k) & ((1 << 64) - 1) == 0 for r in got)


def test_common_subsequences_in_bits():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcé ") for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 130, 200)]
    held = simjoin.Alphabet(texts)
    for text in [*texts, "zzz", "a" * 300]:
        assert held.common(text, np.arange(len(texts))).tolist() == [_lcs(text, t) for t in texts]


@pytest.mark.parametrize("tile", [1024, 30])
def test_block_join_loses_no_pair(spark, tile):
    texts = _texts(9, 30)
    blocks = [(i, w) for i, t in enumerate(texts) for w in sorted(set(t.split()))]
    of = {}
    for i, w in blocks:
        of.setdefault(i, set()).add(w)
    rows = spark.createDataFrame([*enumerate(texts), (None, "abc"), (990, None)], "id long, text string")
    got = simjoin.block_join(rows, spark.createDataFrame([*blocks, (None, "holdings"), (990, "holdings"), (3, None)], "id long, block string"), 75, tile).collect()
    want = {(i, j) for i, j in _alike(texts, 75) if of.get(i, set()) & of.get(j, set())}
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want) > 50


def _entities(spark, rows):
    from loomspan.functions import names

    frame = spark.createDataFrame(rows, "entity_id long, clean_name string")
    return frame.withColumn("match_key", names.match_key(F.col("clean_name")))


def test_fuzzy_links_need_a_block_and_different_keys(spark):
    word = "abcdefghij" * 6
    rows = [(1, f"{word} one"), (2, f"{word}x one"), (3, "é" * 60), (4, "é" * 61), (5, f"{word} ONE"), (6, "ab " * 25 + "cd"), (7, "ab " * 25 + "ce")]
    got = {(r.a, r.b) for r in resolve.fuzzy_links(_entities(spark, rows)).collect()}
    # 3 and 4 have no ASCII letter and so no block; 1 and 5 have one key; 6 and 7 share nothing but a prefix
    assert got == {(1, 2), (6, 7)}
    assert (6, 7) not in {(r.a, r.b) for r in resolve.fuzzy_links(_entities(spark, rows), max_prefix=1).collect()}


def test_borderline_pairs_against_all_pairs(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "labs", "data", "cloud", "works"]
    rows = [(i, " ".join(rng.sample(words, rng.randint(1, 4))) + rng.choice(["", "s", "x1"])) for i in range(60)]
    entities = _entities(spark, rows)
    got = {(r.clean_a, r.clean_b, round(r.token_sort, 6)) for r in resolve.borderline_pairs(entities).collect()}
    first = {}
    for i, name in rows:
        first.setdefault(name, i)
    want = set()
    for a, b in itertools.combinations(sorted(first, key=first.get), 2):
        x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
        score = 200 * _lcs(x, y) / (len(x) + len(y))
        share = {w for w in a.split() if len(w) > 2} & {w for w in b.split() if len(w) > 2} or a.replace(" ", "")[:3] == b.replace(" ", "")[:3]
        if 75 <= score < 98 and share and a.replace(" ", "") != b.replace(" ", ""):
            want.add((a, b, round(score, 6)))
    assert got == want and len(got) > 20
    plan = resolve.borderline_pairs(entities)._jdf.queryExecution().optimizedPlan().toString()
    assert "block_key" not in plan


@pytest.mark.parametrize("frequent,most", [(1000, 12), (5, 12), (5, 2), (0, 0), (20, 3)])
def test_pairs_are_counted_without_being_made(spark, frequent, most):
    rng = random.Random(frequent + most)
    rows = [(i, f"k{k}") for i in range(120) for k in rng.sample(range(25), rng.choice([0, 1, 1, 3, 6]))]
    rows += [(i + 500, f"k{k}") for i, k in rows if i < 20]  # the same blocks again
    members = {}
    for i, k in rows:
        members.setdefault(k, []).append(i)
    want = len({p for m in members.values() for p in itertools.combinations(sorted(m), 2)})
    got = resolve.pair_count(spark.createDataFrame([(k, i) for i, k in rows], "block_key string, entity_id long"), frequent, most)
    assert got.collect()[0].pairs == want
    assert resolve.pair_count(spark.createDataFrame([], "block_key string, entity_id long")).collect()[0].pairs == 0


def test_long_listings_are_put_together_from_runs(spark, monkeypatch):
    monkeypatch.setattr(resolve, "RUN", 3)
    rows = [("one", f"name {i % 7}") for i in range(20)] + [("two", "b"), ("two", "a"), ("three", "alone")]
    got = resolve.variant_clusters(spark.createDataFrame(rows, "canonical_name string, raw_name string")).collect()
    assert [(r.canonical_name, r.variant_count, r.variants) for r in got] == [("one", 20, " | ".join(sorted(x for c, x in rows if c == "one"))), ("two", 2, "a | b")]
    assert resolve.variant_clusters(spark.createDataFrame(rows, "canonical_name string, raw_name string"), 1).count() == 1
