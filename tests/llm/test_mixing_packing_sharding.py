import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.llm import entry, mixing, packing, sharding
from tests.oracle import compare


@pytest.mark.parametrize("name", ["op2_source_mixing", "op5_packing", "op7_shard_placement"])
def test_matches_sql(spark, sf_dir, name):
    compare(spark, sf_dir, entry.queries()[name], entry.oracle_sql()[name])


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.text(min_size=1, max_size=3), st.tuples(st.floats(0.001, 1000), st.integers(1, 60)), min_size=1, max_size=12))
def test_schedule_stays_within_one_block_of_the_weights(given_):
    weights, blocks = {s: w for s, (w, _) in given_.items()}, {s: n for s, (_, n) in given_.items()}
    slots = mixing.schedule(weights, blocks)
    assert {s: len(x) for s, x in slots.items()} == blocks
    at = {slot: s for s, found in slots.items() for slot in found}
    assert sorted(at) == list(range(sum(blocks.values())))
    done, since, base, live = dict.fromkeys(blocks, 0), 0, dict.fromkeys(blocks, 0), set(blocks)
    for slot in sorted(at):
        done[at[slot]] += 1
        total = sum(weights[s] for s in live)
        for s in live:
            assert abs(done[s] - base[s] - (slot + 1 - since) * weights[s] / total) < 1 + 1e-9
        if done[at[slot]] == blocks[at[slot]]:
            live, since, base = live - {at[slot]}, slot + 1, dict(done)


def test_many_small_sources_do_not_take_a_large_ones_share():
    weights = {"big": 0.5, **{f"s{i}": 0.001 for i in range(500)}}
    slots = mixing.schedule(weights, {"big": 2000, **{f"s{i}": 4 for i in range(500)}})
    assert abs(sum(x < 1000 for x in slots["big"]) - 500) < 1


def test_many_sources(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 1500).alias("source"))
    got = mixing.mix(docs, block_rows=1)
    assert got.count() == 3000 and got.select("slot").distinct().count() == 3000
    fewer = mixing.mix(docs, max_blocks=1500)
    assert fewer.agg(F.max("slot")).first()[0] == 1499 and fewer.select("slot", "slot_row").distinct().count() == 3000


def test_mix_keeps_every_row(spark):
    rows = [(i, f"t{i}", None if i % 7 == 0 else "hot" if i % 3 else "b", "x", i) for i in range(500)] + [(3, "again", "b", "x", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, slot string, rank long").withColumns({"_source": F.lit("u"), "_rank": F.lit(1), "_at": F.lit(2)})
    got = mixing.mix(docs, block_rows=4)
    assert got.columns == ["doc_id", "text", "source", "rank", "_source", "_rank", "_at", "slot", "slot_row"] and got.count() == len(rows)
    assert got.select("slot", "slot_row").distinct().count() == len(rows)
    laid = mixing.interleave(docs)
    assert laid.columns == docs.columns and sorted((x.text or "", x.slot or "") for x in laid.collect()) == sorted((r[1] or "", r[3] or "") for r in rows)
    assert mixing.mix(docs.where("false")).count() == 0


def test_interleave_writes_the_schedule(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(400)], "doc_id long, source string")
    mixing.interleave(docs, weights={"a": 1, "b": 1}, block_rows=2).coalesce(1).write.parquet(str(tmp_path / "m"))
    order = [r.source for r in spark.read.parquet(str(tmp_path / "m")).collect()]
    assert order[:12] == ["a", "a", "b", "b"] * 3 and order[-1] == "a"


def test_weights_must_be_there(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": 1.0})
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": 1.0, "b": 0.0})
    assert mixing.mix(docs, weights={"a": 1.0, "b": 2.0, "c": 3.0}).count() == 2


def padding(cells, ends):
    return sum(n * (min(e for e in ends if e >= c) - c) for c, n in cells)


def test_boundaries_are_optimal():
    rng = random.Random(4)
    for _ in range(40):
        sizes = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        cells = [(c, rng.randint(1, 9)) for c in sizes]
        for k in (1, 2, 3, 5):
            ends = packing.boundaries(cells, k)
            best = min(padding(cells, (*c, sizes[-1])) for c in itertools.combinations(sizes[:-1], min(k, len(sizes)) - 1))
            assert len(ends) == min(k, len(sizes)) and padding(cells, ends) == best


def test_pack(spark):
    rows = [(i, "w " * (i % 50), "e") for i in range(300)] + [(5, None, "e"), (5, None, "e"), (None, "w " * 90, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    got = packing.pack(docs, buckets=4, budget=100).collect()
    assert len(got) == len(rows)
    for _, batch in itertools.groupby(sorted(got, key=lambda r: (r.bucket, r.batch, r.batch_row)), key=lambda r: (r.bucket, r.batch)):
        batch = list(batch)
        assert [r.batch_row for r in batch] == list(range(len(batch)))
        assert len(batch) * batch[0].bucket <= 100 or len(batch) == 1
        assert all(r.n_tokens <= r.bucket for r in batch)
    assert packing.pack(docs.where("false")).count() == 0


def boundaries_by_hand(cells, buckets):
    """Every (i, j) of the dynamic program."""
    z, n = np.array(cells).T
    r, t = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(z * n)])
    best, ends = np.concatenate([[0], z * r[1:] - t[1:]]).tolist(), [[], *([int(c)] for c in z)]
    for used in range(1, min(buckets, len(z))):
        rows = [(None, None)] * (used + 1)
        for j in range(used + 1, len(z) + 1):
            cost = np.array(best[used:j]) + z[j - 1] * (r[j] - r[used:j]) - (t[j] - t[used:j])
            i = used + int(np.argmin(cost))
            rows.append((int(cost[i - used]), [*ends[i], int(z[j - 1])]))
        best, ends = [x[0] for x in rows], [x[1] for x in rows]
    return ends[-1]


def test_boundaries_against_every_pair():
    rng = random.Random(9)
    for top, m in ((60, 25), (60, 40), (400, 90), (10**6, 300)):
        for _ in range(8):
            cells = [(c, rng.choice((1, 1, 2, 50, 10**6))) for c in sorted(rng.sample(range(1, top), m))]
            for k in (1, 2, 3, 8):
                assert packing.boundaries(cells, k) == boundaries_by_hand(cells, k)


def test_one_long_text_does_not_coarsen_the_others(spark):
    """More than 4,096 distinct lengths, one of them far off: the padding is still the least."""
    docs = spark.range(4300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.when(F.col("id") == 4299, 200_000).otherwise(F.col("id") % 4200).cast("int")).alias("text"))
    docs = docs.unionByName(spark.range(9000).select((F.col("id") + 5000).alias("doc_id"), F.lit("one two").alias("text")))
    got = packing.pack(docs, carry=["doc_id"], buckets=3).groupBy("n_tokens", "bucket").count().collect()
    cells = sorted((r["n_tokens"], r["count"]) for r in got)
    assert len(cells) == 4201 and sorted({r["bucket"] for r in got}) == boundaries_by_hand(cells, 3)


def test_coarse_histogram(spark):
    lengths = spark.range(1000).select((F.col("id") * 3 + 1).alias("length"))
    step, cells = packing.length_cells(lengths, 100)
    assert step == 32 and sum(n for _, n in cells) == 1000 and all(c % 32 == 0 for c, _ in cells) and cells[-1][0] >= 2998


def fill_by_hand(names, size):
    prefs = []
    for n in names:
        at, skip = sharding._hash(n, "offset") % size, sharding._hash(n, "skip") % (size - 1) + 1
        prefs.append([(at + i * skip) % size for i in range(size)])
    owner, turns = {}, [iter(p) for p in prefs]
    while len(owner) < size:
        for shard, it in enumerate(turns):
            slot = next((s for s in it if s not in owner), None)
            if slot is not None:
                owner[slot] = shard
    return [owner[s] for s in range(size)]


def test_table_against_brute_force():
    for n, size in ((1, 2), (3, 7), (5, 101), (10, 211)):
        names = [f"s{i}" for i in range(n)]
        table = sharding.fill_table(names, size)
        assert table == fill_by_hand(names, size)
        shares = [table.count(i) for i in range(n)]
        assert max(shares) - min(shares) <= 1


def test_losing_a_shard_moves_little():
    names = [f"s{i}" for i in range(20)]
    a, b = sharding.fill_table(names, 2003), sharding.fill_table(names[:-1], 2003)
    assert sum(x != y for x, y in zip(a, b, strict=True) if x != 19) < 0.15 * 2003


def test_place(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "doc_id long, shard string")
    got = sharding.place(docs, "doc_id", 8, 101)
    assert got.columns == ["doc_id", "shard"] and got.count() == 3
    assert len({r.shard for r in got.where("doc_id = 1").collect()}) == 1
    assert sharding.place(docs.where("false"), "doc_id", 8, 101).count() == 0
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 100)


def test_write_sharded(spark, tmp_path):
    docs = spark.range(500).select(F.lit(7).alias("k"), F.col("id"))
    sharding.write_sharded(docs, str(tmp_path / "s"), "k", shards=4, files_per_shard=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 500 and [r.shard for r in back.select("shard").distinct().collect()] == [r.shard for r in sharding.place(docs, "k", 4).select("shard").distinct().collect()]
    assert len(list((tmp_path / "s").glob("shard=*/part-*.parquet"))) > 1


def test_pack_in_a_given_order(spark):
    docs = spark.createDataFrame([(i, "w " * 9, 100 - i) for i in range(50)], "doc_id long, text string, place int")
    got = packing.pack(docs, budget=100, order=["place"]).orderBy("batch", "batch_row").collect()
    assert [r.doc_id for r in got] == list(range(49, -1, -1)) and {r.bucket for r in got} == {10}
