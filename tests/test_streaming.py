"""First-seen state and the bucketed insert-or-ignore target: restarts, replays, hot keys, and what is read."""

import datetime as dt
import os

from pyspark.sql import functions as F

from loomspan.plans import files
from loomspan.streaming import bucketed
from loomspan.streaming import ingest as streams

SCHEMA = "url string, at timestamp, n int"


def _time(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, folder, out, state):
    stream = streams.stream_first_seen(spark.readStream.schema(SCHEMA).parquet(folder), "url", "at")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return sorted((r.url, r.first_seen_at) for r in spark.read.parquet(out).collect())


def test_first_seen_state_survives_a_restart(spark, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    _arrive(spark, folder, [("a", _time(5), 1), ("a", _time(3), 2), ("b", _time(4), 3), (None, _time(1), 4), ("c", None, 5)])
    first = [("a", _time(3)), ("b", _time(4))]
    assert _run(spark, folder, out, state) == first
    # a second run goes on from the checkpoint: earlier times of a known URL change nothing, c is seen now
    _arrive(spark, folder, [("a", _time(1), 6), ("c", _time(9), 7), ("c", _time(8), 8)])
    assert _run(spark, folder, out, state) == [*first, ("c", _time(8))]
    assert _run(spark, folder, out, state) == [*first, ("c", _time(8))]


def test_a_hot_url_is_folded_before_the_state(spark, monkeypatch):
    monkeypatch.setattr(streams, "HELD_ROWS", 64)
    import pyarrow as pa

    batches = [pa.record_batch({"url": ["hot" if i % 2 else f"u{b}-{i}" for i in range(50)], "seen_at": pa.array([b * 100 + i for i in range(50)], pa.timestamp("us", "UTC"))}) for b in range(40)]
    out = pa.Table.from_batches(list(streams._least_times(iter(batches))))
    rows = list(zip(out.column("url").to_pylist(), out.column("seen_at").cast(pa.int64()).to_pylist(), strict=True))
    assert min(t for u, t in rows if u == "hot") == 1 and sum(u == "hot" for u, _ in rows) < 40
    assert {u for u, _ in rows} == {u for b in batches for u in b.column("url").to_pylist()}
    assert list(streams._least_times(iter([]))) == []


def _insert(spark, table, batch, rows):
    return table.insert(spark.createDataFrame(rows, "source_url string, startup_name string, at int, schema_version string, record_type string, collected_at string"), batch, "at")


def _row(url, name, at):
    return (url, name, at, "1.0", "PRODUCT", "now")


def test_each_key_and_each_batch_once(spark, tmp_path):
    table = bucketed.BucketedTable(spark, str(tmp_path / "t"), "products", 8)
    first = [_row("u1", "n", 2), _row("u1", "n", 1), _row("u2", "n", 3), _row("u3", None, 4), _row("u3", None, 5), _row(None, "x", 6)]
    assert _insert(spark, table, 0, first) == 4  # u3 twice: a null in the key makes rows different; the row without a required URL goes
    assert _insert(spark, table, 0, first) == 0
    assert _insert(spark, table, 1, [_row("u1", "n", 0), _row("u4", "n", 9), _row("u3", None, 4)]) == 2
    schema = "source_url string, startup_name string, at int"
    want = [("u1", "n", 1), ("u2", "n", 3), ("u3", None, 4), ("u3", None, 4), ("u3", None, 5), ("u4", "n", 9)]

    def rows(t):
        return sorted((r.source_url, r.startup_name, r.at) for r in t.read(schema).collect())

    assert rows(table) == sorted(want, key=lambda r: (r[0], r[2]))
    table.compact()
    assert rows(table) == sorted(want, key=lambda r: (r[0], r[2]))
    # after a compaction old batches are still known, and new ones find the keys
    assert _insert(spark, table, 1, [_row("u9", "n", 1)]) == 0
    assert _insert(spark, table, 2, [_row("u2", "n", 1), _row("u9", "n", 1)]) == 1
    assert sorted(x for x in os.listdir(tmp_path / "t/data") if not x.startswith(".")) == sorted(f"batch={n}" for n in [*[x for x in table.commits() if x.startswith("all-")], "2"])


def test_a_failed_attempt_leaves_nothing(spark, tmp_path):
    table = bucketed.BucketedTable(spark, str(tmp_path / "t"), "seen_urls", 4)
    rows = spark.createDataFrame([("a", _time(1)), ("b", _time(2))], "url string, first_seen_at timestamp")
    # rows written without a commit, as by a driver that was lost before it
    rows.withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{tmp_path}/t/data/batch=0")
    assert table.read(rows.schema).count() == 0
    assert table.insert(rows, 0, "first_seen_at") == 2 and table.read(rows.schema).count() == 2
    assert table.insert(rows.limit(0), 1, "first_seen_at") == 0 and "1" in table.commits()


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = bucketed.BucketedTable(spark, str(tmp_path / "t"), "seen_urls", 32)
    many = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("url"), F.timestamp_seconds("id").alias("first_seen_at"))
    assert table.insert(many, 0, "first_seen_at") == 2000
    new = many.where("url in ('u5', 'u77')").withColumn("bucket", table._bucket())
    buckets = {r.bucket for r in new.collect()}
    found = table.present(new, buckets, 2)
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}
    assert read == {str(b) for b in buckets} and len(read) <= 2
    assert {r.url for r in found.collect()} >= {"u5", "u77"} and found.count() < 40


def test_key_filter_misses_no_key(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    rows, bits = bucketed.key_filter(keys, ["a", "b"], 3000)
    assert bucketed.may_hold(keys, ["a", "b"], rows, bits).count() == 3000
    others = spark.range(3000, 23_000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    assert bucketed.may_hold(others, ["a", "b"], rows, bits).count() < 2000


def test_files_are_there_whole_or_not(spark, tmp_path):
    path = f"{tmp_path}/x/y.json"
    assert not files.exists(spark, path) and files.names(spark, f"{tmp_path}/x") == []
    assert files.write_text(spark, path, "grüße") and not files.write_text(spark, path, "other")
    assert files.read_text(spark, path) == "grüße" and [n for n in files.names(spark, f"{tmp_path}/x") if not n.startswith(".")] == ["y.json"]
