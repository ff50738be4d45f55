"""An insert-or-ignore target that is cut by a hash of its key, so that a batch reads only what it may touch.

A batch's rows are written to data/batch=<id>/bucket=<b>, and count from the
moment that the file commits/<id>.json exists; it is made by a rename. A batch
that is replayed finds its commit and adds nothing, rows with a null key
included; what a failed attempt has left is removed by the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators.ingest import insert_ignore
from loomspan.plans import files
from loomspan.plans.scratch import Scratch
from loomspan.schemas import TABLES

#: Bits of the filter for each key of a batch; with one hash one absent key in so many passes. And the most bits that are broadcast.
BITS_A_KEY, MOST_BITS = 16, 1 << 28
#: Bits that one row of a bitmap holds, as Spark's bitmap functions lay them out.
BITMAP = 32_768
#: The bucket of rows with a null in their key: they are like no others and never looked up.
NO_KEY = -1


def key_filter(keys: DataFrame, names: list[str], count: int) -> tuple[DataFrame, int]:
    """(bitmap rows (part, bits), number of bits) of a Bloom filter with one hash over the keys."""
    bits = 1 << max(15, min(MOST_BITS, max(1, count) * BITS_A_KEY).bit_length())
    place = F.pmod(F.xxhash64(*names), F.lit(min(bits, MOST_BITS))) + 1
    rows = keys.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    return rows.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")), min(bits, MOST_BITS)


def may_hold(rows: DataFrame, names: list[str], filter_rows: DataFrame, bits: int) -> DataFrame:
    """The rows whose key the filter may hold: all that it does, and few others."""
    place = F.pmod(F.xxhash64(*names), F.lit(bits)) + 1
    joined = rows.withColumns({"_part": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)}).join(F.broadcast(filter_rows), F.col("_part") == F.col("part"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return joined.where(F.get(F.array(*[byte.bitwiseAND(F.lit(1 << i)) for i in range(8)]), (F.col("_bit") % 8).cast("int")) != 0).select(*rows.columns)


class BucketedTable:
    """Rows of one of the engine's tables under a path, each key once."""

    def __init__(self, spark: SparkSession, path: str, table: str, buckets: int = 64):
        self.spark, self.path, self.spec, self.buckets = spark, path.rstrip("/"), TABLES[table], buckets

    def commits(self) -> dict[str, dict]:
        """The committed batches by id, as their commit files describe them."""
        found = [n for n in files.names(self.spark, f"{self.path}/commits") if n.endswith(".json")]
        return {n.removesuffix(".json"): json.loads(files.read_text(self.spark, f"{self.path}/commits/{n}")) for n in found}

    def _folders(self, buckets: set[int] | None = None) -> list[str]:
        """The folders with committed rows, of these buckets alone if given; those that a compaction replaced are left out."""
        commits = self.commits()
        old = {x for c in commits.values() for x in c.get("replaces", [])}
        return [f"{self.path}/data/batch={name}/bucket={b}" for name, c in commits.items() if name not in old for b in c["buckets"] if buckets is None or b in buckets]

    def read(self, schema, buckets: set[int] | None = None) -> DataFrame:
        """The committed rows with the given schema; of some buckets alone if they are named."""
        folders = self._folders(buckets)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _bucket(self) -> Column:
        keys = [F.col(c) for c in self.spec.keys]
        present = reduce(lambda a, b: a & b, [c.isNotNull() for c in keys])
        return F.when(present, F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets))).otherwise(F.lit(NO_KEY)).cast("int")

    def insert(self, batch: DataFrame, batch_id: int | str, arrival: str) -> int:
        """Add the rows that the table lacks, first by arrival of each key; returns how many, 0 for a batch that was committed before.

        Of the target the keys in the batch's buckets are read, and of them those
        that may be in the batch go into the join.
        """
        name = str(batch_id)
        if files.exists(self.spark, f"{self.path}/commits/{name}.json"):
            return 0
        files.delete(self.spark, f"{self.path}/data/batch={name}")
        scratch, keys = Scratch(self.spark, "bucketed"), list(self.spec.keys)
        new = scratch.keep(insert_ignore(batch, keys, list(self.spec.required), arrival).withColumn("bucket", self._bucket()))
        touched = {r.bucket: r.n for r in new.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        looked_up = {b for b in touched if b != NO_KEY}
        added = new
        if looked_up and self._folders(looked_up):
            added = new.join(self.present(new.where(F.col("bucket") != NO_KEY), looked_up, sum(touched.values())), keys, "left_anti")
        added.repartition("bucket").sortWithinPartitions("bucket", *keys).write.partitionBy("bucket").parquet(f"{self.path}/data/batch={name}")
        return self._commit(name, {})

    def present(self, new: DataFrame, buckets: set[int], count: int) -> DataFrame:
        """The keys of these buckets that the table has and the new rows may have."""
        keys = list(self.spec.keys)
        held = self.read(new.select(*keys).schema, buckets)
        rows, bits = key_filter(new, keys, count)
        return may_hold(held, keys, rows, bits)

    def _commit(self, name: str, more: dict) -> int:
        folder = f"{self.path}/data/batch={name}"
        buckets = [int(x.removeprefix("bucket=")) for x in files.names(self.spark, folder) if x.startswith("bucket=")]
        rows = self.spark.read.parquet(folder).count() if buckets else 0
        files.write_text(self.spark, f"{self.path}/commits/{name}.json", json.dumps({"buckets": buckets, "rows": rows} | more))
        return rows

    def compact(self) -> str:
        """Write the committed rows together, a folder a bucket; returns the new batch's name.

        The replaced batches stay known by their commits, so their replay still
        adds nothing; their files go once the new commit is there.
        """
        commits = self.commits()
        old = sorted(set(commits) - {x for c in commits.values() for x in c.get("replaces", [])})
        name = f"all-{uuid.uuid4().hex}"
        folders = self._folders()
        if folders:
            rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("batch")
            rows.repartition("bucket").sortWithinPartitions("bucket", *self.spec.keys).write.partitionBy("bucket").parquet(f"{self.path}/data/batch={name}")
        self._commit(name, {"replaces": old})
        for x in old:
            files.delete(self.spark, f"{self.path}/data/batch={x}")
        return name


def insert_ignore_batches(path: str, table: str, arrival: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: insert each micro-batch once into the bucketed table at path."""

    def run(batch: DataFrame, batch_id: int) -> None:
        BucketedTable(batch.sparkSession, path, table, buckets).insert(batch, batch_id, arrival)

    return run
