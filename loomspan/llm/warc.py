"""A deterministic sharded writer of WARC archives, and their reader.

Records are put in the order of a key (id, then payload digest). The same rows
give the same files, byte for byte, however Spark deals them: shards are cut
where the payload bytes before a record pass a multiple of the shard size, found
exactly from a table of keys and sizes; a shard is sorted and written by one
task, which begins a new file when the compressed one is large enough.

A task writes files under names of its own attempt and returns a manifest row
for each. Only rows of attempts that Spark accepts reach the manifest; its files
are renamed by a second job, which can run again after any failure, and the
manifest itself is renamed last. A folder without a manifest holds no archive,
and readers open only what the manifest names.

Each record is a gzip member of its own, with headers and digests made anew from
its payload. Of equal payloads one record is a response; the others are revisits
that refer to it and hold no payload.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomspan.plans.ranks import ROW_BITS
from loomspan.plans.scratch import Scratch

#: Payload bytes of a shard: a 64th of all, between these bounds, unless the caller sets it.
LEAST_SHARD, MOST_SHARD, SHARDS = 1 << 20, 256 << 20, 64
#: Compressed bytes from which a file is closed.
ROLL_BYTES = 64 << 20
# The base32 alphabet, and the digits that conv() gives in base 32.
BASE32, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# Fixed value: the profile of revisits found by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, file string, written string, records bigint, bytes bigint, sha1 string"
READ = "file string, record_type string, record_id string, target_uri string, id bigint, refers_to bigint, payload_bytes bigint, payload_digest string, declared_digest string, payload binary"


def digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32, as in archive headers: 40 hex digits in fives give 32 characters in fours."""
    hexes = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(hexes, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*fours), DIGITS, BASE32)


def digest_py(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def sort_key(id: Column, payload_digest: Column) -> Column:
    """A text that sorts as (id, digest): null ids, then negative ones, then the others."""
    sign = F.when(id.isNull(), "0").when(id < 0, "1").otherwise("2")
    return F.concat(sign, F.lpad(F.hex(F.coalesce(id, F.lit(0))), 16, "0"), payload_digest)


def keyed(records: DataFrame, id: str, uri: str, payload: str) -> DataFrame:
    """(key, id, uri, payload, digest, size) of the records; a null payload is empty, texts are taken as UTF-8."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = records.select(F.col(id).cast("long").alias("id"), F.col(uri).cast("string").alias("uri"), body.alias("payload")).withColumn("digest", digest(F.col("payload")))
    return rows.select(sort_key(F.col("id"), F.col("digest")).alias("key"), "id", "uri", "payload", "digest", F.octet_length("payload").cast("long").alias("size"))


def revisits(keys: DataFrame, least: int) -> DataFrame:
    """(key, refers_to): for the payloads of at least so many bytes that occur more than once, each record's key and the largest id among them.

    Rows without an id take no part. Only digests that repeat are joined, without payloads.
    """
    known = keys.where(F.col("id").isNotNull() & (F.col("size") >= least))
    repeated = known.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("digest", "refers_to")
    return known.select("key", "digest").join(repeated, "digest").groupBy("key").agg(F.max("refers_to").alias("refers_to"))


def shard_cuts(keys: DataFrame, scratch: Scratch, shard_bytes: int | None) -> list[str]:
    """The first key of every shard but the first, in order.

    A record's shard is the number of whole shard sizes that lie before its key;
    records of one key stay together. The list has a key for each shard, so its
    length is bounded by all bytes over the shard size.
    """
    sizes = keys.groupBy("key").agg(F.sum("size").alias("size"))
    count = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.keep(sizes.repartitionByRange(count, "key").sortWithinPartitions("key").withColumn("at", F.monotonically_increasing_id()))
    task = F.shiftright("at", ROW_BITS).alias("task")
    total = dealt.agg(F.sum("size")).first()[0] or 0
    span = shard_bytes or min(MOST_SHARD, max(LEAST_SHARD, total // SHARDS))
    # one row a task
    parts = dealt.groupBy(task).agg(F.sum("size").alias("size")).select("task", F.coalesce(F.sum("size").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    running = F.coalesce(F.sum("size").over(W.partitionBy("task").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.select("key", "size", "at", task).withColumn("before", running).join(F.broadcast(parts.select("task", "first")), "task")
    firsts = placed.groupBy(F.floor((F.col("first") + F.col("before")) / span).alias("shard")).agg(F.min("key").alias("key")).collect()
    scratch.drop(dealt)
    return sorted(r.key for r in firsts)[1:]


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it); ``file:/x`` and ``/x`` are local paths."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def _urn(*parts: object) -> str:
    """A record id that depends on the parts alone."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1('|'.join(map(str, parts)).encode()).digest()[:16], version=5)}>"


def _uri(uri: str | None, id: int | None) -> str:
    """The URI as a header can hold it: white space, controls, brackets and what is not ASCII are percent-encoded; a row without one is named by its id."""
    return quote(uri, safe="!#$%&'()*+,/:;=?@[]~-._") if uri else f"urn:row:{id}"


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record, compressed: a gzip member without a time in it."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("WARC-Block-Digest", f"sha1:{digest_py(block)}"), ("Content-Length", len(block))])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


class _Shard:
    """The files of one shard, written under names of this attempt."""

    def __init__(self, work: str, number: int, roll_bytes: int, date: str):
        self.work, self.number, self.roll, self.date = work, number, roll_bytes, date
        self.out, self.done = None, []

    def add(self, data: bytes) -> None:
        if self.out is None:
            name = f"part-{self.number:06d}-{len(self.done):04d}.warc.gz"
            self.row = {"shard": self.number, "file": name, "written": f"{uuid.uuid4().hex}-{name}", "records": 0, "bytes": 0}
            self.sha1 = hashlib.sha1()
            files, at = _place(f"{self.work}/{self.row['written']}")
            self.out = files.open_output_stream(at, compression=None)
            about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(name)), ("WARC-Date", self.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
            self._put(record(about, b"software: loomspan\r\nformat: WARC File Format 1.1\r\n"))
        self._put(data)
        self.row["records"] += 1
        if self.row["bytes"] >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.row["bytes"] += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append(self.row | {"sha1": self.sha1.hexdigest()})
            self.out = None


def _write_shards(work: str, roll_bytes: int, date: str):
    """For mapInArrow over rows sorted by (shard, key, marks first): manifest rows of the files written."""
    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("written", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())])

    def one(row: dict, refers_to: int | None, copy: int) -> bytes:
        payload, named = row["payload"], row["digest"]
        if digest_py(payload) != named:
            raise ValueError(f"the payload of row {row['id']} changed on its way")
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        again = refers_to is not None and (refers_to != row["id"] or copy > 0)
        headers: list[tuple[str, object]] = [
            ("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", _urn(row["key"], copy)), ("WARC-Date", date), ("WARC-Target-URI", _uri(row["uri"], row["id"])),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{named}"),
        ]
        if row["id"] is not None:
            headers.append(("X-Row-ID", row["id"]))
        if again:
            headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(key_of(refers_to, named), 0)), ("WARC-Refers-To-Date", date), ("X-Refers-To-Row-ID", refers_to)]
        return record(headers, http if again else http + payload)

    def run(batches):
        shard, key, refers_to, copy = None, None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if shard is None or row["shard"] != shard.number:
                    if shard is not None:
                        shard.close()
                        yield pa.RecordBatch.from_pylist(shard.done, schema)
                    shard = _Shard(work, row["shard"], roll_bytes, date)
                if row["key"] != key:
                    key, refers_to, copy = row["key"], None, 0
                if row["payload"] is None:
                    refers_to = row["refers_to"]
                    continue
                shard.add(one(row, refers_to, copy))
                copy += 1
        if shard is not None:
            shard.close()
            yield pa.RecordBatch.from_pylist(shard.done, schema)

    return run


def key_of(id: int, payload_digest: str) -> str:
    """sort_key of a row with an id."""
    return f"{'1' if id < 0 else '2'}{id & (1 << 64) - 1:016X}{payload_digest}"


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def _commit(root: str, work: str):
    """For mapInArrow over manifest rows: each file gets its final name. What an earlier attempt has renamed is left as it is."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, source = _place(f"{work}/{row['written']}")
                _, target = _place(f"{root}/{row['file']}")
                if files.get_file_info(source).type != pafs.FileType.NotFound:
                    files.move(source, target)
                elif files.get_file_info(target).size != row["bytes"]:
                    raise FileNotFoundError(f"{row['file']} was neither written nor committed")
            yield pa.RecordBatch.from_arrays([batch.column("bytes")], ["bytes"])

    return run


def write_archive(
    records: DataFrame, root: str, id: str = "page_id", uri: str = "url", payload: str = "html", date: str = "1970-01-01T00:00:00Z",
    least_revisit: int = 0, shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write a record for every row into the folder root, which holds no archive yet; returns the manifest.

    Of the rows with equal payloads of at least ``least_revisit`` bytes the one
    with the largest id is the response, the others revisit it; of rows that share
    that id too, the first by URI is. A null payload is empty. Rows without an id
    are responses and come first. Without rows there is a manifest and no file.
    Rows that share both id and payload are written by one task. Root is a path
    that Spark and pyarrow both know (local, HDFS, S3, GCS).
    """
    spark, root = records.sparkSession, root.rstrip("/")
    final, files = _hadoop(spark, f"{root}/manifest")
    if files.exists(final):
        raise ValueError(f"{root} holds an archive already")
    work = f"{root}/_work-{uuid.uuid4().hex}"
    files.mkdirs(_hadoop(spark, work)[0])
    scratch = Scratch(spark, "warc")
    rows = keyed(records, id, uri, payload)
    keys = scratch.keep(rows.select("key", "id", "digest", "size"))
    cuts = shard_cuts(keys, scratch, shard_bytes)
    marks = revisits(keys, least_revisit)

    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(cuts, k) for k in key], dtype="int32")

    none = F.lit(None)
    both = rows.select("key", "id", "uri", "payload", "digest", none.cast("bigint").alias("refers_to")).unionByName(
        marks.select("key", none.cast("bigint").alias("id"), none.cast("string").alias("uri"), none.cast("binary").alias("payload"), none.cast("string").alias("digest"), "refers_to")
    )
    dealt = both.withColumn("shard", shard_of("key")).repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "key", F.col("payload").isNotNull(), "uri")
    dealt.mapInArrow(_write_shards(work, roll_bytes, date), MANIFEST).write.parquet(f"{work}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{work}/manifest")
    manifest.mapInArrow(_commit(root, work), "bytes bigint").agg(F.sum("bytes")).collect()
    if not files.rename(_hadoop(spark, f"{work}/manifest")[0], final):
        raise OSError(f"the manifest of {root} could not be committed")
    files.delete(_hadoop(spark, work)[0], True)
    scratch.drop(keys)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
    size = int(headers["content-length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a record: its length or its version is wrong")
    return headers, rest[:size]


def members(stream, piece: int = 1 << 20):
    """The decompressed gzip members of a stream, one by one."""
    opened, held, data = zlib.decompressobj(31), [], stream.read(piece)
    while data:
        held.append(opened.decompress(data))
        data = opened.unused_data
        if opened.eof:
            yield b"".join(held)
            opened, held = zlib.decompressobj(31), []
        if not data:
            data = stream.read(piece)
    if any(held):
        raise ValueError("the file ends inside a record")


def _read_row(file: str, headers: dict[str, str], block: bytes, keep_payload: bool) -> dict:
    kind = headers["warc-type"]
    declared = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-block-digest"] != f"sha1:{digest_py(block)}":
        raise ValueError(f"{file}: a block does not have its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    whole = kind == "response"
    number = {x: int(headers[x]) if x in headers else None for x in ("x-row-id", "x-refers-to-row-id")}
    return {
        "file": file, "record_type": kind, "record_id": headers["warc-record-id"], "target_uri": headers["warc-target-uri"], "id": number["x-row-id"], "refers_to": number["x-refers-to-row-id"],
        "payload_bytes": len(payload) if whole else size, "payload_digest": digest_py(payload) if whole else declared, "declared_digest": declared, "payload": payload if whole and keep_payload else None,
    }


def read_archive(spark: SparkSession, root: str, payloads: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """A row for every response and revisit of the files that root's manifest names, READ's columns.

    Digest and length of a response are those of the payload that was read; of a
    revisit, which has none, those that its headers state. A record that does
    not have its digest or length raises. A file is read by one task, a record at a time.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    columns = [pa.field(n, pa.string()) for n in ("file", "record_type", "record_id", "target_uri")] + [pa.field(n, pa.int64()) for n in ("id", "refers_to", "payload_bytes")]
    schema = pa.schema([*columns, pa.field("payload_digest", pa.string()), pa.field("declared_digest", pa.string()), pa.field("payload", pa.binary())])

    def run(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                files, path = _place(f"{root}/{name}")
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        headers, block = parse(data)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        rows.append(_read_row(name, headers, block, payloads))
                        held += len(rows[-1]["payload"] or b"") + 500
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    count = max(1, manifest.count())
    return manifest.select("file").repartition(min(count, 10_000), "file").mapInArrow(run, READ)


def query(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the archives that it is written to."""
    root = f"{Scratch(pages.sparkSession, 'archive').root}/files"
    write_archive(pages, root)
    return read_archive(pages.sparkSession, root, payloads=False).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    fives = " || ".join(f"substr('{BASE32}', ((v[{i}] >> {s}) & 31) + 1, 1)" for i in range(1, 9) for s in (15, 10, 5, 0))
    return f"""WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    marked AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS top, row_number() OVER (PARTITION BY html, page_id) AS copy FROM rows),
    cut AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(h, (5 * i + 1)::BIGINT, 5))::INTEGER) AS v, page_id IS NOT NULL AND (page_id <> top OR copy > 1) AS again FROM marked)
    SELECT page_id, payload_bytes, {fives} AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to FROM cut"""
