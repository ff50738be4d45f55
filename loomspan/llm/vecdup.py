"""Near-duplicate vectors by randomised-rotation binary codes (RaBitQ, Gao and Long, 2024).

Every unit vector is rotated by one random orthogonal matrix. Its code is the
signs of the rotated components, and a stored correction factor, the inner
product of the vector with its own code, turns the inner product of that code
with another vector into an unbiased estimate of the two vectors' cosine. The
other vector is held as four bit planes, so an estimate is a few ANDs and bit
counts inside generated code. A confidence bound on the estimate decides which
candidate pairs are recomputed exactly in double precision.

Candidates share a bucket of random hyperplane signs. The bits of a bucket grow
with the logarithm of the largest label and the number of bucket sets follows
from the recall wanted at the threshold, so work grows slower than all pairs.
A bucket is compared in tiles of bounded size, each pair in the first bucket set
that it shares, and a tile gives back link counts for its vectors and the links of
a spanning forest: no table holds a row for each pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import pieces
from loomspan.plans.components import components
from loomspan.plans.scratch import Scratch

THRESHOLD = 0.93
#: Chance that a pair exactly at the threshold shares a bucket.
RECALL = 0.9995
#: Rows of the largest label that share a bucket by chance, about.
BUCKET_ROWS = 1024
#: Rows on either side of a tile.
TILE_ROWS = 1024
#: Buckets of more than a tile are broadcast up to this many; beyond it the join shuffles.
BROADCAST_BUCKETS = 100_000
#: The confidence bound, in deviations of a worst-case pair (a pair at 0.93 deviates 0.37 times as much).
EPSILON = 1.9
PLANES = 4
SEED = 4242


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same dimension everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def hyperplanes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(SEED - 1 - dim).standard_normal((dim, count))


def bands_for(largest: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a bucket, bucket sets) for a largest label of so many rows."""
    bits = min(31, max(2, math.ceil(math.log2(max(2, largest) / BUCKET_ROWS))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _pack(bits: np.ndarray, words: int) -> np.ndarray:
    """(rows, dim) booleans as (rows, words) 64-bit integers, low bit first."""
    padded = np.zeros((len(bits), 64 * words), dtype=np.uint8)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8").astype(np.uint64).view(np.int64)


def units(rows: np.ndarray) -> np.ndarray:
    """The rows at length one, in double precision."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def codes(units: np.ndarray) -> dict[str, np.ndarray]:
    """Code, bit planes and correction terms of each unit vector (rows of one dimension).

    For a code c (bits b, factor f) and another rotated vector v ~ low + step * q,
    sqrt(dim) * f * cosine is about 2 * (low * |b| + step * sum(b * q)) - base,
    with base = low * dim + step * sum(q).
    """
    n, dim = units.shape
    turned = units @ rotation(dim).T
    words = -(-dim // 64)
    bits = turned >= 0
    factor = np.abs(turned).sum(axis=1) / math.sqrt(dim)
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / (2**PLANES - 1)
    step[step == 0] = 1e-12
    level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
    planes = np.concatenate([_pack((level >> j) & 1 == 1, words) for j in range(PLANES)], axis=1)
    spread = np.sqrt(np.maximum(0.0, 1 - factor**2)) / factor / math.sqrt(max(1, dim - 1))
    return {
        "code": _pack(bits, words),
        "planes": planes,
        "ones": bits.sum(axis=1).astype(np.float64),
        "scale": 1 / (math.sqrt(dim) * factor),
        "bound": EPSILON * spread,
        "low": low,
        "step": step,
        "base": low * dim + step * level.sum(axis=1),
        # rounding to a plane level errs by step / sqrt(12) a component, independent signs
        "blur": 4 * step / math.sqrt(12) * math.sqrt(dim),
    }


#: The terms of a code, as one array in a row.
_FLOATS = ("ones", "scale", "bound", "low", "step", "base", "blur")
_NODE = "vec_id bigint, label string, hi bigint, lo bigint, dim int, usable boolean, code array<bigint>, planes array<bigint>, keys array<int>, terms array<double>, vector array<{width}>"


def encode(vectors: DataFrame, bits: int, bands: int) -> DataFrame:
    """One row for each input row: identity of the vector, whether it can be linked, code, planes, bucket keys, terms and the vector as given."""
    narrow = dict(vectors.dtypes)["embedding"] == "array<float>"
    schema = _NODE.format(width="float" if narrow else "double")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in pieces(batches, column="size_hint"):
            given = batch.column("embedding").to_pylist()
            labels = batch.column("label").to_pylist()
            out = {c: [None] * len(given) for c in names}
            out["vec_id"] = batch.column("vec_id").to_pylist()
            out["label"], out["usable"] = labels, [False] * len(given)
            by: dict[int, list[int]] = {}
            rows: list[np.ndarray | None] = []
            for i, value in enumerate(given):
                x = None if value is None or None in value or not value else np.array(value, dtype=np.float64)
                rows.append(x)
                digest = xxhash.xxh3_128_intdigest(b"" if x is None else x.tobytes())
                out["hi"][i], out["lo"][i] = (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)
                if x is not None and labels[i] is not None and np.isfinite(x).all() and x.any():
                    by.setdefault(len(x), []).append(i)
            for dim, at in by.items():
                x = units(np.stack([rows[i] for i in at]))
                found = codes(x)
                sides = (x @ hyperplanes(dim, bits * bands) >= 0).reshape(len(at), bands, bits)
                keys = sides @ (1 << np.arange(bits, dtype=np.int64))
                terms = np.stack([found[c] for c in _FLOATS], axis=1)
                for k, i in enumerate(at):
                    out["usable"][i], out["dim"][i], out["keys"][i] = True, dim, keys[k]
                    out["code"][i], out["planes"][i], out["terms"][i], out["vector"][i] = found["code"][k], found["planes"][k], terms[k], rows[i]
            types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
            types |= {"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "array<float>": pa.list_(pa.float32())}
            kinds = [types[x.split()[1]] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in zip(names, kinds, strict=True)], names)

    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.lit(b"").cast("binary").alias("size_hint"),
    )
    return rows.mapInArrow(run, schema)


def estimate(code: np.ndarray, planes: np.ndarray, terms_a: np.ndarray, terms_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated cosines, their bounds) of code sides a (rows) with plane sides b (columns)."""
    words = code.shape[1]
    common = np.zeros((len(code), len(planes)), dtype=np.float32)
    for w in range(words):
        for j in range(PLANES):
            common += np.bitwise_count(code[:, w, None] & planes[None, :, words * j + w]).astype(np.float32) * np.float32(1 << j)
    a, b = dict(zip(_FLOATS, terms_a.T, strict=True)), dict(zip(_FLOATS, terms_b.T, strict=True))
    inner = 2 * (b["low"][None, :] * a["ones"][:, None] + b["step"][None, :] * common) - b["base"][None, :]
    return inner * a["scale"][:, None], a["bound"][:, None] + b["blur"][None, :] * a["scale"][:, None]


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return np.asarray(flat).astype(dtype, copy=False).reshape(len(column), -1)


class Tile:
    """The rows of one tile: those of its first part, and of its second one (none if it compares a part with itself)."""

    def __init__(self, rows: pa.Table):
        self.ids, self.weights, self.part = (rows.column(c).to_numpy() for c in ("vec_id", "weight", "part"))
        self.band = rows.column("band")[0].as_py()
        self.keys = _matrix(rows.column("keys"), np.int32)
        self.code, self.planes = (_matrix(rows.column(c), np.int64).view(np.uint64) for c in ("code", "planes"))
        self.terms, self.vector = _matrix(rows.column("terms"), np.float64), units(_matrix(rows.column("vector"), np.float64))
        self.alone = rows.column("first")[0].as_py() == rows.column("second")[0].as_py()

    def links(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the linked pairs that meet here for the first time."""
        parts = np.unique(self.part)
        if not self.alone and len(parts) < 2:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        left = np.flatnonzero(self.part == parts[0])
        right = left if self.alone else np.flatnonzero(self.part == parts[1])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            cosine, bound = estimate(self.code[rows], self.planes[right], self.terms[rows], self.terms[right])
            x, y = np.nonzero(cosine + bound >= threshold)
            a, b = rows[x], right[y]
            if self.alone:
                a, b = a[self.ids[a] < self.ids[b]], b[self.ids[a] < self.ids[b]]
            for start in range(0, len(a), 50_000):
                p, q = a[start : start + 50_000], b[start : start + 50_000]
                new = ~(self.keys[p, : self.band] == self.keys[q, : self.band]).any(axis=1)
                p, q = p[new], q[new]
                near = np.einsum("ij,ij->i", self.vector[p], self.vector[q]) >= threshold
                found.append((p[near], q[near]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n places the least place that the links connect each with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def tiled(heads: DataFrame, threshold: float) -> DataFrame:
    """(vec_id, far, other) for the vectors of every tile that are linked there: the weight of what they are linked with, and a vector they are connected with."""
    postings = heads.select("label", "dim", F.posexplode("keys").alias("band", "key"))
    bucket = ["label", "dim", "band", "key"]
    large = postings.groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > TILE_ROWS).withColumn("parts", F.ceil(F.col("n") / TILE_ROWS).cast("int")).drop("n")
    large = Scratch(heads.sparkSession, "buckets").keep(large)
    few = large.limit(BROADCAST_BUCKETS + 1).count() <= BROADCAST_BUCKETS
    rows = heads.select("*", F.posexplode("keys").alias("band", "key")).join(F.broadcast(large) if few else large, bucket, "left")
    parts = F.coalesce("parts", F.lit(1))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1))).withColumns({"first": F.least("part", "with"), "second": F.greatest("part", "with")})
    rows = rows.withColumn("tile", F.xxhash64(*bucket, "first", "second"))
    # a tile's rows one after the other; no tile has more rows than its parts, so none is hot
    order = ["tile", *bucket, "first", "second"]
    n = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*order, "part", "vec_id", "weight", "keys", "code", "planes", "terms", "vector").repartition(n, "tile").sortWithinPartitions(*order)

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def out():
            tile = Tile(pa.Table.from_batches(held))
            a, b = tile.links(threshold)
            if len(a):
                far = np.zeros(len(tile.ids), dtype=np.int64)
                np.add.at(far, a, tile.weights[b])
                np.add.at(far, b, tile.weights[a])
                at = np.flatnonzero(far)
                roots = forest(len(far), a, b)
                yield pa.RecordBatch.from_arrays([pa.array(tile.ids[at]), pa.array(far[at]), pa.array(tile.ids[roots[at]])], ["vec_id", "far", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c) for c in order]
            marks = list(zip(*(c.to_pylist() for c in columns), strict=True))
            starts = [i for i in range(len(marks)) if i == 0 or marks[i] != marks[i - 1]]
            for start, stop in zip(starts, [*starts[1:], len(marks)], strict=True):
                if marks[start] != last:
                    if held:
                        yield from out()
                    held, last = [], marks[start]
                held.append(batch.slice(start, stop - start))
        if held:
            yield from out()

    return rows.mapInArrow(run, "vec_id bigint, far bigint, other bigint")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row (vec_id, n_links, component_id) for each distinct vec_id, by links inside equal labels.

    Equal vectors of a label form a class that is compared once; links count all
    its members. Vectors that are null, empty, zero, or hold null or non-finite
    components, and rows with a null label, link with nothing; vectors of
    different lengths are not compared. Rows that share a vec_id count as one
    vector, the one with the least (label, hash of its values); a null vec_id gives one row
    for each such input row, without links and with a null component. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    known = vectors.where(F.col("label").isNotNull())
    largest = known.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    bits, bands = bands_for(largest or 1, threshold, recall)
    found = scratch.keep(encode(vectors, bits, bands))
    # an unusable row's label does not matter, and null is no label
    own = F.struct(F.coalesce("label", F.lit("")).alias("l"), "hi", "lo", "dim", "usable")
    ids = scratch.keep(found.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min(own).alias("p")).select("vec_id", "p.*"))
    classes = scratch.keep(ids.where("usable").groupBy("l", "hi", "lo", "dim").agg(F.min("vec_id").alias("root"), F.count("*").alias("weight")))
    # repeated rows of a vector are the same to the bit, so the first to come will do
    chosen = classes.select(F.col("root").alias("vec_id"), F.col("l").alias("label"), "hi", "lo", "dim", "weight")
    heads = scratch.keep(found.where("usable").join(chosen, ["vec_id", "label", "hi", "lo", "dim"]).dropDuplicates(["vec_id"]))
    tiles = scratch.keep(tiled(heads, threshold))
    degree = tiles.groupBy(F.col("vec_id").alias("root")).agg(F.sum("far").alias("far"))
    roots = components(tiles.select(F.col("vec_id").alias("a"), F.col("other").alias("b")), label="vector-components").withColumnRenamed("id", "root")
    members = (
        ids.join(classes, ["l", "hi", "lo", "dim"], "left")
        .join(degree, "root", "left")
        .join(roots, "root", "left")
        .select(
            "vec_id",
            F.when(F.col("usable"), F.coalesce("far", F.lit(0)) + F.col("weight") - 1).otherwise(0).cast("long").alias("n_links"),
            F.when(F.col("usable"), F.coalesce("component", "root")).otherwise(F.col("vec_id")).alias("component_id"),
        )
    )
    none = F.lit(None).cast("long")
    return members.unionByName(vectors.where(F.col("vec_id").isNull()).select(none.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), none.alias("component_id")))


def query(embeddings: DataFrame) -> DataFrame:
    """Contract of op8. See ``near_vectors`` for odd rows; a row without an id is kept."""
    return near_vectors(embeddings.select("vec_id", "embedding", "label")).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
