"""MinHash near-duplicates with odd sketches (Mitzenmacher, Pagh and Pham, 2014).

Every text's set of word shingles gets MinHash samples. Bands of samples find
candidates. An odd sketch, the samples folded into a bitmap whose bits hold the
parity of how many samples fell on them, tells from the number of ones in the XOR
of two sketches how many samples differ, precisely so for high similarity; pairs
whose estimate is far below the threshold are dropped. A second odd sketch folds
the whole set: the ones in the XOR of two of these never exceed the elements in
which the sets differ, which rules pairs out for certain. The others are confirmed
on their full shingle sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import as_bytes, pieces
from loomspan.llm.shingles import WORDS, mix64, overlap, shingle_sets
from loomspan.plans.components import components
from loomspan.plans.scratch import Scratch

BANDS = 28
ROWS = 4
SAMPLES = BANDS * ROWS
#: Bits of the odd sketch, as 64-bit words.
SKETCH_WORDS = 4
SKETCH_BITS = 64 * SKETCH_WORDS
#: Words of the odd sketch of the whole set (a power of two).
PARITY_WORDS = 16
#: How many standard deviations of the estimate below the threshold a pair may be and still be confirmed.
MARGIN = 6.0
THRESHOLD = 0.8
#: Ids needed for confirmation are broadcast up to this many (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000

_RANDOM = np.random.default_rng(77)
_MULTIPLY = (_RANDOM.integers(1, 1 << 32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_SALT = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)


def samples(shingles: np.ndarray) -> np.ndarray:
    """The set's MinHash values, one for each of SAMPLES hash functions."""
    low, best = (shingles >> np.uint64(32)).astype(np.uint32), None
    for at in range(0, len(low), 4096):
        part = low[at : at + 4096, None] * _MULTIPLY + _ADD
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        least = part.min(axis=0)
        best = least if best is None else np.minimum(best, least)
    return best


def band_keys(mins: np.ndarray) -> np.ndarray:
    """(sets, BANDS) 64-bit keys; a band's number is part of its keys."""
    mixed = mix64(mins.astype(np.uint64) + _SALT).reshape(len(mins), BANDS, ROWS)
    return mix64(mixed.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """(sets, SKETCH_WORDS): every sample toggles the bit that it hashes to."""
    spot = (mix64(mins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    out = np.zeros((len(mins), SKETCH_WORDS), dtype=np.uint64)
    row = np.repeat(np.arange(len(mins)), SAMPLES)
    spot = spot.ravel()
    np.bitwise_xor.at(out, (row, spot >> 6), np.uint64(1) << (spot & 63).astype(np.uint64))
    return out.view(np.int64)


def most_odd_bits(threshold: float, margin: float = MARGIN) -> int:
    """The largest XOR count that a pair at the threshold shows, but for chances beyond ``margin`` deviations.

    With m = samples that differ, each toggles two bits of n: a bit of the XOR is
    set with probability (1 - (1 - 2/n)^(2m)) / 2. m itself is binomial.
    """
    n, k = SKETCH_BITS, SAMPLES
    differ = k * (1 - threshold) + margin * math.sqrt(k * threshold * (1 - threshold))
    p = (1 - (1 - 2 / n) ** (2 * min(k, differ))) / 2
    return math.ceil(n * p + margin / 2 * math.sqrt(n * p * (1 - p)))


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, PARITY_WORDS): the odd sketch of each whole set. Two sets differ in at least as many elements as their sketches in bits."""
    out = np.zeros((len(sets), 64 * PARITY_WORDS), dtype=np.uint8)
    shift = np.uint64(65 - (64 * PARITY_WORDS).bit_length())
    for i, s in enumerate(sets):
        if len(s):
            out[i] = np.bincount((s >> shift).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(out, axis=1, bitorder="little").view("<i8")


def odd_bits(a: str, b: str, words: int) -> Column:
    """Ones in the XOR of two sketch columns (arrays of so many longs), inside generated code."""
    ones = [F.bit_count(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))) for i in range(words)]
    total = ones[0]
    for more in ones[1:]:
        total = total + more
    return total


def features(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, version, n_shingles, print_hi, print_lo, bands, sketch, parity) for each row; the print is a 128-bit hash of the whole set."""

    def run(batches):
        for batch in pieces(batches, rows=500, size=1 << 18):
            sets = shingle_sets(as_bytes(batch.column("text")), words)
            full = [i for i, s in enumerate(sets) if len(s)]
            mins = np.stack([samples(sets[i]) for i in full]) if full else np.empty((0, SAMPLES), np.uint32)
            keys, sketches = band_keys(mins), odd_sketches(mins)
            high = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            low = np.array([mix64(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            at = dict(zip(full, range(len(full)), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("version"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(high),
                    pa.array(low),
                    pa.array([keys[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array([sketches[at[i]] if i in at else None for i in range(len(sets))], pa.list_(pa.int64())),
                    pa.array(list(parities(sets)), pa.list_(pa.int64())),
                ],
                ["doc_id", "version", "n_shingles", "print_hi", "print_lo", "bands", "sketch", "parity"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, version bigint, n_shingles bigint, print_hi bigint, print_lo bigint, bands array<bigint>, sketch array<bigint>, parity array<bigint>")


def confirm(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: float, words: int = WORDS) -> DataFrame:
    """The (a, b) pairs whose full shingle sets reach the similarity: 100 * intersection >= percent * union.

    Of rows that share an id only those with the text that the nodes (doc_id, version) name count.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct().join(nodes.select("doc_id", "version"), "doc_id")
    needed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("text"))
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    needed = needed.join(F.broadcast(ids) if few else ids, ["doc_id", "version"], "left_semi")

    def run(batches):
        for whole in batches:
            for batch in pieces([whole], rows=200, size=1 << 20, column="text_a"):
                left, right = as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))
                distinct = list(dict.fromkeys(left + right))
                sets = dict(zip(distinct, shingle_sets(distinct, words), strict=True))
                keep = []
                for x, y in zip(left, right, strict=True):
                    p, q = sets[x], sets[y]
                    both = overlap(p, q)
                    keep.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """One row (doc_id, n_shingles, component_id) for each distinct doc_id; components of the graph of pairs at the threshold.

    Texts with one shingle set form a class, found by an aggregation on the set's
    print, and only the least doc_id of a class goes on. In each band bucket a
    class is compared with the bucket's hub, then, where components still
    differ, with every class of the bucket outside its own component; so a
    bucket of many alike classes costs one comparison each, and a pair that
    shares a bucket goes unchecked only if it is connected already or its sketches
    rule it out. Texts without words (null, empty, only white space) and rows
    with a null doc_id are linked with nothing. Rows that share a doc_id count
    as one document, the one with the least set print. Other columns are not
    read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "near")
    # the least of the rows that share an id, without sorting arrays: a later join takes its features
    found = scratch.keep(features(docs, words))
    ids = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.struct("print_hi", "print_lo", "n_shingles", "version")).alias("p")).select("doc_id", "p.*")
    ids = scratch.keep(ids)
    classes = ids.where("n_shingles > 0").groupBy("print_hi", "print_lo", "n_shingles").agg(F.min(F.struct("doc_id", "version")).alias("p")).select("print_hi", "print_lo", "n_shingles", "p.*")
    classes = scratch.keep(classes)
    nodes = scratch.keep(
        found.join(classes.select("doc_id", "version", F.col("print_hi").alias("_h"), F.col("print_lo").alias("_l")), ["doc_id", "version"])
        .where((F.col("print_hi") == F.col("_h")) & (F.col("print_lo") == F.col("_l")))
        .select("doc_id", "version", "n_shingles", "bands", "sketch", "parity")
        .dropDuplicates(["doc_id"])
    )
    links = link_classes(nodes, docs, 100 * threshold, words, scratch)
    roots = components(links, label="near-components")
    members = (
        ids.join(classes.select("print_hi", "print_lo", "n_shingles", F.col("doc_id").alias("root")), ["print_hi", "print_lo", "n_shingles"], "left")
        .join(roots.withColumnRenamed("id", "root"), "root", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "root", "doc_id").alias("component_id"))
    )
    # rows without an id are documents too: linked with nothing, and with no component to name
    none = found.where(F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return members.unionByName(none)


def link_classes(nodes: DataFrame, docs: DataFrame, percent: float, words: int, scratch: Scratch) -> DataFrame:
    """Confirmed (a, b) links that connect exactly what all links between the nodes' bucket mates would."""
    limit, mark = most_odd_bits(percent / 100), scratch.mark()
    # sizes and whole-set parities bound the similarity from above; the samples' sketches estimate it
    total, odd = F.col("n_a") + F.col("n_b"), odd_bits("parity_a", "parity_b", PARITY_WORDS)
    possible = (
        (F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
        & (odd_bits("sketch_a", "sketch_b", SKETCH_WORDS) <= limit)
        & (F.lit(100) * (total - odd) >= F.lit(percent) * (total + odd))
    )
    postings = nodes.select("doc_id", F.explode("bands").alias("key"))
    # buckets of one class end here
    crowds = scratch.keep(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    shared = scratch.keep(postings.join(crowds, "key"))
    # a text from which the others of its group derive stands in the fullest buckets
    central = shared.groupBy("doc_id").agg(F.sum("n").alias("w"))
    hubs = shared.join(central, "doc_id").groupBy("key").agg(F.max(F.struct("w", (-F.col("doc_id")).alias("d"))).alias("h")).select("key", (-F.col("h.d")).alias("hub"))
    stars = shared.join(scratch.keep(hubs), "key").where("doc_id != hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"), "n")
    stars = stars.groupBy("a", "b").agg(F.sum("n").alias("w"))
    a = nodes.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"), F.col("parity").alias("parity_a"))
    b = nodes.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"), F.col("parity").alias("parity_b"))
    stars = scratch.keep(stars.join(a, "a").join(b, "b").where(possible).select("a", "b", "w"))
    # round 1: each class against the hub of most of its buckets
    once = scratch.keep(stars.groupBy("b").agg(F.max(F.struct("w", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"))
    links = scratch.keep(confirm(once, docs, nodes, percent, words))
    # round 2: its other hubs, where not connected yet
    label = components(links, label="near-round")
    others = scratch.keep(_apart(stars.select("a", "b").join(once.withColumn("_", F.lit(1)), ["a", "b"], "left_anti"), label))
    links = scratch.keep(links.unionByName(confirm(others, docs, nodes, percent, words)))
    # round 3: what shares a bucket across components
    label = components(links, label="near-round")
    placed = shared.join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("part"))
    counts = placed.groupBy("key", "part").agg(F.count("*").alias("n"))
    mixed = scratch.keep(
        counts.groupBy("key").agg(F.max(F.struct("n", "part")).alias("m"), F.count("*").alias("parts")).where("parts > 1").select("key", F.col("m.part").alias("main"))
    )
    rest = scratch.keep(placed.join(mixed, "key").join(nodes.select("doc_id", "n_shingles", "sketch", "parity"), "doc_id"))
    x = rest.where("part != main").select("key", *[F.col(c).alias(d) for c, d in _sides("a")])
    y = rest.select("key", "main", *[F.col(c).alias(d) for c, d in _sides("b")])
    across = (
        x.join(y, "key")
        .where((F.col("part_a") != F.col("part_b")) & ((F.col("part_b") == F.col("main")) | (F.col("a") < F.col("b"))) & possible)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    known = once.unionByName(others).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = scratch.keep(across.join(known, ["a", "b"], "left_anti"))
    links = scratch.keep(links.unionByName(confirm(across, docs, nodes, percent, words)))
    scratch.drop_since(mark, links)
    return links


def _sides(end: str) -> list[tuple[str, str]]:
    return [("doc_id", end), ("part", f"part_{end}"), ("n_shingles", f"n_{end}"), ("sketch", f"sketch_{end}"), ("parity", f"parity_{end}")]


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components so far."""
    a = label.select(F.col("id").alias("a"), F.col("component").alias("_ca"))
    b = label.select(F.col("id").alias("b"), F.col("component").alias("_cb"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """docs with one document of each component, its least doc_id, in all its rows; rows with a null doc_id stay. Columns are unchanged."""
    gone = near_duplicates(docs, threshold, words).where("doc_id != component_id").select("doc_id")
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    """Contract of op6: components at similarity 0.85."""
    found = near_duplicates(docs.select("doc_id", "text"), 0.85)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
