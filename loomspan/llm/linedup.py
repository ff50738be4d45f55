"""Removal of repeated runs of lines by winnowing (Schleimer, Wilkerson and Aiken, 2003).

A document is the sequence of its lines' hashes. Runs that repeat elsewhere are
found from a few fingerprints: grams of consecutive lines, of which each window
keeps its least. A window is the shortest run with ``min_words`` words from a line
on, or up to a line. Equal windows share their fingerprint, so only windows whose
fingerprint occurs twice are compared, by the hash of all their lines. The lines of
every window that occurred before are deleted: a repeated run of ``min_words`` words
is the union of such windows, whatever follows or precedes its other copies.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import pieces
from loomspan.plans.ranks import fresh
from loomspan.plans.scratch import Scratch

#: A repeated run is deleted from this many words on; any such run is found.
MIN_WORDS = 50
#: Words of the grams that fingerprints hash.
GRAM_WORDS = 25


def split_lines(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def line_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, words) of each line. White space at a line's ends and the amount between words do not count."""
    words = [x.split() for x in lines]
    hashes = np.array([xxhash.xxh3_64_intdigest(" ".join(w).encode("utf-8", "surrogatepass")) for w in words], dtype=np.uint64)
    return hashes.view(np.int64), np.array([len(w) for w in words], dtype=np.int64)


def spans(words: np.ndarray, least: int) -> np.ndarray:
    """For each line, the end (exclusive) of the shortest run from it with so many words; one past the last line if there is none."""
    total = np.concatenate([[0], np.cumsum(words)])
    return np.searchsorted(total, total[:-1] + least, side="left")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """Hashes of runs of lines, from prefix sums of line hashes times powers."""

    def __init__(self, hashes: np.ndarray, seed: int = 0):
        n = len(hashes)
        power = np.cumprod(np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
        inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.back = np.cumprod(np.full(n + 1, inverse, dtype=np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes.view(np.uint64) ^ np.uint64(seed)) * power[:n])])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stops] - self.sums[starts]) * self.back[starts])


def windows_of(words: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of the shortest runs with min_words words from each line on and up to each line, once each, both rising."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    stops = spans(words, min_words)[:n]
    starts = np.flatnonzero(stops <= n)
    ends = np.flatnonzero(total >= min_words)
    ends = ends[ends > 0]
    begins = np.searchsorted(total, total[ends] - min_words, side="right") - 1
    both = np.unique(np.concatenate([starts * (n + 1) + stops[starts], begins * (n + 1) + ends]))
    return both // (n + 1), both % (n + 1)


def window_prints(hashes: np.ndarray, words: np.ndarray, starts: np.ndarray, stops: np.ndarray, gram_words: int = GRAM_WORDS) -> np.ndarray:
    """Each window's fingerprint: the least hash of the grams inside it. The gram at a line is the shortest run from it with gram_words words."""
    n = len(hashes)
    if not len(starts):
        return np.empty(0, np.int64)
    ends = spans(words, gram_words)[:n]
    gram = Runs(hashes).of(np.arange(n), np.minimum(ends, n))
    gram[ends > n] = np.uint64(0xFFFFFFFFFFFFFFFF)
    # windows and the grams inside them move right together: a queue of rising hashes gives each minimum
    chosen: list[int] = []
    queue: deque[int] = deque()
    inside = np.searchsorted(ends, stops, side="right").tolist()
    values, taken = gram.tolist(), 0
    for i, held in zip(starts.tolist(), inside, strict=True):
        for j in range(taken, held):
            while queue and values[queue[-1]] >= values[j]:
                queue.pop()
            queue.append(j)
        taken = max(taken, held)
        while queue[0] < i:
            queue.popleft()
        chosen.append(queue[0])
    return gram[np.array(chosen, dtype=np.int64)].view(np.int64)


def covered(starts, stops, n: int) -> np.ndarray:
    """Whether each of n lines is in one of the runs."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, stops, -1)
    return np.cumsum(edges[:n]) > 0


def window_keys(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each window, in two words: equal for equal lines."""
    return Runs(hashes).of(starts, stops).view(np.int64), Runs(hashes, 0x5851F42D4C957F2D).of(starts, stops).view(np.int64)


def first_windows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each window, by its key's words, is the first in the document with its lines."""
    out = np.ones(len(a), dtype=bool)
    order = np.lexsort((np.arange(len(a)), b, a))
    out[order[1:]] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    return out


_SEQUENCE = "doc_id bigint, version bigint, hashes array<bigint>, words array<int>, own array<int>, prints array<bigint>"


def version_of(text: Column) -> Column:
    """Tells the texts of rows that share an id from each other."""
    return F.xxhash64(text)


def sequences(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """One row for each row of docs with text: line hashes, words, lines that repeat the document itself, distinct fingerprints."""

    def run(batches):
        for batch in pieces(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, version, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "version", "text")), strict=True):
                hashes, words = line_hashes(split_lines(text))
                starts, stops = windows_of(words, min_words)
                prints = np.unique(window_prints(hashes, words, starts, stops, gram_words))
                later = ~first_windows(*window_keys(hashes, starts, stops))
                own = np.flatnonzero(covered(starts[later], stops[later], len(hashes)))
                for column, value in zip(out, (doc, version, hashes, words, own, prints), strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["doc_id", "version", "hashes", "words", "own", "prints"])

    rows = docs.where(F.col("doc_id").isNotNull() & (F.col("text") != "")).select(F.col("doc_id").cast("long").alias("doc_id"), version_of(F.col("text")).alias("version"), "text")
    return rows.mapInArrow(run, _SEQUENCE)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """(doc_id, version, n_removed, bits): for each document with later repeats, the lines to delete as a bitmap of 64 lines a word.

    Places are ordered by (doc_id, line). A line goes when a run of min_words
    words that holds it occurred at an earlier place. A document sends a window
    once, however often it holds it, and only if another document shares the
    window's fingerprint.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    seq = scratch.keep(
        sequences(docs, min_words, gram_words)
        .groupBy("doc_id")
        .agg(F.min(F.struct("hashes", "words", "version", "own", "prints")).alias("s"))
        .select("doc_id", "s.*")
    )
    places = scratch.keep(seq.select("doc_id", F.explode("prints").alias("print")))
    shared = scratch.keep(places.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"))
    hits = scratch.keep(places.join(shared, "print").groupBy("doc_id").agg(F.collect_list("print").alias("shared")))

    def cut(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "hashes", "words", "shared")]
            for doc, hashes, words, found in zip(*cols, strict=True):
                hashes, words = np.array(hashes, dtype=np.int64), np.array(words, dtype=np.int64)
                starts, stops = windows_of(words, min_words)
                keep = np.isin(window_prints(hashes, words, starts, stops, gram_words), np.array(found, dtype=np.int64))
                starts, stops = starts[keep], stops[keep]
                a, b = window_keys(hashes, starts, stops)
                first = first_windows(a, b)
                ids = np.full(int(first.sum()), doc, dtype=np.int64)
                arrays = [pa.array(ids), pa.array(starts[first], pa.int32()), pa.array(stops[first], pa.int32()), pa.array(a[first]), pa.array(b[first])]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "stop", "a", "b"])

    held = hits.join(seq.select("doc_id", "hashes", "words"), "doc_id").select("doc_id", "hashes", "words", "shared")
    windows = scratch.keep(held.mapInArrow(cut, "doc_id bigint, start int, stop int, a bigint, b bigint"))
    firsts = scratch.keep(
        windows.groupBy("a", "b").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("a", "b", "first_id")
    )
    across = (
        windows.join(firsts, ["a", "b"])
        .where(F.col("doc_id") != F.col("first_id"))
        .groupBy("doc_id")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    )

    def spread(batches):
        for batch in batches:
            found = []
            for starts, stops in zip(batch.column("starts").to_pylist(), batch.column("stops").to_pylist(), strict=True):
                found.append(np.flatnonzero(covered(np.array(starts), np.array(stops), max(stops))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "lines"])

    def bitmaps(batches):
        for batch in batches:
            counts, maps = [], []
            for lists in batch.column("lists").to_pylist():
                lines = np.unique(np.concatenate([np.array(x, dtype=np.int64) for x in lists]))
                bits = np.zeros(int(lines[-1]) // 64 + 1, dtype=np.uint64)
                np.bitwise_or.at(bits, lines // 64, np.uint64(1) << (lines % 64).astype(np.uint64))
                counts.append(len(lines))
                maps.append(bits.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int32()), pa.array(maps, pa.list_(pa.int64()))], ["doc_id", "n_removed", "bits"]
            )

    across = across.mapInArrow(spread, "doc_id bigint, lines array<int>")
    own = seq.where(F.size("own") > 0).select("doc_id", F.col("own").alias("lines"))
    gathered = across.unionByName(own).groupBy("doc_id").agg(F.collect_list("lines").alias("lists"))
    cuts = scratch.keep(gathered.mapInArrow(bitmaps, "doc_id bigint, n_removed int, bits array<bigint>"))
    return scratch.keep(cuts.join(seq.select("doc_id", "version"), "doc_id"))


#: Deletion bitmaps of at most this many words (8 bytes each) may be broadcast in place of shuffling the texts.
BROADCAST_WORDS = 1_000_000


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """docs with later repeated runs deleted from ``text``, plus n_lines and n_removed (ints, replaced if present).

    Every row stays: a text of which everything is deleted becomes empty, and
    null texts stay null with no lines. Rows with a null doc_id are not compared
    and stay as they are. Of rows that share a doc_id the text with the least
    line hashes is compared and cut, in all its rows; rows of that id with other
    texts stay as they are. Other columns pass through, whatever their names.
    Empty tables give empty results.
    """
    cuts = repeated_lines(docs, min_words, gram_words)
    size = cuts.agg(F.coalesce(F.sum(F.size("bits") + 2), F.lit(0))).first()[0]
    kept = docs.drop("n_lines", "n_removed")
    key, version, removed, bits = fresh(kept.columns, "_id", "_version", "_removed", "_bits")
    cuts = cuts.select(*[F.col(c).alias(name) for c, name in (("doc_id", key), ("version", version), ("n_removed", removed), ("bits", bits))])
    same = (F.col("doc_id") == F.col(key)) & (version_of(F.col("text")) == F.col(version))
    joined = kept.join(F.broadcast(cuts) if size <= BROADCAST_WORDS else cuts, same, "left")
    lines = F.split(F.col("text"), "\n", -1)

    def stays(_, i):
        word = F.get(F.col(bits), F.shiftright(i, 6))
        return F.coalesce(F.getbit(word, F.pmod(i, F.lit(64))), F.lit(0)) == 0

    left = F.when(F.col(bits).isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return joined.select(
        *[left.alias(c) if c == "text" else F.col(c) for c in kept.columns],
        F.when(F.coalesce(F.length("text"), F.lit(0)) > 0, F.size(lines)).otherwise(0).alias("n_lines"),
        F.coalesce(F.col(removed), F.lit(0)).alias("n_removed"),
    )


def query(docs: DataFrame) -> DataFrame:
    """Every document's line counts and the length and MD5 of what is left of its text (null for a null text). See ``dedup_lines`` for odd rows."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))
