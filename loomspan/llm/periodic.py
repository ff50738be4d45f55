"""Runs of repeated words inside a document: maximal stretches with a period, at least so many periods long.

Two occurrences of a run, one period apart, overlap in its length less the
period. So every word of a run lies in a k-gram that the document holds twice,
where k is the least overlap that a run can have. Words outside such k-grams are
masked; what is left falls into segments, and a run lies inside one of them. Each
segment is halved again and again, as Main and Lorentz do: a run that crosses
the middle of a piece, and is no part of a half, holds two whole periods on one
side of the middle. Whether two equal blocks of p words begin or end there is one
comparison of hashes for each p; all middles of all segments of a batch of
documents are compared at once. A square that is found is then extended both ways,
word by word, which also settles what hashes only suggest.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import pieces
from loomspan.llm.shingles import mix64

MIN_LENGTH, MIN_PERIODS = 6, 4
#: Bytes of text in one batch of documents (a longer document is a batch of its own).
BATCH_BYTES = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers never vanish
_powers = np.ones(1, dtype=np.uint64)


def _grown(n: int) -> np.ndarray:
    """The first n powers of the base, at least."""
    global _powers
    if len(_powers) < n:
        factors = np.full(1 << (n - 1).bit_length(), _BASE, dtype=np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors)
    return _powers


def least_overlap(min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> int:
    """The fewest words that a run shares with itself one period on: its length less the period, over all periods."""
    return min(max(min_length, min_periods * q) - q for q in range(1, min_length + 1))


def repeated(words: np.ndarray, docs: np.ndarray, k: int) -> np.ndarray:
    """Whether each word lies in a k-gram that its document holds more than once. Words and documents are numbers; equal k-grams have equal hashes, so no repeat is missed."""
    n = len(words)
    out = np.zeros(n + 1, dtype=np.int64)
    if n < k:
        return out[:n] > 0
    hashed = mix64(words.astype(np.uint64) + np.uint64(1))
    rolled = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        rolled = rolled * _BASE + hashed[i : i + len(rolled)]
    rolled = mix64(rolled ^ mix64(docs[: len(rolled)].astype(np.uint64) + np.uint64(7)))
    places = np.flatnonzero(docs[: len(rolled)] == docs[k - 1 :])
    order = places[np.argsort(rolled[places])]
    same = rolled[order[1:]] == rolled[order[:-1]]
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    starts = np.unique(starts)
    np.add.at(out, starts, 1)
    np.add.at(out, starts + k, -1)
    return np.cumsum(out)[:n] > 0


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, values): the numbers starts[i], starts[i] + 1... so many of each, and i beside them."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


class _Extender:
    """Squares of one array of words, extended to runs. Every run is kept once, with its least period."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.runs: dict[tuple[int, int], int] = {}
        n = len(words)
        # of the runs that cover a word, the one that ends last and the one of the least period: their periods, starts and ends
        self.far = (np.full(n, n + 1), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64))
        self.short = (np.full(n, n + 1), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64))

    def unknown(self, at: np.ndarray, p: np.ndarray, rightwards: bool) -> np.ndarray:
        """Which squares (two blocks of p words from at on, or up to it) are no part of a known run of a period up to p.

        A square inside a run of period q, with p of at least q, has a multiple of
        q as its p, and extends to the same run.
        """
        out = np.ones(len(at), dtype=bool)
        where = at if rightwards else at - 1
        for period, start, end in (self.far, self.short):
            inside = (at + 2 * p <= end[where]) if rightwards else (at - 2 * p >= start[where])
            out &= ~((period[where] <= p) & inside)
        return out

    def extend(self, at: int, p: int, rightwards: bool, low: int, high: int, min_length: int, min_periods: int) -> None:
        """The run around the square, inside [low, high), if it is long enough and truly one."""
        here = at if rightwards else at - p
        stop = here + self._equal(here, p, high - p - here, 1) + p
        start = here - self._equal(here - 1, p, here - low, -1)
        if stop - start < max(min_length, min_periods * p):
            return
        known = self.runs.get((start, stop))
        if known is not None and known <= p:
            return
        self.runs[start, stop] = p
        rows = slice(start, stop)
        for table, better in ((self.far, self.far[2][rows] < stop), (self.short, self.short[0][rows] > p)):
            for column, value in zip(table, (p, start, stop), strict=True):
                column[rows][better] = value

    def _equal(self, at: int, p: int, most: int, step: int) -> int:
        """How many words from at on (in the direction of step) equal those p words on, at most so many."""
        done, size = 0, 64
        while done < most:
            size = min(size, most - done)
            begin = at + done if step > 0 else at - done - size + 1
            differ = np.flatnonzero(self.words[begin : begin + size] != self.words[begin + p : begin + p + size])
            if len(differ):
                return done + int(differ[0] if step > 0 else size - 1 - differ[-1])
            done, size = done + size, size * 4
        return done


def find_runs(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of every run inside the segments [starts, stops) of an array of word numbers, by start, then stop.

    Runs have at least four periods, so that two lie on one side of any place in them.
    """
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods are not looked for")
    lengths = stops - starts
    keep = lengths >= min_length
    starts, stops, lengths = starts[keep], stops[keep], lengths[keep]
    if not len(starts):
        return (np.empty(0, dtype=np.int64),) * 3
    powers = _grown(len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(words.astype(np.uint64) + np.uint64(1)) * powers[: len(words)])])
    found = _Extender(words)
    for level in range(int(lengths.max() - 1).bit_length() - 1, 0, -1):
        half = 1 << level
        # pieces of 2 * half words; a run inside one holds min_periods periods, and two of them on one side of its middle
        most = max(1, 2 * half // min_periods)
        if 2 * half < min_length:
            break
        middles = (lengths - 1 + half) // (2 * half)
        segment, number = _spread(np.zeros(len(lengths), dtype=np.int64), middles)
        middle = starts[segment] + half * (2 * number + 1)
        inside = middle < stops[segment]
        segment, middle = segment[inside], middle[inside]
        for rightwards in (True, False):
            room = (stops[segment] - middle if rightwards else middle - starts[segment]) // 2
            which, p = _spread(np.ones(len(middle), dtype=np.int64), np.minimum(np.minimum(room, most), lengths[segment] // min_periods))
            at = middle[which]
            a = at if rightwards else at - 2 * p
            equal = (sums[a + p] - sums[a]) * powers[p] == sums[a + 2 * p] - sums[a + p]
            which, p, at = which[equal], p[equal], at[equal]
            order = np.lexsort((at, p))
            while len(order):
                fresh = found.unknown(at[order], p[order], rightwards)
                order = order[fresh]
                # one extension settles many squares: after some, the rest are looked through again
                for i in order[:256]:
                    if found.unknown(at[i : i + 1], p[i : i + 1], rightwards)[0]:
                        found.extend(int(at[i]), int(p[i]), rightwards, int(starts[segment[which[i]]]), int(stops[segment[which[i]]]), min_length, min_periods)
                order = order[256:]
    runs = sorted((s, e, q) for (s, e), q in found.runs.items())
    return tuple(np.array([r[i] for r in runs], dtype=np.int64) for i in range(3))


def spans(mask: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of the longest stretches of words that the mask keeps, inside documents."""
    if not len(mask):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    change = np.flatnonzero(np.diff(docs)) + 1
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[change] = True
    before = np.concatenate([[False], mask[:-1]])
    begins = mask & (~before | edge[:-1])
    after = np.concatenate([mask[1:], [False]])
    ends = mask & (~after | edge[1:])
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


#: (id, number of words) -> None, or (a, p): words from a on are taken as those of [a, a + p) again and again.
View = Callable[[int | None, int], tuple[int, int] | None]


def runs_of(texts: list[bytes], ids: list[int | None], view: View | None = None, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """For each text its runs (start, length, period), by start, then period, and the text without what repeats: words joined by one space, less those that a run contains after its first period."""
    split = [t.split() for t in texts]  # at ASCII white space
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    words = np.empty(first[-1], dtype=object)
    words[:] = [w for doc in split for w in doc]
    del split
    codes = pd.factorize(words)[0].astype(np.int64) if len(words) else np.empty(0, dtype=np.int64)
    for i, key in enumerate(ids):
        bent = view(key, int(sizes[i])) if view and sizes[i] else None
        if bent:
            a, p = bent
            source = first[i] + a + np.arange(sizes[i] - a) % p
            rest = slice(first[i] + a, first[i + 1])
            codes[rest], words[rest] = codes[source], words[source]
    docs = np.repeat(np.arange(len(texts)), sizes)
    mask = repeated(codes, docs, least_overlap(min_length, min_periods))
    starts, stops, periods = find_runs(codes, *spans(mask, docs), min_length, min_periods)
    cut = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cut, np.minimum(starts + periods, stops), 1)
    np.add.at(cut, stops, -1)
    kept = np.cumsum(cut)[:-1] == 0
    owner = np.searchsorted(first, starts, side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        rows = slice(first[i], first[i + 1])
        low, high = bounds[i], bounds[i + 1]
        own = words[rows][kept[rows]] if low < high else words[rows]
        runs = sorted(zip((starts[low:high] - first[i]).tolist(), (stops - starts)[low:high].tolist(), periods[low:high].tolist(), strict=True), key=lambda r: (r[0], r[2]))
        out.append((runs, b" ".join(own.tolist())))
    return out


def collapse(docs: DataFrame, id: str = "doc_id", text: str = "text", view: View | None = None, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(id, runs, collapsed) of every row: the text's runs and what is left of it without repeats.

    Every row is worked on by itself and whole; rows that repeat come out alike. A
    null, empty or blank text has no words, no runs and an empty result; a null id
    stays null. Time grows with the words times the logarithm of the longest repeated stretch.
    """

    def run(batches):
        for piece in pieces(batches, 1 << 20, BATCH_BYTES):
            texts = [x or b"" for x in piece.column("text").to_pylist()]
            ids = piece.column("id").to_pylist()
            found = runs_of(texts, ids, view, min_length, min_periods)
            runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in found], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), runs, pa.array([t for _, t in found], pa.binary())], ["id", "runs", "collapsed"])

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(run, "id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return out.select(F.col("id").alias(id), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def bent_tenth(key: int | None, n: int) -> tuple[int, int] | None:
    """The query's view of a document: of one in ten, the words from one place on repeat the first few of them."""
    if key is None:
        return None
    h = zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def query(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the run with most periods, and the digests of all runs and of the collapsed text."""
    found = collapse(docs, view=bent_tenth)
    # exact comparison of length / period: a's is greater if a.length * b.period > b.length * a.period
    best = F.aggregate(
        F.col("runs"), F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
