"""Audio fingerprints from pitch-class frames, and alignment of recordings.

A signal's short-time spectra are folded into twelve pitch classes. Rectangle
filters over the resulting image, summed with an integral image, are quantised to
two bits each; sixteen of them make one 32-bit code for every frame position. Every
run of a few codes is a landmark. Two recordings that share landmarks are aligned by
the histogram of the offsets between these, and judged by the bits in which their
overlapping codes differ at the best offset.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import as_bytes, pieces
from loomspan.plans.components import components
from loomspan.plans.scratch import Scratch

RATE = 8000
FRAME, HOP = 256, 64
CLASSES = 12
#: Frames that a code covers.
SPAN = 16
LOWEST, HIGHEST = 40.0, 3600.0
#: Recordings that do not stand for their class are broadcast up to this many (24 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
#: Quantiser steps of a filter's log ratio.
STEPS = np.array([-0.12, 0.0, 0.12])
#: Codes in a landmark.
RUN = 4
#: Rounds in which a class is aligned with one hub of its landmarks (the first recording, then others by hash) before all that is left.
HUB_ROUNDS = 3
#: An alignment links two recordings from this overlap (codes, and share of the shorter) and up to this bit error rate.
MIN_OVERLAP, MIN_SHARE, MAX_ERRORS = 8, 0.5, 0.25

#: (kind, first class, classes, frames) of the sixteen filters, by rule: every kind at four places, wider and taller by turns.
FILTERS = [(i % 4, (3 * i) % (CLASSES - 3), 2 + i % 3, (4, 8, 12, 16)[(i // 4 + i) % 4]) for i in range(16)]


def decode(data: bytes, encoding: str = "u8") -> np.ndarray:
    """Samples in -1..1 from unsigned 8-bit or signed 16-bit little-endian PCM; an odd last byte of the latter is dropped."""
    if encoding == "u8":
        return (np.frombuffer(data, dtype=np.uint8).astype(np.float32) - 128) / 128
    if encoding == "s16le":
        return np.frombuffer(data[: len(data) // 2 * 2], dtype="<i2").astype(np.float32) / 32768
    raise ValueError(f"unknown encoding {encoding}")


def pitch_classes(rate: int = RATE) -> np.ndarray:
    """(bins, 12): which class each spectrum bin adds to; bins outside the range add to none."""
    hertz = np.fft.rfftfreq(FRAME, 1 / rate)
    out = np.zeros((len(hertz), CLASSES), dtype=np.float32)
    used = (hertz >= LOWEST) & (hertz <= HIGHEST)
    note = np.rint(CLASSES * np.log2(np.where(used, hertz, 440.0) / 440.0)).astype(int) % CLASSES
    out[np.arange(len(hertz))[used], note[used]] = 1
    return out


def chroma_frames(signal: np.ndarray, rate: int = RATE) -> np.ndarray:
    """(frames, 12) of unit length, smoothed over five frames; all zero where there is no energy. The signal's mean does not count."""
    count = (len(signal) - FRAME) // HOP + 1
    if count < 1:
        return np.zeros((0, CLASSES), dtype=np.float32)
    shape, strides = (count, FRAME), (signal.strides[0] * HOP, signal.strides[0])
    window, fold = np.hanning(FRAME).astype(np.float32), pitch_classes(rate)
    parts = []
    for at in range(0, count, 8192):
        frames = np.lib.stride_tricks.as_strided(signal[at * HOP :], (min(8192, count - at), FRAME), strides)
        frames = (frames - frames.mean(axis=1, keepdims=True)) * window
        power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
        parts.append(power.astype(np.float32) @ fold)
    image = np.concatenate(parts)
    assert image.shape[0] == shape[0]
    padded = np.pad(image, ((2, 2), (0, 0)), mode="edge")
    weights = (0.25, 0.75, 1.0, 0.75, 0.25)
    image = sum(w * padded[k : k + count] for k, w in enumerate(weights))
    length = np.linalg.norm(image, axis=1, keepdims=True)
    return np.where(length > 1e-9, image / np.maximum(length, 1e-9), 0).astype(np.float32)


def codes_of(image: np.ndarray) -> np.ndarray:
    """One 32-bit code for each run of SPAN frames: two bits of each filter, the first filter's lowest."""
    n = len(image) - SPAN + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint32)
    total = np.zeros((len(image) + 1, CLASSES + 1))
    total[1:, 1:] = image.astype(np.float64).cumsum(axis=0).cumsum(axis=1)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return total[t1 : t1 + n, c1] - total[t0 : t0 + n, c1] - total[t1 : t1 + n, c0] + total[t0 : t0 + n, c0]

    out = np.zeros(n, dtype=np.uint32)
    for i, (kind, c, tall, wide) in enumerate(FILTERS):
        half_t, half_c = wide // 2, max(1, tall // 2)
        whole = area(0, wide, c, c + tall)
        if kind == 0:  # against the classes around
            first, second = whole, area(0, wide, 0, CLASSES) - whole
            second = second * (tall / (CLASSES - tall))
        elif kind == 1:  # lower against upper classes
            first, second = area(0, wide, c, c + half_c), area(0, wide, c + half_c, c + 2 * half_c)
        elif kind == 2:  # earlier against later frames
            first, second = area(0, half_t, c, c + tall), area(half_t, wide, c, c + tall)
        else:  # crossed quarters
            first = area(0, half_t, c, c + half_c) + area(half_t, wide, c + half_c, c + 2 * half_c)
            second = area(half_t, wide, c, c + half_c) + area(0, half_t, c + half_c, c + 2 * half_c)
        level = np.searchsorted(STEPS, np.log((1 + first) / (1 + second))).astype(np.uint32)
        out |= (level ^ (level >> np.uint32(1))) << np.uint32(2 * i)  # Gray code: neighbouring levels differ in one bit
    return out


def fingerprint(data: bytes | None, encoding: str = "u8", rate: int = RATE) -> np.ndarray:
    return codes_of(chroma_frames(decode(data or b"", encoding), rate))


def landmarks(codes: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the recording's distinct runs of ``run`` codes, each at its first place.

    A run of one and the same code is none: silence and steady sound lie against
    each other at any offset, so they say nothing about where recordings match.
    """
    n = len(codes) - run + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, moves = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    for k in range(run):
        part = codes[k : k + n]
        moves |= part != codes[:n]
        h = (h + part.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    values, first = np.unique((h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)[moves], return_index=True)
    return values, np.flatnonzero(moves)[first]


def overlap_errors(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[int, int]:
    """(codes that overlap, bits in which these differ) where b's code i lies against a's code i - offset."""
    low, high = max(0, offset), min(len(b), len(a) + offset)
    if high <= low:
        return 0, 0
    return high - low, int(np.bitwise_count(a[low - offset : high - offset] ^ b[low:high]).sum(dtype=np.int64))


def align(a: np.ndarray, b: np.ndarray, run: int = RUN) -> tuple[int, int, int, int]:
    """(offset, votes, overlap, bit errors): the offset between most shared landmarks, the least of equals; zeros if none is shared.

    This is what ``match_recordings`` computes for pairs from tables.
    """
    marks_a, at_a = landmarks(a, run)
    marks_b, at_b = landmarks(b, run)
    _, i, j = np.intersect1d(marks_a, marks_b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0, 0, 0, 0
    offsets, votes = np.unique(at_b[j] - at_a[i], return_counts=True)
    best = int(np.argmax(votes))
    return int(offsets[best]), int(votes[best]), *overlap_errors(a, b, int(offsets[best]))


def is_match(overlap: int, errors: int, n_a: int, n_b: int) -> bool:
    return overlap >= MIN_OVERLAP and overlap >= MIN_SHARE * min(n_a, n_b) and errors <= MAX_ERRORS * 32 * overlap


_PRINTS = "rec_id bigint, n_codes int, hi bigint, lo bigint, codes array<int>"


def fingerprints(recordings: DataFrame, key: str, audio: Column, encoding: str = "u8", rate: int = RATE) -> DataFrame:
    """(rec_id, n_codes, 128-bit hash of the codes, codes) of every row; null and too short audio has no codes."""

    def run(batches):
        for batch in pieces(batches, rows=1000, size=4 << 20, column="audio"):
            found = [fingerprint(x, encoding, rate) for x in as_bytes(batch.column("audio"))]
            hashes = [xxhash.xxh3_128_intdigest(c.tobytes()) for c in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rec_id"),
                    pa.array([len(c) for c in found], pa.int32()),
                    pa.array([(h >> 64) - (1 << 63) for h in hashes], pa.int64()),
                    pa.array([(h & (1 << 64) - 1) - (1 << 63) for h in hashes], pa.int64()),
                    pa.array([c.view(np.int32) for c in found], pa.list_(pa.int32())),
                ],
                ["rec_id", "n_codes", "hi", "lo", "codes"],
            )

    rows = recordings.select(F.col(key).cast("long").alias("rec_id"), audio.cast("binary").alias("audio"))
    return rows.mapInArrow(run, _PRINTS)


def marked(heads: DataFrame) -> DataFrame:
    """(mark, rec_id, n_codes, pos): the landmarks of every recording."""

    def run(batches):
        for batch in batches:
            codes = batch.column("codes")
            values, ends = np.asarray(codes.flatten()).view(np.uint32), np.asarray(codes.offsets)
            ends = ends - ends[0]
            for at in range(0, batch.num_rows, 500):
                some = range(at, min(at + 500, batch.num_rows))
                found = [landmarks(values[ends[i] : ends[i + 1]]) for i in some]
                counts = np.array([len(m) for m, _ in found])
                ids, sizes = (np.asarray(batch.column(c))[at : at + 500] for c in ("rec_id", "n_codes"))
                arrays = [np.concatenate([m for m, _ in found]), np.repeat(ids, counts), np.repeat(sizes, counts), np.concatenate([p for _, p in found]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["mark", "rec_id", "n_codes", "pos"])

    return heads.select("rec_id", "n_codes", "codes").mapInArrow(run, "mark bigint, rec_id bigint, n_codes int, pos int")


def meeting(pairs: DataFrame, hits: DataFrame) -> DataFrame:
    """(mark, a, n_a, pos_a, b, n_b, pos_b) for every landmark that both recordings of a pair (rec_id, hub) hold, a being the smaller id.

    The recordings' landmarks come first and are then looked up with the hubs, so a hub's are not repeated for each of its pairs.
    """
    hubs = hits.select("mark", *(F.col(c).alias(f"{c}_h") for c in ("rec_id", "pos", "n_codes"))).withColumnRenamed("rec_id_h", "hub")
    met, first = pairs.join(hits, "rec_id").join(hubs, ["hub", "mark"]), F.col("rec_id") < F.col("hub")
    both = {"": ("rec_id", "hub"), "n_": ("n_codes", "n_codes_h"), "pos_": ("pos", "pos_h")}
    ends = [F.when(first, F.col(one)).otherwise(F.col(other)).alias(name + "a") for name, (one, other) in both.items()]
    return met.select("mark", *ends, *[F.when(first, F.col(other)).otherwise(F.col(one)).alias(name + "b") for name, (one, other) in both.items()])


def voted(met: DataFrame) -> DataFrame:
    """(a, b, offset, votes, overlap) of each pair's best offset, from all landmarks at which they meet; pairs that cannot overlap enough go."""
    counts = met.groupBy("a", "b", "n_a", "n_b", (F.col("pos_b") - F.col("pos_a")).alias("offset")).agg(F.count("*").alias("votes"))
    best = counts.groupBy("a", "b", "n_a", "n_b").agg(F.max(F.struct("votes", (-F.col("offset")).alias("m"))).alias("s"))
    best = best.select("a", "b", "n_a", "n_b", (-F.col("s.m")).cast("int").alias("offset"), F.col("s.votes").cast("int").alias("votes"))
    overlap = F.least(F.col("n_b"), F.col("n_a") + F.col("offset")) - F.greatest(F.lit(0), F.col("offset"))
    # the offset tells the overlap, so pairs with too little of it need no codes
    return best.withColumn("overlap", overlap).where((F.col("overlap") >= MIN_OVERLAP) & (F.col("overlap") >= MIN_SHARE * F.least("n_a", "n_b")))


def matching(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """(a, b, offset, votes, overlap, bit_errors) of the pairs whose codes differ in few enough bits at their offset."""

    def run(batches):
        for batch in batches:
            codes = [[np.array(v, dtype=np.int32).view(np.uint32) for v in batch.column(c).to_pylist()] for c in "xy"]
            errors = [overlap_errors(x, y, o)[1] for x, y, o in zip(*codes, batch.column("offset").to_pylist(), strict=True)]
            keep = pa.array([e <= MAX_ERRORS * 32 * n for e, n in zip(errors, batch.column("overlap").to_pylist(), strict=True)], pa.bool_())
            kept = [*(batch.column(c) for c in ("a", "b", "offset", "votes", "overlap")), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(kept, ["a", "b", "offset", "votes", "overlap", "bit_errors"]).filter(keep)

    # repeated rows of a recording are the same to the bit, so the first to come will do
    ids = pairs.select(F.col("a").alias("rec_id")).unionByName(pairs.select(F.col("b").alias("rec_id"))).distinct()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    needed = heads.join(F.broadcast(ids) if few else ids, "rec_id", "left_semi").select("rec_id", "codes").dropDuplicates(["rec_id"])
    a, b = (needed.select(F.col("rec_id").alias(end), F.col("codes").alias(side)) for end, side in ("ax", "by"))
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "offset", "votes", "overlap", "x", "y")
    return rows.mapInArrow(run, "a bigint, b bigint, offset int, votes int, overlap int, bit_errors bigint")


def match_recordings(recordings: DataFrame, key: str, audio: Column, encoding: str = "u8", rate: int = RATE) -> DataFrame:
    """One row for each distinct id: n_codes, component_id, and the best alignment (ref_id, offset, votes, overlap, bit_errors).

    Recordings are linked if they share a landmark (RUN equal codes in a row, not
    all the same) and, at the offset between most of their shared landmarks,
    enough codes overlap and few enough bits differ. Components are those of
    all such links, found without comparing pairs that are connected already:
    recordings with equal codes form a class, whose least id stands for it; each
    class is aligned with a hub of the landmarks that they share, one a round, and
    then, where components still differ, with every class that it shares a
    landmark with. The reference is the linked recording with a smaller
    id, among those it was aligned with, that has most votes (the least id of
    equals; null if none). Recordings without codes (null, empty or shorter
    than a code's frames) are linked with nothing. Rows that share an id count
    as one, the one with the least hash; rows without an id are left as they
    are, with null component. Other columns are not read; an empty table gives
    an empty result.
    """
    scratch = Scratch(recordings.sparkSession, "chroma")
    prints = scratch.keep(fingerprints(recordings, key, audio, encoding, rate))
    ids = scratch.keep(prints.where("rec_id is not null").groupBy("rec_id").agg(F.min(F.struct("hi", "lo", "n_codes")).alias("p")).select("rec_id", "p.*"))
    classes = scratch.keep(ids.where("n_codes > 0").groupBy("hi", "lo", "n_codes").agg(F.min("rec_id").alias("root")))
    # most recordings stand for themselves, so it is the others that are listed: the codes then need no shuffle to be sifted
    others = prints.where("rec_id is not null and n_codes > 0").select("rec_id", "hi", "lo").distinct()
    others = scratch.keep(others.join(classes.select(F.col("root").alias("rec_id"), "hi", "lo"), ["rec_id", "hi", "lo"], "left_anti"))
    few = others.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    heads = prints.where("rec_id is not null and n_codes > 0").join(F.broadcast(others) if few else others, ["rec_id", "hi", "lo"], "left_anti")
    marks = marked(heads)
    first = scratch.keep(marks.groupBy("mark").agg(F.min("rec_id").alias("least"), F.max("rec_id").alias("most")).where("least < most").select("mark"))
    small = first.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    hits = marks.join(F.broadcast(first) if small else first, "mark").groupBy("mark", "rec_id").agg(F.min("pos").alias("pos"), F.min("n_codes").alias("n_codes"))
    hits = scratch.keep(hits)
    # each class with one hub a round, the one of most of its marks, where they are not connected yet
    links, label, tested = None, None, None
    for turn in range(HUB_ROUNDS):
        placed = hits if label is None else parted(hits, label)
        order = F.struct("rec_id") if turn == 0 else F.struct(F.xxhash64("rec_id", F.lit(turn)), "rec_id")
        elected = placed.groupBy("mark").agg(F.min_by(F.struct("rec_id", "part") if label is not None else F.struct("rec_id", F.col("rec_id").alias("part")), order).alias("hub"))
        # written down, so that the join deals its rows anew and a landmark that many hold can be split
        elected = scratch.keep(elected)
        met = placed.join(elected, "mark").where(F.col("rec_id") != F.col("hub.rec_id"))
        if label is not None:
            met = met.where(F.col("part") != F.col("hub.part"))
        counts = met.groupBy(F.col("hub.rec_id").alias("hub"), "rec_id").agg(F.count("*").alias("shared"))
        chosen = counts.groupBy("rec_id").agg(F.max(F.struct("shared", (-F.col("hub")).alias("m"))).alias("s")).select("rec_id", (-F.col("s.m")).alias("hub"))
        # of two that chose each other one pair is enough
        pairs = chosen.withColumns({"a": F.least("rec_id", "hub"), "b": F.greatest("rec_id", "hub")}).groupBy("a", "b").agg(F.min("rec_id").alias("rec_id"), F.min_by("hub", "rec_id").alias("hub"))
        pairs = scratch.keep(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        found = matching(scratch.keep(voted(meeting(pairs.select("rec_id", "hub"), hits))), heads)
        links = scratch.keep(found if links is None else links.unionByName(found))
        label = components(links, label="chroma-round")
    # then what still shares a mark across components
    placed = parted(hits, label)
    mixed = placed.groupBy("mark").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most").select("mark")
    mixed = scratch.keep(mixed)
    placed = scratch.keep(placed.join(mixed, "mark", "left_semi"))
    x, y = (placed.select("mark", *(F.col(c).alias(d) for c, d in (("rec_id", e), ("pos", f"pos_{e}"), ("n_codes", f"n_{e}"), ("part", f"part_{e}")))) for e in "ab")
    meet = x.join(y, "mark").where("a < b and part_a != part_b").drop("part_a", "part_b")
    across = voted(meet).join(tested, ["a", "b"], "left_anti")
    links = scratch.keep(links.unionByName(matching(scratch.keep(across), heads)))
    best = links.groupBy("b").agg(F.max(F.struct("votes", (-F.col("a")).alias("m"), "offset", "overlap", "bit_errors")).alias("s"))
    best = best.select(F.col("b").alias("root"), (-F.col("s.m")).alias("ref_id"), "s.offset", "s.votes", "s.overlap", "s.bit_errors")
    roots = components(links, label="chroma-components").withColumnRenamed("id", "root")
    members = ids.join(classes, ["hi", "lo", "n_codes"], "left").join(best, "root", "left").join(roots, "root", "left")
    none = F.lit(None)
    lonely = prints.where("rec_id is null").select(
        "rec_id", "n_codes", none.cast("long").alias("component_id"), none.cast("long").alias("ref_id"), *[none.cast("int").alias(c) for c in ("offset", "votes", "overlap")], none.cast("long").alias("bit_errors")
    )
    return members.select("rec_id", "n_codes", F.coalesce("component", "root", "rec_id").alias("component_id"), "ref_id", "offset", "votes", "overlap", "bit_errors").unionByName(lonely)


def parted(hits: DataFrame, label: DataFrame) -> DataFrame:
    """hits with each recording's component so far."""
    return hits.join(label.select(F.col("id").alias("rec_id"), "component"), "rec_id", "left").withColumn("part", F.coalesce("component", "rec_id")).drop("component")


def query(docs: DataFrame) -> DataFrame:
    """The tables hold no sound, so every document's UTF-8 bytes are heard as 8-bit PCM."""
    return match_recordings(docs.select("doc_id", "text"), "doc_id", F.col("text")).withColumnRenamed("rec_id", "doc_id")
