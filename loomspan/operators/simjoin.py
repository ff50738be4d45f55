"""Similarity joins of short texts by their insert-delete ratio, without comparing all texts that share a word.

A ratio of so many percent bounds the characters that are not matched: in two
texts of together T characters at most D = (100 - percent) * T / 100 of them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import similarity
from loomspan.plans.scratch import Scratch

#: Segments that more texts than this have at the same place are frequent.
FREQUENT = 64
#: Into how many pieces a text's segments are cut when some of them are frequent, to choose the rarest.
FINER = 4
#: Texts of a block that one task compares with so many others at most.
TILE = 1024


def bag(text: Column) -> Column:
    """How often a text's characters fall into 16 classes, each count modulo 16, in the bits of one long."""

    def add(counts: Column, c: Column) -> Column:
        place = (F.pmod(F.xxhash64(c), F.lit(16)) * 4).cast("int")

        def moved(value: Column) -> Column:
            return F.call_function("shiftleft", value, place)

        # the class's own count goes up by itself: the highest one would carry out of the long
        own = (F.call_function("shiftrightunsigned", counts, place).bitwiseAND(F.lit(15)) + 1).bitwiseAND(F.lit(15).cast("long"))
        return F.when(c == "", counts).otherwise(counts.bitwiseAND(F.bitwise_not(moved(F.lit(15).cast("long")))).bitwiseOR(moved(own)))

    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), add)


def bags_apart(a: Column, b: Column) -> Column:
    """Characters that two texts surely do not share, from their bags: never more than their insert-delete distance."""

    def part(k: int) -> Column:
        apart = F.pmod(F.shiftrightunsigned(a, 4 * k).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(b, 4 * k).bitwiseAND(F.lit(15)), F.lit(16))
        return F.least(apart, 16 - apart)

    return reduce(lambda x, y: x + y, [part(k) for k in range(16)])


def room(total: Column, percent: int) -> Column:
    """The largest insert-delete distance with which two texts of together so many characters reach the percentage."""
    return F.floor(total * (100 - percent) / 100)


def _cut(rows: DataFrame, size: str, finer: int, percent: int) -> DataFrame:
    """rows with i, from and length of each segment of a text of ``size`` characters: evenly, finer times one more than its edits can touch.

    How many there are depends on the size alone, with the longest partner that a
    text of that size can have.
    """
    n = F.col(size)
    most = room(n + F.floor(n * (200 - percent) / percent), percent)
    parted = rows.withColumn("parts", F.least((most + 1) * finer, n)).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    begin, end = (F.floor((F.col("i") + k) * n / F.col("parts")) for k in (0, 1))
    return parted.withColumns({"need": most + 1, "from": begin, "length": end - begin})


def _segments(names: DataFrame, finer: int, percent: int) -> DataFrame:
    """(sign, id, n, bag, need): a row for each segment of a text, under a hash of its size, number and characters."""
    rows = _cut(names, "n", finer, percent)
    sign = F.xxhash64(F.lit(finer), "n", "i", F.substr("text", F.col("from") + 1, F.col("length")))
    return rows.select(sign.alias("sign"), "id", "n", "bag", "need")


def _probes(names: DataFrame, finer: int, percent: int, sizes: DataFrame | None = None) -> DataFrame:
    """(sign, id, n, bag): the signs that a text would share with a text no longer than itself, if one of that text's segments is whole in it.

    Of the D unmatched characters at most (D - difference) / 2 are the shorter
    text's and (D + difference) / 2 the longer one's, so a whole segment stands
    that far to the left or right of its own place, at most.
    """
    rows = names.withColumn("short", F.explode(F.sequence(F.ceil(F.col("n") * percent / (200 - percent)), F.col("n").cast("long"))))
    if sizes is not None:
        rows = rows.join(F.broadcast(sizes), "short")
    rows = _cut(rows, "short", finer, percent)
    edits, more = room(F.col("short") + F.col("n"), percent), F.col("n") - F.col("short")
    low = F.greatest(-F.floor((edits - more) / 2), -F.col("from"))
    high = F.least(F.floor((edits + more) / 2), F.col("n") - F.col("length") - F.col("from"))
    rows = rows.where(edits >= more).withColumns({"low": low, "high": high}).where("low <= high")
    rows = rows.withColumn("shift", F.explode(F.sequence("low", "high")))
    sign = F.xxhash64(F.lit(finer), "short", "i", F.substr("text", F.col("from") + F.col("shift") + 1, F.col("length")))
    return rows.select(sign.alias("sign"), "id", "n", "bag", "short")


def segment_join(names: DataFrame, percent: int, frequent: int = FREQUENT, finer: int = FINER) -> DataFrame:
    """(a, b, text_a, text_b): all pairs of different ids, a below b, whose texts reach the percentage (90 to 100). names: (id long, text string).

    Of a text cut into one segment more than its edits can touch, one segment
    stands whole in any partner, near its place. So the shorter text's segments
    are joined with the longer one's characters at those places, by an equality
    of hashes; then bags, and at last the ratio itself, decide. A text with a
    frequent segment is cut finer, and of the smaller segments only the rarest
    ones are joined, one more than its edits can touch: what many texts have in
    common stays out of the join as long as enough of the rest is rare. Texts
    that are equal but for a few places in what is left are candidates of one another.

    Work grows with the texts times their edits (a text of 60 characters has
    some 20 signs, one of 300 some thousand). Null, empty and repeated ids: texts
    that are null or empty have no partner; of rows that share an id the least text counts.
    """
    if not 90 <= percent <= 100:
        raise ValueError("segments need a percentage from 90 to 100")
    scratch = Scratch(names.sparkSession, "segments")
    held = names.where("id is not null and text != ''").groupBy("id").agg(F.min("text").alias("text"))
    ready = scratch.keep(held.select("id", "text", F.length("text").cast("long").alias("n"), bag(F.col("text")).alias("bag")))
    segments = scratch.keep(_segments(ready, 1, percent))
    hot = segments.groupBy("sign").agg(F.count("*").alias("texts")).where(F.col("texts") > frequent).select("sign")
    crowded = scratch.keep(segments.join(hot, "sign", "left_semi").select("id").distinct())
    index = segments.join(crowded, "id", "left_anti").drop("need")
    pairs = _met(index, _probes(ready, 1, percent), percent)
    if not crowded.isEmpty():
        small = scratch.keep(_segments(ready.join(crowded, "id", "left_semi"), finer, percent))
        often = small.groupBy("sign").agg(F.count("*").alias("texts"))
        chosen = small.join(often, "sign").groupBy("id", "n", "bag", "need").agg(F.array_sort(F.collect_list(F.struct("texts", "sign"))).alias("signs"))
        rarest = chosen.select("id", "n", "bag", F.explode(F.slice("signs", F.lit(1), F.col("need").cast("int"))).alias("s")).select("s.sign", "id", "n", "bag")
        sizes = small.select(F.col("n").alias("short")).distinct()
        pairs = pairs.unionByName(_met(rarest, _probes(ready, finer, percent, sizes), percent))
    found = scratch.keep(pairs.distinct())
    a, b = (ready.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    scored = found.join(a, "a").join(b, "b").where(similarity.ratio(F.col("text_a"), F.col("text_b")) >= percent)
    return scored.select("a", "b", "text_a", "text_b")


def _met(index: DataFrame, probes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of shorter and longer texts that share a sign and whose bags are near enough; of equally long texts each pair once."""
    short = index.select("sign", F.col("id").alias("x"), F.col("n").alias("size"), F.col("bag").alias("bag_x"))
    joined = short.join(probes, "sign").where((F.col("size") == F.col("short")) & ((F.col("size") < F.col("n")) | (F.col("x") < F.col("id"))))
    near = joined.where(bags_apart(F.col("bag_x"), F.col("bag")) <= room(F.col("size") + F.col("n"), percent))
    return near.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b"))


class Alphabet:
    """Texts as bits: for each text and character the places at which the text has it, in words of 64 bits."""

    def __init__(self, texts: list[str]):
        self.sizes = np.array([len(t) for t in texts])
        self.number = {c: i for i, c in enumerate(sorted(set("".join(texts))))}
        self.words = max(1, -(-int(self.sizes.max(initial=1)) // 64))
        self.places = np.zeros((len(self.number) + 1, self.words, len(texts)), dtype=np.uint64)
        for k, text in enumerate(texts):
            bits: dict[str, int] = {}
            for at, c in enumerate(text):
                bits[c] = bits.get(c, 0) | 1 << at
            for c, mask in bits.items():
                for w in range(self.words):
                    self.places[self.number[c], w, k] = mask >> 64 * w & 0xFFFFFFFFFFFFFFFF

    def common(self, text: str, chosen: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of the text and each chosen one: a row of the dynamic program at a time, in bits (Hyyrö, 2004)."""
        rows = [np.full(len(chosen), np.iinfo(np.uint64).max, dtype=np.uint64) for _ in range(self.words)]
        for c in text:
            n = self.number.get(c)
            if n is None:
                continue
            carry = None
            for w in range(self.words):
                held = rows[w]
                met = held & self.places[n, w][chosen]
                total = held + met
                over = total < held
                if carry is not None:
                    total += carry
                    over |= total < carry
                rows[w] = total | (held - met)
                carry = over.astype(np.uint64)
        return sum(64 - np.bitwise_count(r).astype(np.int64) for r in rows)


def _alike(percent: int):
    """For applyInArrow over the rows (block, tile, id, text) of one group: (a, b) of the pairs of a block whose texts reach the percentage.

    Rows of one tile are compared with each other; of two tiles each row with those of the other one.
    """

    def run(table: pa.Table) -> pa.Table:
        block, tile, ids = (table.column(c).to_numpy() for c in ("block", "tile", "id"))
        texts = table.column("text").to_pylist()
        order = np.lexsort((ids, tile, block))
        edges = np.flatnonzero(np.diff(block[order])) + 1
        left, right = [], []
        for rows in np.split(order, edges):
            tiles = np.unique(tile[rows])
            ones = rows[tile[rows] == tiles[0]] if len(tiles) > 1 else rows
            others = rows[tile[rows] == tiles[1]] if len(tiles) > 1 else rows
            held = Alphabet([texts[i] for i in others])
            for k, i in enumerate(ones):
                size = len(texts[i])
                may = 200 * np.minimum(held.sizes, size) >= percent * (held.sizes + size)
                if len(tiles) == 1:
                    may[: k + 1] = False
                chosen = np.flatnonzero(may)
                if len(chosen):
                    good = chosen[200 * held.common(texts[i], chosen) >= percent * (held.sizes[chosen] + size)]
                    left.append(np.full(len(good), ids[i]))
                    right.append(ids[others[good]])
        a, b = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in (left, right))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def block_join(names: DataFrame, blocks: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """(a, b): pairs, a below b, that share a block and whose texts reach the percentage (50 to 100). names: (id long, text string); blocks: (id, block).

    A block of more than ``tile`` texts is cut into tiles, by a hash of the ids,
    and each two tiles are compared by one task, so no task holds more than two
    tiles however large a block is; small blocks are taken together. Nothing but
    matches leaves a task. Lengths rule pairs out, then a few operations on words
    of 64 bits for each character give the ratio of a text with all others at once.
    At 75 % a third of the characters may differ, in any places: no signature
    is sure to be shared, so texts of a block are compared each with each, and
    work grows with the square of a block.

    Texts that are null or empty and null ids have no partner; of rows that share an id the least text counts.
    """
    scratch = Scratch(names.sparkSession, "blocks")
    held = names.where("id is not null and text != ''").groupBy("id").agg(F.min("text").alias("text"))
    keyed = blocks.where("id is not null and block is not null").select("id", F.xxhash64("block").alias("block")).distinct()
    members = scratch.keep(keyed.join(held, "id"))
    sizes = members.groupBy("block").agg(F.count("*").alias("members")).where("members > 1")
    rows = scratch.keep(members.join(sizes, "block"))
    small = rows.where(F.col("members") <= tile)
    groups = max(1, small.count() // (4 * tile))
    alone = small.select(F.lit(-1).cast("long").alias("p"), F.pmod("block", F.lit(groups)).alias("q"), F.lit(0).cast("long").alias("of"), "block", F.lit(0).cast("long").alias("tile"), "id", "text")
    cut = F.ceil(F.col("members") / tile)
    tiled = rows.where(F.col("members") > tile).withColumn("tile", F.pmod(F.xxhash64("id"), cut)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)))
    pairs = tiled.select(F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), F.col("block").alias("of"), "block", "tile", "id", "text")
    found = alone.unionByName(pairs).groupBy("p", "q", "of").applyInArrow(_group(_alike(percent)), "a bigint, b bigint")
    return scratch.keep(found.distinct())


def _group(run):
    """The function without the grouping columns."""
    return lambda table: run(table.select(["block", "tile", "id", "text"]))
