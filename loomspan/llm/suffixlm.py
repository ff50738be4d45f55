"""Language-model scores from a probabilistic suffix tree (Ron, Singer and Tishby, 1996).

Tokens are words and one end for each text. The tree's states are contexts of up
to ``depth`` preceding symbols, a symbol being a word that is frequent enough, the
text's start, or one of a few classes that hold all other words by their last
letters. A context becomes a state when it is frequent enough and its next-symbol
distribution diverges from that of its longest proper suffix, or when it is the
suffix of a state. A token is scored in the state of the longest suffix of what
precedes it. Distributions are smoothed towards the suffix's by absolute
discounting, down to the root, whose distribution is add-one over all training
tokens; a word of a class gets the class's probability times its share of the
root's mass for that class.

Contexts and continuations are counted level by level in distributed tables, down
to fixed counts whatever the corpus, so the tree grows with it. A state's smoothed
probability is its suffix's times a factor: the log of a text's probability is the
root's plus the logs of these factors over all stored (context, next symbol) pairs
that the text holds. The most frequent of them are sent to all tasks, up to a
bound; the text's others are found by a join. Contexts are numbered and held by all
tasks as long as there are not too many of them; beyond that the same tree is
learned with contexts in tables, under hashes, and joins (``learn_spread``).
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import as_bytes, id_residue, pieces
from loomspan.llm.shingles import mix64, word_spans
from loomspan.plans.scratch import Scratch


class Settings(NamedTuple):
    """What the tree keeps, and what tasks may hold of it."""

    #: Longest context.
    depth: int = 4
    #: Least count of a word that is a symbol of its own, of a context, and of a stored (context, next symbol) pair.
    min_symbol: int = 1024
    min_context: int = 256
    min_pair: int = 16
    #: Least divergence, in nats, of a context's distribution from its suffix's.
    min_divergence: float = 0.01
    #: Discount of every stored count, given to the suffix's distribution.
    discount: float = 0.75
    #: Symbols, and contexts of a length, that tasks hold at most; with more of them contexts stay in tables, and symbols beyond are joined.
    max_symbols: int = 1 << 22
    max_contexts: int = 1 << 22
    #: Pairs that tasks hold at most, the most frequent ones; the others are joined.
    held_pairs: int = 1 << 22
    #: Least share of a token whose count tasks hold (at most 1 / known_share tokens); the others are joined.
    known_share: float = 5e-7
    #: Bits, as a power of two, of the filter that tells most absent pairs from joined ones.
    filter_bits: int = 28


DEFAULTS = Settings()
#: Classes of the words that are not symbols themselves.
CLASSES = 64
#: Symbol numbers: the text's start, its end, the classes from 2, the frequent words from FIRST.
START, END = 0, 1
FIRST = 2 + CLASSES
#: A pair is packed as context number << BITS | symbol, under its length << LEVEL_BITS.
BITS, LEVEL_BITS = 24, 60
_MASK = (1 << BITS) - 1
#: Hashes that stand for the start and the end; words have 64-bit hashes too.
_START_HASH, _END_HASH = (int(x) for x in mix64(np.array([11, 13], dtype=np.uint64)).view(np.int64))
#: Bytes of text that are laid out at once: small enough for the arrays to stay in cache.
CHUNK = 1 << 18


class Laid(NamedTuple):
    """Texts one after the other, each with its start before and its end behind its words."""

    hashes: np.ndarray  # of each token, as signed 64-bit integers
    classes: np.ndarray  # class of each token, should it be no symbol
    place: np.ndarray  # in its text, 0 for the start
    first: np.ndarray  # index of each text's start


def lay(texts: list[bytes]) -> Laid:
    hashes, first_word, data, starts, stops = word_spans(texts)
    low = data | (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    ends = stops.copy()
    for _ in range(4):  # closing stops and commas do not count for the class
        closing = (ends > starts) & np.isin(low[ends - 1], (44, 46))
        if not closing.any():
            break
        ends -= closing
    last = np.where(ends > starts, low[ends - 1], 0).astype(np.uint64)
    before = np.where(ends > starts + 1, low[ends - 2], 0).astype(np.uint64)
    kinds = (mix64(before << np.uint64(8) | last) % np.uint64(CLASSES)).astype(np.int64) + 2
    counts = np.diff(first_word)
    n = len(hashes) + 2 * len(counts)
    stop = np.cumsum(counts + 2) - 1
    first = stop - counts - 1
    words = np.ones(n, dtype=bool)
    words[first] = words[stop] = False
    out, classes = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    out[words], classes[words] = hashes.view(np.int64), kinds
    out[first], out[stop], classes[first], classes[stop] = _START_HASH, _END_HASH, START, END
    return Laid(out, classes, np.arange(n) - np.repeat(first, counts + 2), first)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in the sorted keys, -1 where it is absent."""
    if not len(keys) or not len(wanted):
        return np.full(len(wanted), -1, dtype=np.int64)
    order = np.argsort(wanted)
    sought = wanted[order]
    at = np.searchsorted(keys, sought)
    at[at == len(keys)] = 0
    out = np.empty(len(wanted), dtype=np.int64)
    out[order] = np.where(keys[at] == sought, at, -1)
    return out


def maybe(filter_: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter does not rule out."""
    slot = slots_of(keys, bits)
    return (filter_[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def symbols_of(laid: Laid, symbols: np.ndarray) -> np.ndarray:
    at = find(symbols, laid.hashes)
    return np.where((at >= 0) & (laid.classes >= 2), at + FIRST, laid.classes)


def pairs_at(symbols: np.ndarray, place: np.ndarray, frequent: list[np.ndarray], depth: int):
    """For each length from 1: (places, context numbers, packed pairs of context and symbol) wherever the context has a number.

    A context of one symbol has the symbol's number, a longer one the index of
    its packed pair among the frequent ones of the length below.
    """
    context = np.empty(len(symbols), dtype=np.int64)
    context[1:] = symbols[:-1]
    context[place == 0] = -1
    for d in range(1, depth + 1):
        at = np.flatnonzero(context >= 0)
        pairs = context[at] << BITS | symbols[at]
        yield at, context[at], pairs
        if d > len(frequent) or d == depth:
            return
        numbers = np.full(len(symbols) + 1, -1, dtype=np.int64)
        numbers[at + 1] = find(frequent[d - 1], pairs)
        context = numbers[:-1]
        context[place == 0] = -1


def _chunks(batches):
    for batch in pieces(batches, rows=4000, size=CHUNK):
        yield batch, lay(as_bytes(batch.column("text")))


def _rows(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("binary").alias("text"))


def _arrays(names: str, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names.split())


def count_tokens(train: DataFrame) -> DataFrame:
    """(h, k, c): hash, class and count of each distinct token of all training texts."""

    def run(batches):
        held: list[Laid] = []

        def out():
            h, k = (np.concatenate([getattr(x, c)[x.place > 0] for x in held]) for c in ("hashes", "classes"))
            values, at, counts = np.unique(h, return_index=True, return_counts=True)
            return _arrays("h k c", values, k[at], counts.astype(np.int64))

        for _, laid in _chunks(batches):
            held.append(laid)
            if sum(len(x.place) for x in held) > 3_000_000:
                yield out()
                held = []
        if held:
            yield out()

    return _rows(train).mapInArrow(run, "h bigint, k bigint, c bigint").groupBy("h").agg(F.max("k").alias("k"), F.sum("c").alias("c"))


def count_pairs(train: DataFrame, symbols: np.ndarray, totals: np.ndarray, frequent: list[np.ndarray], least: int, beyond: bool = False) -> DataFrame:
    """(pair, symbol, n) over all training texts: pairs of the length after those given as frequent, for contexts that occur often enough.

    symbol is -1 in the pairs' own counts. With ``beyond`` there are also the
    counts of every pair with each symbol that follows it: what is a context of
    the next length is known when these are added up, so a pass is saved.
    """
    shared = train.sparkSession.sparkContext.broadcast((symbols, totals, frequent))
    level = len(frequent) + 1

    def run(batches):
        symbols, totals, frequent = shared.value
        held: list[np.ndarray] = []
        following: list[np.ndarray] = []

        def out():
            pairs, at, counts = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            yield _arrays("pair symbol n", pairs, np.full(len(pairs), -1, np.int32), counts.astype(np.int64))
            if beyond:
                after = np.concatenate(following)
                both, counts = np.unique((at << BITS | after)[after >= 0], return_counts=True)
                yield _arrays("pair symbol n", pairs[both >> BITS], (both & _MASK).astype(np.int32), counts.astype(np.int64))

        for _, laid in _chunks(batches):
            found = symbols_of(laid, symbols)
            for d, (at, context, pairs) in enumerate(pairs_at(found, laid.place, frequent, level), start=1):
                if d < level:
                    continue
                if level == 1:
                    keep = totals[context] >= least
                    at, pairs = at[keep], pairs[keep]
                held.append(pairs)
                if beyond:
                    inside = np.append(laid.place[1:] > 0, False)[at]
                    following.append(np.where(inside, np.append(found[1:], 0)[at], -1))
            if sum(map(len, held)) > 4_000_000:
                yield from out()
                held.clear()
                following.clear()
        if held:
            yield from out()

    return _rows(train).mapInArrow(run, "pair bigint, symbol int, n bigint").groupBy("pair", "symbol").agg(F.sum("n").alias("n"))


def numbered(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(pair, n) of the next length from (pair, symbol, n), for the pairs among the frequent ones, which are contexts now."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for batch in batches:
            pair, symbol, n = (np.asarray(batch.column(c)) for c in ("pair", "symbol", "n"))
            context = find(shared.value, pair)
            keep = context >= 0
            yield _arrays("pair n", context[keep] << BITS | symbol[keep], n[keep])

    return rows.mapInArrow(run, "pair bigint, n bigint")


def fitting(table: DataFrame, column: str, least: int, most: int) -> int:
    """The least of least, 2 least, 4 least... with at most ``most`` rows of a positive column from there on."""
    steps = range(48)
    found = table.agg(*[F.count(F.when(F.col(column) >= (least << i), 1)).alias(f"c{i}") for i in steps]).first()
    return least << next(i for i in steps if found[f"c{i}"] <= most)


def collected(table: DataFrame, key: str, *more: str) -> list[np.ndarray]:
    """The columns as arrays, in the order of the first; the caller bounds the rows."""
    found = table.select(key, *more).toArrow()
    arrays = [found.column(c).to_numpy() for c in (key, *more)]
    order = np.argsort(arrays[0])
    return [x[order] for x in arrays]


class Level(NamedTuple):
    """The pairs of one length that tasks look up: sorted, with the log10 factor of those held and the number of those that are contexts."""

    pairs: np.ndarray
    is_held: np.ndarray
    factors: np.ndarray
    numbers: np.ndarray  # -1 where the pair is no context
    is_state: np.ndarray  # by context number
    rests: np.ndarray  # log10 of a state's share for symbols that it does not store, 0 where the context is no state


def level_of(held: np.ndarray, factors: np.ndarray, frequent: np.ndarray, is_state: np.ndarray, rests: np.ndarray) -> Level:
    pairs = np.union1d(held, frequent)
    out = Level(pairs, np.zeros(len(pairs), dtype=bool), np.zeros(len(pairs)), np.full(len(pairs), -1, dtype=np.int64), is_state, rests)
    at = np.searchsorted(pairs, held)
    out.is_held[at], out.factors[at] = True, factors
    out.numbers[np.searchsorted(pairs, frequent)] = np.arange(len(frequent))
    return out


class Tree(NamedTuple):
    """What tasks hold: the symbols, the levels, and the filter of the pairs that they do not hold (None if they hold all)."""

    symbols: np.ndarray
    levels: list[Level]
    filter: np.ndarray | None
    bits: int

    def score(self, laid: Laid, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 of every token's probability over the root's, as far as held; places and packed pairs that may be in the joined table). more is empty: all symbols are held."""
        out = np.zeros(len(laid.place))
        places, open_ = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        symbols = symbols_of(laid, self.symbols)
        numbers = np.append(-1, symbols)  # of each token as the end of a context, one place on
        for d, level in enumerate(self.levels, start=1):
            context = numbers[:-1]
            at = np.flatnonzero((context >= 0) & (laid.place > 0))
            context = context[at]
            pairs = context << BITS | symbols[at]
            found = find(level.pairs, pairs)
            known = found >= 0
            hit = known & level.is_held[found] if len(level.pairs) else known
            out[at] += level.rests[context]
            out[at[hit]] += level.factors[found[hit]]
            if self.filter is not None:
                rest = level.is_state[context] & ~hit
                missed, tagged = at[rest], pairs[rest] | (d << LEVEL_BITS)
                may = maybe(self.filter, self.bits, tagged)
                places.append(missed[may])
                open_.append(tagged[may])
            numbers = np.full(len(symbols) + 1, -1, dtype=np.int64)
            numbers[at[known] + 1] = level.numbers[found[known]]
        return out, np.concatenate(places), np.concatenate(open_)


def slots_of(pairs: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(pairs.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def filter_of(tail: DataFrame, rows: int, most: int) -> tuple[np.ndarray, int]:
    """A bitmap of at most 2**most bits with a one for each pair of the table, and its bits as a power of two."""
    bits = max(6, min(most, math.ceil(math.log2(max(1, rows) * 8))))

    def run(batches):
        for batch in batches:
            slot = slots_of(np.asarray(batch.column("pair")), bits)
            words, at = np.unique(slot >> 6, return_inverse=True)
            ones = np.zeros(len(words), dtype=np.uint64)
            np.bitwise_or.at(ones, at, np.uint64(1) << (slot & 63).astype(np.uint64))
            yield _arrays("word ones", words, ones.view(np.int64))

    found = tail.select("pair").mapInArrow(run, "word bigint, ones bigint").groupBy("word").agg(F.bit_or("ones").alias("ones"))
    words, ones = collected(found, "word", "ones")
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words] = ones.view(np.uint64)
    return out, bits


def dressed(table: DataFrame, totals: np.ndarray, suffix: np.ndarray | None, above: np.ndarray, state: np.ndarray | None = None, rests: np.ndarray | None = None) -> DataFrame:
    """(pair, context, n, total, suffix_pair, above, rest) for each (pair, n), of states only if these are given.

    suffix_pair is the pair's own suffix; ``above`` is, for one-symbol contexts
    (suffix None), the root's probability of the symbol, else the suffix's total.
    """
    shared = table.sparkSession.sparkContext.broadcast((totals, suffix, above, state, rests))

    def run(batches):
        totals, suffix, above, state, rests = shared.value
        for batch in batches:
            pair, n = (np.asarray(batch.column(c)) for c in ("pair", "n"))
            context, symbol = pair >> BITS, pair & _MASK
            keep = state[context] if state is not None else totals[context] > 0
            pair, n, context, symbol = pair[keep], n[keep], context[keep], symbol[keep]
            up = suffix[context] if suffix is not None else np.zeros(len(pair), np.int64)
            over = above[up].astype(np.float64) if suffix is not None else above[symbol]
            rest = rests[context] if rests is not None else np.zeros(len(pair))
            yield _arrays("pair context n total suffix_pair above rest", pair, context, n, totals[context], up << BITS | symbol, over, rest)

    return table.mapInArrow(run, "pair bigint, context bigint, n bigint, total bigint, suffix_pair bigint, above double, rest double")


def diverging(rows: DataFrame, least: float) -> DataFrame:
    """(context) of the contexts whose distribution diverges enough from their suffix's, from rows (context, n, total, q).

    The Kullback-Leibler divergence is over the stored next symbols and one that
    stands for all others, less what a sample of the suffix's own
    distribution would show: about the number of symbols / (2 * total).
    """
    p = F.col("n") / F.col("total")
    found = rows.groupBy("context").agg(F.max("total").alias("total"), F.count("*").alias("k"), F.sum(p).alias("p"), F.sum("q").alias("q"), F.sum(p * F.ln(p / F.col("q"))).alias("kl"))
    none = F.lit(1e-12)
    left, left_above = F.greatest(1 - F.col("p"), none), F.greatest(1 - F.col("q"), none)
    kl = F.col("kl") + F.when(F.col("p") < 1 - 1e-9, left * F.ln(left / left_above)).otherwise(0.0)
    return found.where(kl - F.col("k") / (2 * F.col("total")) >= least).select("context")


_STEP = np.uint64(0x9E3779B97F4A7C15)


def hashed(laid: Laid, symbols: np.ndarray, more: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each length k up to the longest: a hash of the k symbols that end at each token, wherever its text has so many."""
    is_symbol = (find(symbols, laid.hashes) >= 0) | (find(more, laid.hashes) >= 0)
    mixed = mix64(np.where(is_symbol & (laid.classes >= 2), laid.hashes, laid.classes).view(np.uint64))
    out = [np.zeros(len(mixed), dtype=np.uint64)]
    for k in range(1, longest + 1):
        out.append(mix64(np.append(np.uint64(0), out[-1][:-1]) * _STEP + mixed + np.uint64(k)))
    return [x.view(np.int64) for x in out]


class Spread(NamedTuple):
    """A tree whose contexts are known by hashes: some weights are held, the others are in a table behind a filter.

    A pair's key is the hash of its context and next symbol, a state's is the
    complement of its hash. Weights are the log10 factors of pairs and the log10
    shares of states for symbols that they do not store.
    """

    symbols: np.ndarray
    keys: np.ndarray
    weights: np.ndarray
    filter: np.ndarray
    bits: int
    depth: int

    def score(self, laid: Laid, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``Tree.score``, with keys for packed pairs; more are the symbols in these texts that are not held."""
        out = np.zeros(len(laid.place))
        places, open_ = [], []
        ends = hashed(laid, self.symbols, more, self.depth + 1)
        for d in range(1, self.depth + 1):
            at = np.flatnonzero(laid.place >= d)
            for keys in (ends[d + 1][at], ~ends[d][at - 1]):
                found = find(self.keys, keys)
                hit = found >= 0
                out[at[hit]] += self.weights[found[hit]]
                missed, rest = at[~hit], keys[~hit]
                may = maybe(self.filter, self.bits, rest)
                places.append(missed[may])
                open_.append(rest[may])
        return out, np.concatenate(places), np.concatenate(open_)


def _more(batch: pa.RecordBatch) -> np.ndarray:
    """The symbols that tasks do not hold, in the texts of a batch (see ``marked``)."""
    if "more" not in batch.schema.names:
        return np.empty(0, np.int64)
    return np.unique(batch.column("more").flatten().to_numpy(zero_copy_only=False).astype(np.int64))


def marked(docs: DataFrame, counts: DataFrame, scratch: Scratch, s: Settings) -> DataFrame:
    """docs; where there are more symbols than tasks hold, with ``more``, the text's symbols among those that are not held."""
    words = counts.where(F.col("h") != _END_HASH)
    least = fitting(words, "c", s.min_symbol, s.max_symbols)
    if least == s.min_symbol:
        return docs
    rows = scratch.keep(docs.withColumn("place", F.monotonically_increasing_id()))
    shared = docs.sparkSession.sparkContext.broadcast(collected(words.where(F.col("c") >= least), "h")[0])

    def run(batches):
        for batch, laid in _chunks(batches):
            text = np.repeat(np.arange(batch.num_rows), np.diff(np.append(laid.first, len(laid.place))))
            open_ = np.flatnonzero((laid.classes >= 2) & (find(shared.value, laid.hashes) < 0))
            order = open_[np.lexsort((laid.hashes[open_], text[open_]))]
            t, h = text[order], laid.hashes[order]
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])])[: len(t)]
            yield _arrays("place h", np.asarray(batch.column("place"))[t[new]], h[new])

    rest = words.where((F.col("c") >= s.min_symbol) & (F.col("c") < least)).select("h")
    found = _rows(rows, "place").mapInArrow(run, "place bigint, h bigint").join(rest, "h").groupBy("place").agg(F.collect_set("h").alias("more"))
    return scratch.keep(rows.join(found, "place", "left").drop("place"))


def count_spread(train: DataFrame, symbols: np.ndarray, level: int, filter_: np.ndarray | None, bits: int) -> DataFrame:
    """(pair, context, above, up, n): hashes of each context of so many symbols with its next symbol, of the context, and of both without their first symbol, with counts.

    Contexts that the filter rules out are left out; length 0 counts the symbols.
    """
    shared = train.sparkSession.sparkContext.broadcast((symbols, filter_))

    def run(batches):
        symbols, filter_ = shared.value
        held: list[np.ndarray] = []

        def out():
            rows = np.concatenate(held)
            pairs, at, counts = np.unique(rows[:, 0], return_index=True, return_counts=True)
            return _arrays("pair context above up n", pairs, *rows[at, 1:].T, counts.astype(np.int64))

        for batch, laid in _chunks(batches):
            ends = hashed(laid, symbols, _more(batch), level + 1)
            at = np.flatnonzero(laid.place >= level)
            if level:
                at = at[maybe(filter_, bits, ends[level][at - 1])]
                held.append(np.stack([ends[level + 1][at], ends[level][at - 1], ends[level][at], ends[level - 1][at - 1]], axis=1))
            else:
                held.append(np.stack([ends[1], ends[0], ends[0], ends[0]], axis=1))
            if sum(map(len, held)) > 2_000_000:
                yield out()
                held.clear()
        if held:
            yield out()

    found = _rows(train, *[c for c in train.columns if c == "more"]).mapInArrow(run, "pair bigint, context bigint, above bigint, up bigint, n bigint")
    return found.groupBy("pair").agg(*[F.max(c).alias(c) for c in ("context", "above", "up")], F.sum("n").alias("n"))


def learn_spread(train: DataFrame, counts: DataFrame, base: int, scratch: Scratch, s: Settings) -> tuple[Spread, DataFrame]:
    """(tree, (pair, factor) of the keys whose weights are not in it), for any number of symbols and contexts.

    The tree is that of ``learn``. A context's count is that of the pair of its
    last symbol and what precedes that, and the suffix of a pair is a pair of the
    length below, so each length is a few joins with the one below it. A filter
    in the tasks leaves out most contexts that are not frequent before they are counted.
    """
    words = counts.where(F.col("h") != _END_HASH)
    symbols = collected(words.where(F.col("c") >= fitting(words, "c", s.min_symbol, s.max_symbols)), "h")[0]
    # a class has an unseen token's share and one more for each of its words, any other symbol one more
    shares = [(row["k"], row["m"] + 1 / CLASSES) for row in words.where(F.col("c") < s.min_symbol).groupBy("k").agg(F.count("*").alias("m")).collect()]
    keys = mix64(mix64(np.array([k for k, _ in shares], dtype=np.uint64)) + np.uint64(1)).view(np.int64)
    classes = train.sparkSession.createDataFrame([(int(k), float(m)) for k, (_, m) in zip(keys, shares, strict=True)], "pair long, share double")
    level_0 = count_spread(train, symbols, 0, None, 0).join(F.broadcast(classes), "pair", "left")
    pairs = scratch.keep(level_0.select("pair", "n", ((F.col("n") + F.coalesce("share", F.lit(1.0))) / base).alias("p")))
    roots, stored, contexts = pairs, [], []
    for level in range(1, s.depth + 1):
        frequent = scratch.keep(pairs.where(F.col("n") >= s.min_context).select("pair", F.col("n").alias("total")))
        filter_, bits = filter_of(frequent, frequent.count(), s.filter_bits)
        counted = count_spread(train, symbols, level, filter_, bits).where(F.col("n") >= s.min_pair)
        pairs = scratch.keep(counted.join(frequent.withColumnRenamed("pair", "context"), "context"))
        stored.append(pairs)
        by_context = pairs.groupBy("context").agg(F.max("up").alias("up"), F.sum("n").alias("s"), F.count("*").alias("k"))
        contexts.append(scratch.keep(by_context))

    def over(level: int, below: DataFrame, *columns: Column) -> DataFrame:
        """The stored pairs of a length with columns of their suffixes."""
        return stored[level - 1].join(below.select(F.col("pair").alias("above"), *columns), "above")

    # states: what diverges, and the suffixes of states
    states: list[DataFrame] = []
    for level in range(s.depth, 0, -1):
        q = F.col("p").alias("q") if level == 1 else (F.col("n") / F.col("total")).alias("q")
        found = diverging(over(level, roots if level == 1 else stored[level - 2], q), s.min_divergence)
        if states:
            found = found.unionByName(contexts[level].join(states[0], "context").select(F.col("up").alias("context")))
        states.insert(0, scratch.keep(found.distinct()))

    weights, below = None, roots
    for level in range(1, s.depth + 1):
        rows = over(level, below, F.col("p").alias("p_above")).join(contexts[level - 1].drop("up").join(states[level - 1], "context"), "context")
        rows = rows.withColumn("rest", (F.col("total") - F.col("s") + s.discount * F.col("k")) / F.col("total"))
        p = (F.col("n") - s.discount) / F.col("total") + F.col("rest") * F.col("p_above")
        factor = F.log10(p / (F.col("rest") * F.col("p_above")))
        below = scratch.keep(rows.select("pair", "context", "n", "total", F.log10("rest").alias("share"), p.alias("p"), factor.alias("factor")))
        shares = below.groupBy(F.bitwise_not("context").alias("pair")).agg(F.max("total").alias("n"), F.max("share").alias("factor"))
        both = below.select("pair", "n", "factor").unionByName(shares)
        weights = both if weights is None else weights.unionByName(both)
    weights = scratch.keep(weights)
    least = fitting(weights, "n", 1, s.held_pairs)
    held, factors = collected(weights.where(F.col("n") >= least), "pair", "factor")
    tail = scratch.keep(weights.where(F.col("n") < least).select("pair", "factor"))
    return Spread(symbols, held, factors, *filter_of(tail, tail.count(), s.filter_bits), s.depth), tail


class Model(NamedTuple):
    tree: Tree | Spread
    known: np.ndarray  # hashes of the tokens whose counts tasks hold
    counts: np.ndarray
    n: int
    v: int


def learn(train: DataFrame, scratch: Scratch, s: Settings = DEFAULTS, counts: DataFrame | None = None) -> tuple[Model, DataFrame, DataFrame | None]:
    """(model, (h, c) counts of the tokens that are not in it, (pair, factor) of the pairs that are not in it or None) from all training texts.

    With counts, their token counts, the texts are marked already (see ``marked``).
    """
    if counts is None:
        counts = scratch.keep(count_tokens(train))
        train = marked(train, counts, scratch, s)
    seen = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.max(F.when(F.col("h") == _END_HASH, F.col("c"))).alias("texts")).first()
    n, v, texts = int(seen["n"]), int(seen["v"]), int(seen["texts"] or 0)
    base = n + v + 1
    known_from = math.ceil(max(1, s.known_share * n))
    known, known_counts = collected(counts.where(F.col("c") >= known_from), "h", "c")
    rare = counts.where(F.col("c") < known_from).select("h", "c")

    def spread() -> tuple[Model, DataFrame, DataFrame | None]:
        tree, tail = learn_spread(train, counts, base, scratch, s)
        return Model(tree, known, known_counts, n, v), rare, tail

    if "more" in train.columns:
        return spread()
    words = counts.where(F.col("h") != _END_HASH)
    symbols, symbol_counts = collected(words.where(F.col("c") >= s.min_symbol), "h", "c")
    totals = np.zeros(FIRST + len(symbols), dtype=np.int64)
    root = np.full(len(totals), 1e-300)
    # the classes have the rest of the add-one mass, and one unseen token's between them
    root[2:FIRST] = 1 / CLASSES / base
    for row in words.where(F.col("c") < s.min_symbol).groupBy("k").agg(F.sum("c").alias("c"), F.count("*").alias("m")).collect():
        totals[row["k"]] = row["c"]
        root[row["k"]] += (row["c"] + row["m"]) / base
    totals[START], totals[FIRST:] = texts, symbol_counts
    root[END], root[FIRST:] = (texts + 1) / base, (symbol_counts + 1) / base

    # the contexts of each length, from the pairs of the length below
    frequent: list[np.ndarray] = []
    sums, suffixes, tables = [totals], [np.zeros(len(totals), np.int64)], []
    for level in range(1, max(2, s.depth)):
        beyond = level == s.depth - 1
        counted = scratch.keep(count_pairs(train, symbols, totals, frequent, s.min_context, beyond).where(F.col("n") >= s.min_pair))
        tables.append(counted.where("symbol < 0").select("pair", "n"))
        if level == s.depth:
            break
        inner = tables[-1].where((F.col("pair").bitwiseAND(F.lit(_MASK)) != END) & (F.col("n") >= s.min_context))
        if inner.count() > s.max_contexts:
            return spread()
        pairs, pair_counts = collected(inner, "pair", "n")
        if not len(pairs):
            break
        frequent.append(pairs)
        sums.append(pair_counts)
        ends = pairs & _MASK
        suffixes.append(ends if level == 1 else find(frequent[level - 2], suffixes[level - 1][pairs >> BITS] << BITS | ends))
        if beyond:
            tables.append(scratch.keep(numbered(counted.where("symbol >= 0"), pairs)))

    # states: what diverges, and the suffixes of states
    states = []
    for level, table in enumerate(tables, start=1):
        if level == 1:
            rows = dressed(table, totals * (totals >= s.min_context), None, root).withColumn("q", F.col("above"))
        else:
            up = tables[level - 2].select(F.col("pair").alias("suffix_pair"), F.col("n").alias("m"))
            rows = dressed(table, sums[level - 1], suffixes[level - 1], sums[level - 2]).join(up, "suffix_pair").withColumn("q", F.col("m") / F.col("above"))
        mask = np.zeros(len(sums[level - 1]), dtype=bool)
        mask[collected(diverging(rows, s.min_divergence), "context")[0]] = True
        states.append(mask)
    for level in range(len(states) - 1, 0, -1):
        states[level - 1][suffixes[level][states[level]]] = True

    # factors of the pairs over their suffixes' smoothed probabilities
    rests, factors, below = [], [], None
    for level, table in enumerate(tables, start=1):
        args = (sums[level - 1], None if level == 1 else suffixes[level - 1], root if level == 1 else sums[level - 2], states[level - 1])
        context, stored, kinds = collected(dressed(table, *args).groupBy("context").agg(F.sum("n").alias("s"), F.count("*").alias("k")), "context", "s", "k")
        share = np.ones(len(sums[level - 1]))
        total = sums[level - 1][context]
        share[context] = (total - stored + s.discount * kinds) / total
        rests.append(np.log10(share))
        rows = dressed(table, *args, share)
        if level == 1:
            rows = rows.withColumn("p_above", F.col("above"))
        else:
            rows = rows.join(below.select(F.col("pair").alias("suffix_pair"), F.col("p").alias("p_above")), "suffix_pair")
        p = (F.col("n") - s.discount) / F.col("total") + F.col("rest") * F.col("p_above")
        rows = rows.select("pair", "n", p.alias("p"), F.log10(p / (F.col("rest") * F.col("p_above"))).alias("factor"))
        below = scratch.keep(rows)
        factors.append(below.select(F.col("pair").bitwiseOR(F.lit(level << LEVEL_BITS)).alias("pair"), "n", "factor"))
    every = factors[0]
    for more in factors[1:]:
        every = every.unionByName(more)
    least = fitting(every, "n", s.min_pair, s.held_pairs)
    pairs, held = collected(every.where(F.col("n") >= least), "pair", "factor")
    tail, filter_, bits = None, None, 0
    if least > s.min_pair:
        tail = scratch.keep(every.where(F.col("n") < least).select("pair", "factor"))
        filter_, bits = filter_of(tail, tail.count(), s.filter_bits)
    of = pairs >> LEVEL_BITS
    inner = [*frequent, np.empty(0, np.int64)]
    levels = [level_of(pairs[of == d] & ((1 << LEVEL_BITS) - 1), held[of == d], inner[d - 1], states[d - 1], rests[d - 1]) for d in range(1, len(tables) + 1)]
    tree = Tree(symbols, levels, filter_, bits)
    return Model(tree, known, known_counts, n, v), rare, tail


_SCORED = "row bigint, doc_id bigint, held_out boolean, kind int, key bigint, times bigint, n_tokens bigint, n_known bigint, base double, score double"


def score(docs: DataFrame, model: Model, rare: DataFrame, tail: DataFrame | None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score) for each row of docs (doc_id, held_out, text).

    Tokens and pairs in the model are scored where the text is read. Every other
    token of a text, and every other pair that the filter does not rule out,
    becomes a row that is joined to its count or factor, so a long text
    spreads over many tasks. A row of docs is told from others by its task and
    place, so repeated ids give repeated results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    unseen = -math.log10(model.n + model.v + 1)

    def counted(text: np.ndarray, keys: np.ndarray):
        """(text, key, times) of the distinct pairs."""
        order = np.lexsort((keys, text))
        text, keys = text[order], keys[order]
        starts = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.empty(0, np.int64)
        return text[starts], keys[starts], np.diff(np.append(starts, len(keys)))

    def run(batches):
        from pyspark import TaskContext

        model = shared.value
        logs = np.log10((model.counts + 1) / (model.n + model.v + 1))
        row = TaskContext.get().partitionId() << 40
        names = [x.split()[0] for x in _SCORED.split(", ")]
        for batch, laid in _chunks(batches):
            if not batch.num_rows:
                continue
            at = find(model.known, laid.hashes)
            token = laid.place > 0
            hit = token & (at >= 0)
            base = np.zeros(len(at))
            base[hit] = logs[at[hit]]
            ratio, places, pairs = model.tree.score(laid, _more(batch))
            ids = row + np.arange(batch.num_rows)
            row += batch.num_rows
            text = np.repeat(np.arange(batch.num_rows), np.diff(np.append(laid.first, len(at))))
            sums = [np.add.reduceat(x, laid.first) for x in (token.astype(np.int64), hit.astype(np.int64), base, base + ratio)]
            zeros = np.zeros(batch.num_rows, np.int64)
            columns = [pa.array(ids), batch.column("doc_id"), batch.column("held_out"), pa.array(zeros.astype(np.int32)), pa.array(ids), pa.array(zeros), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(columns, names)
            missed = np.flatnonzero(token & (at < 0))
            for kind, found in ((1, counted(text[missed], laid.hashes[missed])), (2, counted(text[places], pairs))):
                if len(found[0]):
                    none, nil = np.zeros(len(found[0])), pa.nulls(len(found[0]))
                    whole = [pa.array(none.astype(np.int64))] * 2 + [pa.array(none)] * 2
                    columns = [pa.array(ids[found[0]]), nil.cast(pa.int64()), nil.cast(pa.bool_()), pa.array(np.full(len(none), kind, np.int32)), pa.array(found[1]), pa.array(found[2]), *whole]
                    yield pa.RecordBatch.from_arrays(columns, names)

    rows = _rows(docs, *[c for c in docs.columns if c != "text"]).mapInArrow(run, _SCORED)
    values = rare.select(F.lit(1).alias("kind"), F.col("h").alias("key"), "c", F.lit(0.0).alias("factor"))
    if tail is not None:
        values = values.unionByName(tail.select(F.lit(2).alias("kind"), F.col("pair").alias("key"), F.lit(0).cast("long").alias("c"), "factor"))
    c = F.coalesce("c", F.lit(0))
    times = F.col("times")
    own = F.when(F.col("kind") == 1, times * (F.log10(c + 1) + unseen)).otherwise(0.0)
    more = F.when(F.col("kind") == 2, times * F.coalesce("factor", F.lit(0.0))).otherwise(0.0)
    return (
        rows.join(values, ["kind", "key"], "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when((F.col("kind") == 1) & (c > 0), times).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + own).alias("base_score"),
            F.sum(F.col("score") + own + more).alias("score"),
        )
        .drop("row")
    )


def query(docs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Contract of op10: learn where the id's residue is not 2, score every row.

    A null or empty text is one token, the end. A row with a null doc_id is not
    held out and is learned from. Rows that repeat an id are learned from and
    scored each for itself. Other columns are not read, whatever their names.
    An empty table gives an empty result. Words and contexts stand for
    themselves by 64-bit hashes.
    """
    held_out = F.coalesce(id_residue(F.col("doc_id"), 7) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    scratch = Scratch(docs.sparkSession, "suffixlm")
    counts = scratch.keep(count_tokens(rows.where("not held_out")))
    rows = marked(rows, counts, scratch, settings)
    model, rare, tail = learn(rows.where("not held_out"), scratch, settings, counts)
    return score(rows, model, rare, tail).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score"
    )
