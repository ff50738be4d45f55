"""String similarity by longest common subsequence, inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


#: Characters whose places are bits of one integer: an addition of two such integers and a carry stays far from overflow.
WORD = 48


def _once(value: Column, use) -> Column:
    """use(value), with value computed once: inside a lambda an outer expression would be computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, a row of the dynamic program at a time in the bits of a few integers (Crochemore et al., 2001).

    A zero bit stands for a place of b at which the row rises. For each of a's
    characters, with M the bits of its places in b, V becomes (V + (V & M)) | (V & ~M).
    """
    full = F.lit((1 << WORD) - 1).cast("long")

    def masks_of(t: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(t["b"]) / WORD).cast("int") - 1), lambda k: F.reverse(F.slice(t["b"], k * WORD + 1, WORD)))

        def masks(chunks: Column) -> Column:
            def of(c: Column) -> Column:
                return F.transform(chunks, lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda bits, y: bits * 2 + F.when(y == c, F.lit(1)).otherwise(F.lit(0))))

            keys = F.array_distinct(t["b"])
            return F.struct(t["a"].alias("a"), keys.alias("keys"), F.transform(keys, of).alias("masks"), F.transform(chunks, lambda _: full).alias("start"))

        return _once(chunks, masks)

    def rows(t: Column) -> Column:
        def step(v: Column, x: Column) -> Column:
            at = F.array_position(t["keys"], x).cast("int")

            def added(m: Column) -> Column:
                def word(done: Column, k: Column) -> Column:
                    bits, mask = F.get(v, k), F.get(m, k)
                    total = bits + bits.bitwiseAND(mask) + done["carry"]
                    new = total.bitwiseAND(full).bitwiseOR(bits.bitwiseAND(F.bitwise_not(mask)))
                    return F.struct(F.concat(done["v"], F.array(new)).alias("v"), F.shiftright(total, WORD).alias("carry"))

                start = F.struct(F.array().cast("array<long>").alias("v"), F.lit(0).cast("long").alias("carry"))
                return F.aggregate(F.sequence(F.lit(0), F.size(v) - 1), start, word, lambda done: done["v"])

            return F.when(at == 0, v).otherwise(_once(F.get(t["masks"], at - 1), added))

        last = F.aggregate(t["a"], t["start"], step)
        return F.aggregate(last, F.lit(0), lambda n, v: n + WORD - F.bit_count(v))

    both = F.struct(_characters(a).alias("a"), _characters(b).alias("b"))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(_once(_once(both, masks_of), rows))


def ratio(a: Column, b: Column) -> Column:
    """Normalised insert-delete similarity, 0 to 100; two empty strings are equal."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * common_length(a, b) / total)


def sorted_tokens(text: Column) -> Column:
    """The white-space-separated words in code-point order, joined by one space."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def may_reach(a: Column, b: Column, percent: float) -> Column:
    """Whether the lengths alone allow a ratio of so many percent; cheap, and true whenever the ratio reaches it."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= percent * (F.length(a) + F.length(b))
