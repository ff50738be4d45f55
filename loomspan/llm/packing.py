"""Length-bucketed packing with optimal bucket boundaries.

Documents are batched with others of like length and padded to their bucket's
boundary. A dynamic program over the global length histogram chooses the
boundaries that make the total padding least; inside a bucket, batches are
filled up to a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.plans.ranks import fresh, group_ranks
from loomspan.plans.scratch import Scratch

BUCKETS = 8
TOKEN_BUDGET = 32768
ADDED = ("n_tokens", "bucket", "batch", "batch_row")


def token_count(text: Column) -> Column:
    """Words of the text (runs without ASCII white space) plus one end token; 1 for null or empty."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return (words + 1).cast("long")


def length_cells(lengths: DataFrame, max_cells: int | None = None) -> tuple[int, list[tuple[int, int]]]:
    """(step, [(cell, rows)]): the histogram of a ``length`` column, each cell a multiple of step.

    step is 1 unless the caller sets max_cells and there are more distinct
    lengths; then it is the least power of two with which max_cells cells reach
    the longest. Without it the cells are at most the square root of twice the
    tokens, as distinct lengths add up to no more than those: 100,000 for 5e9.
    """
    counts = lengths.groupBy("length").agg(F.count("*").alias("n"))
    stats = counts.agg(F.count("*").alias("cells"), F.max("length").alias("top")).first()
    step = 1
    while max_cells is not None and stats["cells"] > max_cells and stats["top"] > step * max_cells:
        step *= 2
    cell = (F.ceil(F.col("length") / step) * step).cast("long").alias("cell")
    found = counts.groupBy(cell).agg(F.sum("n").alias("n")).orderBy("cell").collect()
    return step, [(row["cell"], row["n"]) for row in found]


def boundaries(cells: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """The upper ends of at most so many buckets with the least total padding; among equals, the earliest ends.

    cells are (length, rows) in rising order. best[j] is the least padding of
    the first j cells with the buckets used so far; a further bucket that ends
    at cell j starts after some i < j and pads its rows to cell j's length. The
    best i never falls as j rises, so halving the range of j leaves each step of
    the halving about as many (i, j) as there are cells. Sums are exact in 64 bits.
    """
    if not cells:
        return []
    sizes = [c for c, _ in cells]
    m = len(cells)
    z, n = np.array(cells, dtype=np.int64).T
    r, t = (np.concatenate([[0], np.cumsum(x)]) for x in (n, z * n))
    now = np.concatenate([[0], z * r[1:] - t[1:]])
    back = [np.zeros(m + 1, dtype=np.int64)]
    for used in range(1, min(buckets, m)):
        after, source = np.zeros(m + 1, dtype=np.int64), np.zeros(m + 1, dtype=np.int64)
        # ranges of j that are left, and of the i among which their best ones lie
        first, last, low, high = (np.array([x]) for x in (used + 1, m, used, m - 1))
        while len(first):
            j = (first + last) // 2
            count = np.minimum(high, j - 1) - low + 1
            at = np.cumsum(count) - count
            part = np.repeat(np.arange(len(j)), count)
            i = np.arange(len(part)) - at[part] + low[part]
            cost = now[i] + z[j - 1][part] * (r[j][part] - r[i]) - (t[j][part] - t[i])
            after[j] = np.minimum.reduceat(cost, at)
            least = np.flatnonzero(cost == after[j][part])
            source[j] = best = i[least[np.unique(part[least], return_index=True)[1]]]
            first, last, low, high = (np.concatenate(x) for x in ((first, j + 1), (j - 1, last), (low, best), (best, high)))
            left = first <= last
            first, last, low, high = first[left], last[left], low[left], high[left]
        back.append(source)
        now = after
    out, j = [], m
    for source in reversed(back):
        out.append(sizes[j - 1])
        j = int(source[j])
    return out[::-1]


def bucket_of(length: Column, ends: list[int]) -> Column:
    """The least boundary that holds the length."""
    out = F.lit(ends[-1])
    for end in reversed(ends[:-1]):
        out = F.when(length <= end, F.lit(end)).otherwise(out)
    return out.cast("long")


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    carry: list[str] | None = None,
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
    max_cells: int | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """The carried columns (default: all) with n_tokens, bucket (padded length), batch and batch_row (longs).

    A batch holds max(1, budget // bucket) rows of one bucket, in the order of
    (n_tokens, key), or of the columns given as order (which are then carried
    along); only a bucket's last batch may be smaller. A text longer
    than the budget has a batch to itself. Null and empty texts count as one
    token. Rows that repeat a key are packed each for itself, null keys come
    first. Columns of docs with the added names are replaced, others pass
    through whatever their names. An empty table gives an empty result.
    The boundaries pad least over all lengths; max_cells rounds lengths up for
    them. The texts are counted once; ranks inside a bucket come from range
    partitions, so a bucket with most of the rows spans many tasks.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    columns = [c for c in (carry or docs.columns) if c not in ADDED]
    sorts = order or ["n_tokens", key]
    more = [c for c in sorts if c not in (*columns, "n_tokens")]
    (place,) = fresh([*columns, *more, *ADDED], "_rank")
    counted = scratch.keep(docs.select(*columns, *more, token_count(F.col(text)).alias("n_tokens")))
    _, cells = length_cells(counted.select(F.col("n_tokens").alias("length")), max_cells)
    marked = counted.withColumn("bucket", bucket_of(F.col("n_tokens"), boundaries(cells, buckets) or [1]))
    held = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket"))).cast("long")
    return group_ranks(marked, "bucket", sorts, scratch, rank=place).select(
        *columns,
        "n_tokens",
        "bucket",
        F.floor(F.col(place) / held).cast("long").alias("batch"),
        F.pmod(F.col(place), held).alias("batch_row"),
    )


def query(docs: DataFrame) -> DataFrame:
    """Every document's bucket and batch; its text is read for the token count and not carried on."""
    return pack(docs.select("doc_id", "text"), carry=["doc_id"])


def oracle() -> str:
    """The same packing in SQL, one CTE for each bucket that the dynamic program adds."""
    levels = ["b1 AS (SELECT j, z * r - t AS cost, [z] AS ends FROM h)"]
    for k in range(2, BUCKETS + 1):
        levels.append(
            f"""b{k} AS (
            SELECT j.j AS j, min(i.cost + j.z * (j.r - hi.r) - (j.t - hi.t)) AS cost,
                arg_min(list_append(i.ends, j.z), (i.cost + j.z * (j.r - hi.r) - (j.t - hi.t)) * 1000000 + i.j) AS ends
            FROM b{k - 1} i JOIN h hi ON hi.j = i.j JOIN h j ON i.j < j.j GROUP BY j.j)"""
        )
    last = " UNION ALL ".join(f"SELECT {k} AS k, ends FROM b{k} WHERE j = (SELECT max(j) FROM h)" for k in range(1, BUCKETS + 1))
    return f"""
    WITH d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS n FROM documents),
    g AS (SELECT n AS z, count(*) AS c FROM d GROUP BY n),
    h AS (SELECT z::HUGEINT AS z, row_number() OVER (ORDER BY z) AS j, sum(c) OVER (ORDER BY z) AS r, sum(c * z) OVER (ORDER BY z) AS t FROM g),
    {", ".join(levels)},
    e AS (SELECT ends FROM ({last}) ORDER BY k DESC LIMIT 1),
    m AS (SELECT doc_id, n, list_min(list_filter(ends, lambda x: x >= n))::BIGINT AS bucket FROM d, e),
    q AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n, doc_id NULLS FIRST) - 1 AS rk, greatest(1, {TOKEN_BUDGET} // bucket) AS held FROM m)
    SELECT doc_id, n::BIGINT AS n_tokens, bucket, (rk // held)::BIGINT AS batch, (rk % held)::BIGINT AS batch_row FROM q
    """
