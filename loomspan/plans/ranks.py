"""Dense ranks inside groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomspan.plans.scratch import Scratch

#: monotonically_increasing_id keeps the partition above this many bits.
ROW_BITS = 33


#: Rows of the table that turns positions into ranks, up to which it is broadcast; beyond them it is joined.
BROADCAST_SPANS = 200_000


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as set it apart from the columns (whatever their case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def group_ranks(df: DataFrame, group: str, order: list[str], scratch: Scratch, partitions: int | None = None, rank: str = "rank") -> DataFrame:
    """df with the column ``rank`` (long; replaced if present): 0, 1, 2... inside each group in the given order.

    A window over the group would put a hot group into one task. Here rows are
    range-partitioned by (group, order), so a hot group spans many tasks; each
    row takes its position in its task, and a table of one row for each (task,
    group) turns positions into ranks. That table has at most tasks + groups
    rows; it is broadcast while it is small. The sampled
    partitioning is written down first, so later stages and retries see the
    same positions. Nulls sort first and are ranked like other values; rows
    that tie in every order column get different ranks in no stated order.
    """
    columns = [c for c in df.columns if c.lower() != rank.lower() or c in (group, *order)]
    at, task, n, first, shift, other = fresh([*df.columns, rank], "_at", "_task", "_n", "_first", "_shift", "_g")
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.keep(
        df.select(*columns).repartitionByRange(count, group, *order).sortWithinPartitions(group, *order).withColumn(at, F.monotonically_increasing_id())
    )
    spans = dealt.groupBy(group, F.shiftright(at, ROW_BITS).alias(task)).agg(F.count("*").alias(n), F.min(at).alias(first))
    before = W.partitionBy(group).orderBy(task).rowsBetween(W.unboundedPreceding, -1)
    starts = scratch.keep(spans.select(F.col(group).alias(other), task, (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first)).alias(shift)))
    few = starts.limit(BROADCAST_SPANS + 1).count() <= BROADCAST_SPANS
    same = (F.shiftright(dealt[at], ROW_BITS) == starts[task]) & dealt[group].eqNullSafe(starts[other])
    joined = dealt.join(F.broadcast(starts) if few else starts, same)
    return joined.select(*[dealt[c] for c in columns if c.lower() != rank.lower()], (F.col(at) + F.col(shift)).cast("long").alias(rank))
