"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loomspan.plans.scratch import Scratch

#: Up to this many links one task finishes the rest; more are contracted round by round.
FEW_LINKS = 10_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: hang every neighbour of u below the least vertex that u knows."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where(F.col("u") != F.col("v")).distinct()


def _finished(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex but the least of its component, with that one. For few links: one task holds them all."""

    def run(batches):
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while above.get(x, x) != x:
                above[x] = x = above.get(above[x], above[x])
            return x

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                u, v = top(u), top(v)
                above[max(u, v)] = min(u, v)
        found = [(x, top(x)) for x in above]
        found = [(x, y) for x, y in found if x != y]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["u", "v"])

    return edges.coalesce(1).mapInArrow(run, "u bigint, v bigint")


def _kept(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple]:
    """The edges written down, with their number and the sum of their hashes, found in the same job."""
    seen = Observation()
    kept = scratch.keep(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")))
    return kept, (seen.get["n"], seen.get["s"])


def components(links: DataFrame, a: str = "a", b: str = "b", label: str = "components", rounds: int = 64) -> DataFrame:
    """(id, component) for every vertex that occurs in a link; component is its least vertex.

    Links are an undirected edge list of longs, in any order and with repeats;
    rows with a null end and self-links carry no information and are left out.
    Every iteration is written to the shared folder, so the plan never grows and
    a lost executor costs one iteration; few links are finished by one task.
    Vertices without links are absent: the caller left-joins and coalesces to
    the vertex itself. Rounds grow with the logarithm of the longest path; if the
    given number does not suffice, a RuntimeError says so.
    """
    scratch = Scratch(links.sparkSession, label)
    ends = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges, mark = _kept(
        ends.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), scratch
    )
    if mark[0] <= FEW_LINKS:
        edges = scratch.keep(_finished(edges))
    else:
        for _ in range(rounds):
            before = mark
            after, mark = _kept(_star(_star(edges, True), False), scratch)
            scratch.drop(edges)
            edges = after
            if mark == before:
                break
        else:
            raise RuntimeError(f"components have not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
