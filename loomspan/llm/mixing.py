"""Mixing sources to target weights by Pfair scheduling (Baruah et al., 1996).

A source's documents are cut into blocks. With target weights w that add up to
one, the k-th block of a source (from 0) is released at slot floor(k / w) and due
by slot ceil((k + 1) / w). At every slot the released block with the earliest
deadline runs, so after any number of slots each source has had its weight's share
to within less than one block. When a source has run out, the schedule starts anew
for the others, with their weights in the same proportions. Weights are taken as
the exact fractions that they are: nothing is rounded to a cycle.
"""

from __future__ import annotations

import heapq
import json
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.plans.ranks import fresh, group_ranks
from loomspan.plans.scratch import Scratch

#: Rows of a block. Where the table would have more than MAX_BLOCKS of them, the rows of a block double until it has not:
#: the schedule is made on the driver, so this bounds its memory and the broadcast (8 bytes a block), and with it the sources.
BLOCK_ROWS = 32
MAX_BLOCKS = 1 << 20
#: Blocks of a source whose slots are sent in one row.
RUN_BLOCKS = 64
#: Target weights are the sources' sizes to this power: 1 keeps proportions, 0 makes them equal.
TEMPERATURE = 0.5
NO_SOURCE = ""


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Integers in exactly the proportions of the weights, which must be positive and finite."""
    if any(not (w > 0 and math.isfinite(w)) for w in weights.values()):
        raise ValueError("weights must be positive and finite")
    exact = {name: Fraction(w) for name, w in weights.items()}
    common = math.lcm(*(w.denominator for w in exact.values())) if exact else 1
    return {name: int(w * common) for name, w in exact.items()}


def schedule(weights: dict[str, float], blocks: dict[str, int]) -> dict[str, list[int]]:
    """The slot of every block of every source. Slots are 0, 1, 2... without gaps; equal deadlines go to the source that sorts first."""
    given = whole_weights({name: weights[name] for name, n in blocks.items() if n})
    out: dict[str, list[int]] = {name: [] for name in sorted(blocks)}
    live, slot = sorted(given), 0
    while live:
        total, began = sum(given[name] for name in live), slot
        coming = [(0, name, 0) for name in live]
        ready: list[tuple[int, str, int]] = []
        ended = None
        while ended is None:
            while coming and coming[0][0] <= slot - began:
                _, name, k = heapq.heappop(coming)
                heapq.heappush(ready, (-(-(k + 1) * total // given[name]), name, k))
            _, name, k = heapq.heappop(ready)
            out[name].append(slot)
            slot += 1
            if len(out[name]) == blocks[name]:
                ended = name
            else:
                heapq.heappush(coming, ((k + 1) * total // given[name], name, k + 1))
        live = [name for name in live if name != ended]
    return out


def source_sizes(docs: DataFrame, source: str = "source", most: int = MAX_BLOCKS) -> dict[str, int]:
    """Each source's rows. At most ``most`` + 1 rows reach the driver; more sources raise a ValueError."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("s")
    found = docs.select(name).groupBy("s").agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} sources")
    return {row["s"]: row["n"] for row in found}


def tempered(sizes: dict[str, int], temperature: float = TEMPERATURE) -> dict[str, float]:
    """Target weights: the sizes to the power of temperature, to the nearest 2**-20."""
    return {name: math.floor(n**temperature * 2**20 + 0.5) / 2**20 for name, n in sizes.items()}


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    source: str = "source",
    key: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    temperature: float = TEMPERATURE,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """docs with ``slot`` and ``slot_row`` (longs, replaced if present): read in that order the sources follow their weights.

    Every row is kept and scheduled. A null source is the source ''. Rows of a
    source are taken in the order of the key (nulls first; rows that repeat a
    key follow each other in no stated order). A source of docs without a weight
    raises a ValueError; weights of sources that docs lacks are ignored. An
    empty table gives an empty result. Other columns pass through, whatever
    their names. No step gathers a source in one task.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    inner = source in ("slot", "slot_row") or key in ("slot", "slot_row")
    if inner:
        raise ValueError("the source and key columns cannot be called slot or slot_row")
    kept = docs.drop("slot", "slot_row")
    name, rank, block, run, slots, other, part = fresh(kept.columns, "_source", "_rank", "_block", "_run", "_slots", "_other", "_part")
    sizes = source_sizes(kept, source)
    if weights is None:
        weights = tempered(sizes, temperature)
    if missing := sorted(set(sizes) - set(weights)):
        raise ValueError(f"no weight for {missing[:5]}")
    while len(sizes) <= max_blocks < sum(-(-n // block_rows) for n in sizes.values()):
        block_rows *= 2
    found = schedule(weights, {s: -(-n // block_rows) for s, n in sizes.items()})
    lines = [
        json.dumps({other: s, part: at // RUN_BLOCKS, slots: at_slots[at : at + RUN_BLOCKS]}) for s, at_slots in found.items() for at in range(0, len(at_slots), RUN_BLOCKS)
    ]
    plan = docs.sparkSession.read.schema(f"`{other}` string, `{part}` long, `{slots}` array<long>").json(scratch.put_lines(lines))
    named = kept.withColumn(name, F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)))
    ranked = group_ranks(named, name, [key], scratch, rank=rank).withColumn(block, F.floor(F.col(rank) / block_rows)).withColumn(run, F.floor(F.col(block) / RUN_BLOCKS))
    placed = ranked.join(F.broadcast(plan), (F.col(name) == F.col(other)) & (F.col(run) == F.col(part)))
    return placed.select(
        *kept.columns,
        F.get(F.col(slots), F.pmod(F.col(block), F.lit(RUN_BLOCKS)).cast("int")).alias("slot"),
        F.pmod(F.col(rank), F.lit(block_rows).cast("long")).alias("slot_row"),
    )


def interleave(docs: DataFrame, **options) -> DataFrame:
    """docs' own columns in mixed order: written out, file after file follows the schedule. See ``mix`` for odd rows."""
    place = fresh(docs.columns, "slot", "slot_row")
    bare = [c for c in docs.columns if c in ("slot", "slot_row")]
    aside = fresh([*docs.columns, *place], *(f"_own_{c}" for c in bare))
    mixed = mix(docs.withColumnsRenamed(dict(zip(bare, aside, strict=True))), **options).withColumnsRenamed(dict(zip(("slot", "slot_row"), place, strict=True)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = mixed.repartitionByRange(n, *place).sortWithinPartitions(*place)
    return ordered.withColumnsRenamed(dict(zip(aside, bare, strict=True))).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    """Every document's place in the mix, by square-root weights of the sources' sizes."""
    return mix(docs.select("doc_id", "source")).select("doc_id", "source", "slot", "slot_row")


def oracle() -> str:
    """The same schedule in SQL, a step of the recursion for each slot; for tables of at most MAX_BLOCKS blocks."""
    live = "list_filter(range(1, len(done) + 1), lambda i: done[i] < bs[i])"
    total = "list_sum(list_transform(list_filter(range(1, len(done) + 1), lambda i: done[i] < bs[i]), lambda i: ws[i]))"
    return f"""
    WITH RECURSIVE n AS (SELECT coalesce(source, '') AS s, count(*) AS c FROM documents GROUP BY 1),
    p AS (SELECT s, floor(pow(c, {TEMPERATURE}) * 1048576 + 0.5)::BIGINT AS w, (c + {BLOCK_ROWS - 1}) // {BLOCK_ROWS} AS b FROM n),
    pl AS (SELECT list(w ORDER BY s) AS ws, list(b ORDER BY s) AS bs, list(s ORDER BY s) AS ss, sum(b)::BIGINT AS slots FROM p),
    run(slot, began, done, base, pick) AS (
        SELECT -1::BIGINT, 0::BIGINT, list_transform(ws, lambda q: 0::BIGINT), list_transform(ws, lambda q: 0::BIGINT), 0::BIGINT FROM pl
        UNION ALL
        SELECT slot + 1, CASE WHEN ended THEN slot + 2 ELSE began END, after, CASE WHEN ended THEN after ELSE base END, best
        FROM (
            SELECT *, list_transform(range(1, len(done) + 1), lambda i: done[i] + CASE WHEN i = best THEN 1 ELSE 0 END) AS after, done[best] + 1 = bs[best] AS ended
            FROM (
                SELECT *, list_min(list_transform(list_filter({live},
                    lambda i: ((done[i] - base[i]) * w) // ws[i] <= slot + 1 - began),
                    lambda i: (((done[i] - base[i] + 1) * w + ws[i] - 1) // ws[i]) * 100000 + i))::BIGINT % 100000 AS best
                FROM (SELECT run.*, ws, bs, slots, {total}::BIGINT AS w FROM run, pl)
                WHERE slot < slots - 1))
    ),
    tpl AS (SELECT ss[pick] AS s, slot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS k FROM run, pl WHERE slot >= 0),
    d AS (SELECT doc_id, source, coalesce(source, '') AS s, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id NULLS FIRST) - 1 AS rk FROM documents)
    SELECT d.doc_id, d.source, t.slot AS slot, d.rk % {BLOCK_ROWS} AS slot_row
    FROM d JOIN tpl t ON t.s = d.s AND t.k = d.rk // {BLOCK_ROWS}
    """
