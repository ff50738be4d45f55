"""Keyed insert-or-ignore, first-seen freshness and ingestion counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from loomspan.functions import dates, text
from loomspan.plans import files
from loomspan.plans.ranks import group_ranks
from loomspan.plans.scratch import Scratch
from loomspan.schemas import SCHEMA_VERSION, TABLES


def insert_ignore(new: DataFrame, keys: list[str], required: list[str], arrival: str, target: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """The rows of new that INSERT OR IGNORE would add to target, in new's columns; with a limit, the first so many by arrival.

    Rows with a null in a required column go. Of the rows that share a key the
    earliest by arrival stays, and only if target lacks the key. A null in any
    key column makes a row distinct from all others. The earliest row of a key is
    found by an aggregation, so repeats are folded before the shuffle and a hot
    key is no hot task; rows that tie on arrival are settled by their whole value.
    """
    kept = new.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True)))
    if not keys:
        return _first(kept, arrival, limit)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    others = [arrival, *[c for c in new.columns if c not in keys and c != arrival]]
    keyed = kept.where(present).groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    if target is not None:
        keyed = keyed.join(target.select(*keys), keys, "left_anti")
    first = keyed.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in new.columns])
    return _first(first.unionByName(kept.where(~present)), arrival, limit)


def _first(rows: DataFrame, arrival: str, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.orderBy(arrival, *[c for c in rows.columns if c != arrival]).limit(limit)


def complete_record(df: DataFrame, table: str, collected_at: Column) -> DataFrame:
    """df with the table's constant columns, and its stored forms of URLs, dates, pricing and article text."""
    spec = TABLES[table]
    out = df.withColumns({"schema_version": F.lit(SCHEMA_VERSION), "record_type": F.lit(spec.record_type), "collected_at": collected_at})
    if table == "research_papers":
        out = out.withColumns({"paper_url": text.paper_url(F.col("paper_url")), "published_date": dates.pad_date(F.col("published_date"))})
    elif table == "products":
        out = out.withColumn("pricing_model", text.valid_pricing(F.col("pricing_model")))
    elif table == "news":
        body = F.coalesce(F.nullif(F.col("full_text"), F.lit("")), F.nullif(F.col("summary"), F.lit("")), F.lit(""))
        out = out.withColumn("full_text", body)
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at path, None where there is none yet."""
    return spark.read.parquet(path) if files.exists(spark, path) else None


def init_tables(spark: SparkSession, root: str) -> list[str]:
    """Make every table that does not exist yet, empty, at root/<name>; returns those made."""
    made = []
    for name, spec in TABLES.items():
        if read_table(spark, f"{root}/{name}") is None:
            spark.createDataFrame([], spec.ddl).write.parquet(f"{root}/{name}")
            made.append(name)
    return made


def save(df: DataFrame, table: str, path: str, arrival: str, collected_at: Column, limit: int | None = None) -> int:
    """Append the rows of df that the table at path does not have yet, and return how many; with a limit, the first so many by arrival.

    Added rows are numbered in the order of arrival, on from the table's
    largest id, without gaps. A missing path is an empty table.
    """
    spark, spec = df.sparkSession, TABLES[table]
    columns = [f for f in T._parse_datatype_string(spec.ddl).fieldNames() if f != "id"]  # noqa: SLF001
    target = read_table(spark, path)
    last = target.agg(F.max("id")).first()[0] if target is not None else None
    ready = complete_record(df, table, collected_at).select(*columns, F.col(arrival).alias("_arrival"))
    scratch = Scratch(spark, "save")
    added = scratch.keep(insert_ignore(ready, list(spec.keys), list(spec.required), "_arrival", target, limit).withColumn("_all", F.lit(0)))
    numbered = group_ranks(added, "_all", ["_arrival", *spec.keys], scratch, rank="_rank")
    numbered.select((F.col("_rank") + ((last or 0) + 1)).alias("id"), *columns).write.mode("append").parquet(path)
    count = added.count()
    scratch.drop_since(0)
    return count


def first_seen(events: DataFrame, url: str, seen: DataFrame | None, now: Column) -> DataFrame:
    """(url, first_seen_at) of every URL: from the state where it has one, now otherwise."""
    found = events.select(F.col(url).alias("url")).where("url is not null and url != ''").distinct()
    if seen is None:
        return found.withColumn("first_seen_at", now)
    return found.join(seen.select("url", "first_seen_at"), "url", "left").withColumn("first_seen_at", F.coalesce("first_seen_at", now))


def judge_freshness(events: DataFrame, raw_date: Column, url: str, seen: DataFrame | None, now: Column, max_future_seconds: int = 3600) -> DataFrame:
    """events with ``fresh`` and ``published_date``: by the parsed date, or where there is none by the URL's first sight.

    A URL not seen before is fresh and gets now as its date; one seen before is
    fresh while its first sight is. Without date and URL a row is not fresh and
    has no date. The state has no expiry.
    """
    parsed = events.withColumn("_date", dates.parse_datetime(raw_date, now))
    state = parsed
    if seen is not None:
        state = parsed.join(seen.select(F.col("url").alias("_url"), F.col("first_seen_at").alias("_seen")), F.col(url) == F.col("_url"), "left").drop("_url")
    else:
        state = parsed.withColumn("_seen", F.lit(None).cast("timestamp"))
    named = F.coalesce(F.col(url) != "", F.lit(False))
    date = F.coalesce(F.col("_date"), F.when(named, F.coalesce("_seen", now)))
    fresh = F.coalesce(dates.is_fresh(date, now, max_future_seconds), F.lit(False))
    return state.withColumns({"fresh": fresh, "published_date": F.when(F.col("_date").isNotNull() | named, dates.iso_utc(date))}).drop("_date", "_seen")


def stage_counts(df: DataFrame, source: str, stages: dict[str, Column]) -> DataFrame:
    """One row for each source: how many rows pass each stage's condition."""
    return df.groupBy(source).agg(*[F.count_if(test).alias(name) for name, test in stages.items()])


def observed(df: DataFrame, stages: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """df, and how many of its rows pass each stage's condition: counted while df is computed, by whatever computes it, with no scan of their own.

    ``Observation.get`` waits for that run; on a stream the counts of each batch
    come with its progress (see ``StageListener``).
    """
    seen = Observation("stages")
    return df.observe(seen, *[F.count_if(test).alias(name) for name, test in stages.items()]), seen


class StageListener(StreamingQueryListener):
    """Adds up the counts that ``observe`` gives for the batches of the session's streams, under the observation's name."""

    def __init__(self, name: str = "stages"):
        self.name, self.totals = name, {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the interface's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        for stage, n in (row.asDict() if row is not None else {}).items():
            self.totals[stage] = self.totals.get(stage, 0) + n

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def saved_total(counts: DataFrame, saved: str = "saved") -> DataFrame:
    """One row: the sum of all sources' saved rows, 0 without sources."""
    return counts.agg(F.coalesce(F.sum(saved), F.lit(0)).alias("saved"))


def enrich(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """left with the right table's columns where the key is known, null elsewhere; one row for each left row."""
    unique = right.groupBy(key).agg(F.min(F.struct(*columns)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in columns])
    return left.join(unique, key, "left")
