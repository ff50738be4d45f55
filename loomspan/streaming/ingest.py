"""Structured Streaming forms of the first-seen state and the freshness window."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle



#: Rows of partly folded times that a task holds before it hands them on.
HELD_ROWS = 500_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _least_times(batches):
    """For mapInArrow over (url, seen_at): each URL's least time in the task, before anything is shuffled. A task that holds too many hands them on and begins anew."""
    held, rows = [], 0

    def folded() -> pa.Table:
        out = pa.Table.from_batches(held).group_by("url").aggregate([("seen_at", "min")])
        return out.rename_columns(["seen_at" if n == "seen_at_min" else n for n in out.column_names]).select(["url", "seen_at"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD_ROWS:
            held = folded().to_batches()
            rows = sum(x.num_rows for x in held)
            if rows >= HELD_ROWS // 2:
                yield from held
                held, rows = [], 0
    if rows:
        yield from folded().to_batches()


class FirstSeen(StatefulProcessor):
    """One value for each URL, kept for ever: when it was first seen. A URL is passed on once, with the batch that holds it first."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_seen", "at timestamp")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - the interface's names
        earliest = min((t for t in (frame["seen_at"].min() for frame in rows) if not pd.isna(t)), default=None)
        if earliest is not None and not self.first.exists():
            self.first.update((earliest.to_pydatetime(),))
            yield pd.DataFrame({"url": [key[0]], "first_seen_at": [earliest]})

    def close(self) -> None:
        pass


def stream_first_seen(events: DataFrame, url: str, seen_at: str) -> DataFrame:
    """A stream of (url, first_seen_at): each URL once, with the earliest time of the batch that first holds it.

    State is kept for ever, as the first-seen table is; it lives in the RocksDB
    state store, keyed by URL, and survives a restart from the checkpoint. Each
    task folds its rows to one a URL before the shuffle, so the state sees a URL
    once a task however often a batch holds it. Rows without a URL or a time are
    left out. Sets the session's state store to RocksDB, which this state needs.
    """
    conf = events.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    # a batch writes its changes, not the whole state
    conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    rows = events.select(F.col(url).cast("string").alias("url"), F.col(seen_at).cast("timestamp").alias("seen_at")).where("url is not null and seen_at is not null")
    folded = rows.mapInArrow(_least_times, "url string, seen_at timestamp")
    return folded.groupBy("url").transformWithStateInPandas(FirstSeen(), "url string, first_seen_at timestamp", "Append", "None")


def fresh_stream(events: DataFrame, date: Column, now: Column, max_future_seconds: int = 3600) -> DataFrame:
    """events within the freshness window. It is bound to the given time, not to the stream's watermark."""
    from loomspan.functions.dates import is_fresh

    return events.where(is_fresh(date, now, max_future_seconds))
