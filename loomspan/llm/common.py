"""Pieces shared by the corpus operators."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch between the JVM and Python. With the byte bound set
#: in the session a batch stays small for long texts too.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_residue(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo modulus; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus)).cast("int")


def id_residue_py(key: int | None, modulus: int) -> int | None:
    return None if key is None else zlib.crc32(str(key).encode()) % modulus


def as_bytes(column: pa.Array) -> list[bytes]:
    """The values of a binary column, nulls as empty."""
    return [x or b"" for x in column.to_pylist()]


def pieces(batches, rows: int = BATCH_ROWS, size: int = 16 << 20, column: str = "text"):
    """Slices of the incoming batches of so many rows and bytes of one column at most (a single row may be longer)."""
    for batch in batches:
        at, n = 0, batch.num_rows
        lengths = np.zeros(n, dtype=np.int64)
        if n:
            values = batch.column(column)
            lengths = np.asarray(pc.binary_length(values).fill_null(0), dtype=np.int64)
        while at < n:
            total = np.cumsum(lengths[at : at + rows])
            take = max(1, int(np.searchsorted(total, size, side="right")))
            yield batch.slice(at, take)
            at += take


def partitions_for(df: DataFrame, least: int = 1) -> int:
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
