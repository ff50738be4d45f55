"""Cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one, for a local master only.

    Executors of a cluster do not see the driver's temporary folder, so there an
    unset folder raises a ValueError.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="loomspan-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


class Scratch:
    """Parquet tables of one operator call, kept in the shared folder.

    A table is read back with its schema and file sizes known, survives the
    loss of any executor and lets the optimizer see how small it is. ``drop``
    removes a table that no later plan reads; a result that is not yet computed
    may read the others, so they go when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._kept: list[DataFrame] = []
        self._where(self.root)[1].deleteOnExit(self._where(self.root)[0])

    def _where(self, path: str):
        """(Hadoop path, its file system)."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def put_lines(self, lines: list[str]) -> str:
        """Write a text file from the driver and return its path: for a plan's parameters that are too long for a literal."""
        self._n += 1
        path = f"{self.root}/t{self._n}.txt"
        where, files = self._where(path)
        out = files.create(where)
        for at in range(0, len(lines), 5000):
            out.write("".join(x + "\n" for x in lines[at : at + 5000]).encode())
        out.close()
        return path

    def keep(self, df: DataFrame) -> DataFrame:
        """Write df once and return it read back."""
        self._n += 1
        path = f"{self.root}/t{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # noqa: SLF001
        self._kept.append(out)
        return out

    def mark(self) -> int:
        """A point to go back to with drop_since."""
        return len(self._kept)

    def drop_since(self, mark: int, *but: DataFrame) -> None:
        """Remove the tables kept since the mark, except those given: for when no plan that is still to run reads them."""
        paths = {getattr(x, "_scratch_path", None) for x in but}
        for df in self._kept[mark:]:
            if df._scratch_path not in paths:  # noqa: SLF001
                self.drop(df)
        self._kept[mark:] = [x for x in self._kept[mark:] if x._scratch_path in paths]  # noqa: SLF001

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            where, files = self._where(path)
            files.delete(where, True)
