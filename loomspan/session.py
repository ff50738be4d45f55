"""Session settings shared by the entry points, tests and benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What the engine relies on whatever the cluster: UTC, ANSI casts, adaptive
#: re-planning with skew splitting, and Arrow batches bounded in bytes so that
#: very long texts do not pile up in one Python batch.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with DEFAULTS; keyword conf wins (dots given as double underscores)."""
    builder = SparkSession.builder.master(master).appName("loomspan")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
