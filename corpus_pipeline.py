"""A corpus pipeline over the documents table: each stage applies one operator to all that its predecessor kept.

Stages: language identification (texts whose language cannot be told go), line
dedup (later repeats of runs of lines go, and texts of which nothing is left),
near-duplicates (one document of each component stays), mixing (the rows are laid
out so that reading them in file order follows the sources' target weights) and
packing (every document gets its length bucket; a bucket's batches are filled in
the order of the files, so training on them one after the other follows the mix).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm import langid, linedup, mixing, neardup, packing
from loomspan.plans.scratch import Scratch

#: No stage but mixing and packing can be put in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, by profiles of the labelled rows."""
    return langid.accept(docs, langid.learn(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of lines; n_chars follows the text."""
    cut = linedup.dedup_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    return left.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, at similarity 0.8 on shingles of five words."""
    return neardup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the Pfair schedule of their sources."""
    return mixing.interleave(docs)


def in_file_order(docs: DataFrame, position: str = "position") -> DataFrame:
    """docs with ``position`` (long): 0, 1, 2... over the rows of its files, in the order of the files' numbers.

    Files are read back in any order, so each row takes its place in its file
    and the rows of the files before. That table has one row a file. What is not
    read from files is numbered in the order of its partitions.
    """
    try:
        rows = docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        rows = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_file", F.lit("part-0"))
        return rows.withColumn(position, F.col("_row")).select(*docs.columns, position)
    number = F.regexp_extract("_file", r"part-(\d+)", 1).try_cast("int")
    files = rows.groupBy("_file").agg(F.count("*").alias("_n")).withColumn("_part", number)
    before = W.orderBy("_part", "_file").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select(F.col("_file").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = rows.join(F.broadcast(starts), F.col("_file") == F.col("_of"))
    return joined.withColumn(position, F.col("_start") + F.col("_row")).select(*docs.columns, position)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, position in the mix, n_tokens, bucket, batch, batch_row of every document; batches are filled in the order of the mix."""
    return packing.pack(in_file_order(docs.select("doc_id", "text")), carry=["doc_id", "position"], order=["position"])


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other from the documents table, each result written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
