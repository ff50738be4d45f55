"""The corpus operators' queries over the driver's tables.

All of them read only the columns that they name, so others may have any name, and
give an empty result for an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.common import table


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language and score of every whole text, learned where the id's residue is not 2.

    Null, empty and letterless texts are ``und`` with 0; equal distances go to
    the language that sorts first; rows that repeat are judged alike; a null id has a null held_out.
    """
    from loomspan.llm import langid

    return langid.query(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page.

    Null and empty pages have an empty text; every row is worked on by itself;
    long pages take time in proportion to their length.
    """
    from loomspan.llm import boilerplate

    return boilerplate.query(table(spark, sf_dir, "pages"))


def op1_audio_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chroma fingerprints of the documents' bytes: n_codes, component and best alignment of each.

    Null, empty and short texts have no codes and are linked with nothing; equal
    sounds share a component; rows that repeat an id count as one, rows without
    an id stay, each with a null component. Long texts are read whole.
    """
    from loomspan.llm import chroma

    return chroma.query(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and row in the Pfair mix of the sources.

    A null source is a source of its own; ids that repeat each get a place, null
    ids come first; equal deadlines go to the source that sorts first. Texts are not read.
    """
    from loomspan.llm import mixing

    return mixing.query(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count, bucket, batch and place in it.

    Null and empty texts have one token; a text longer than the budget has a
    batch to itself; ties in length go by id, null ids first; ids that repeat each get a place.
    """
    from loomspan.llm import packing

    return packing.query(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document, at similarity 0.85.

    Texts without words are linked with nothing; of rows that share an id one
    text counts and one row comes out; rows without an id stay, with a null
    component, and are kept. Very long texts are compared on their whole sets.
    """
    from loomspan.llm import neardup

    return neardup.query(table(spark, sf_dir, "documents"))


def op7_shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard. Ids that repeat share a shard; a null id is placed as an empty text. Texts are not read."""
    from loomspan.llm import sharding

    return sharding.query(table(spark, sf_dir, "documents"))


def op8_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, by cosine inside its label.

    Null, zero, empty and non-finite vectors and null labels are linked with
    nothing; of rows that share an id the one with the least label and hash
    counts; rows without an id stay, without links.
    """
    from loomspan.llm import vecdup

    return vecdup.query(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, removed lines, and length and MD5 of what is left.

    Null texts stay null with no lines; rows without an id are not compared; of
    rows that share an id one text is compared and cut. Of equal runs the first by (id, line) stays.
    """
    from loomspan.llm import linedup

    return linedup.query(table(spark, sf_dir, "documents"))


def op10_suffix_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix-tree and base scores of every whole text, learned where the id's residue is not 2.

    A null or empty text is one token, the end; rows that repeat an id are
    learned from and scored each for itself; a null id is not held out.
    """
    from loomspan.llm import suffixlm

    return suffixlm.query(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and the clusters' inertia of every usable vector, after five rounds of k-means in integers.

    Null vectors, those of another length and those with components that are
    null, not finite or beyond 2^19 have no row; labels are not read; rows that
    repeat an id count each; rows without an id are clustered and start a
    centroid last; equally near centroids: the smaller number.
    """
    from loomspan.llm import balltree

    return balltree.query(table(spark, sf_dir, "embeddings"))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the archives that it was written to.

    A null html is empty; null and odd URLs are encoded; rows without an id are
    responses; of rows that repeat id and html one is a response, the others
    revisit it. Very long pages are written and read one at a time.
    """
    from loomspan.llm import warc

    return warc.query(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of repeated words of every whole text, and what is left without them.

    Null, empty and blank texts have no words and no runs; rows that repeat come
    out alike; a null id stays null and its text is taken as it is. A very long
    text is one task's work, in time n log n.
    """
    from loomspan.llm import periodic

    return periodic.query(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's packed documents; see corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_audio_fingerprints": op1_audio_fingerprints,
        "op2_source_mixing": op2_source_mixing,
        "op3_language_id": op3_language_id,
        "op4_main_text": op4_main_text,
        "op5_packing": op5_packing,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_shard_placement": op7_shard_placement,
        "op8_vector_duplicates": op8_vector_duplicates,
        "op9_line_dedup": op9_line_dedup,
        "op10_suffix_scores": op10_suffix_scores,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_warc_archive": op12_warc_archive,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    from loomspan.llm import balltree, mixing, packing, sharding, warc

    return {
        "op2_source_mixing": mixing.oracle(),
        "op5_packing": packing.oracle(),
        "op7_shard_placement": sharding.oracle(),
        "op11_centroid_clusters": balltree.oracle(),
        "op12_warc_archive": warc.oracle(),
    }
