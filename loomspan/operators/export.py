"""Flat tabs and nested records for export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import dates, text
from loomspan.schemas import SCHEMA_VERSION, TABLES


def _text(name: str, default: str = "") -> Column:
    return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(default))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _time(name: str) -> Column:
    return F.coalesce(dates.iso_utc(F.col(name).cast("timestamp")), F.lit(""))


def _authors(df: DataFrame) -> Column:
    if dict(df.dtypes)["authors"] == "string":
        return text.authors_text(F.col("authors"))
    names = F.filter(F.transform("authors", lambda a: F.trim(a)), lambda a: a != "")
    return F.coalesce(F.array_join(names, "; "), F.lit(""))


def tab(df: DataFrame, table: str) -> DataFrame:
    """The table's rows under its tab's headings, in order of id. Null texts are ''; long texts are cut."""
    # The headings and lengths.
    kind = TABLES[table].record_type if table in TABLES else ""
    head = {"schemaVersion": _text("schema_version", SCHEMA_VERSION), "recordType": _text("record_type", kind), "source.name": _text("source_name")}
    if table == "startups":
        cells = {"source.url": _text("source_url"), "content.entityName": _text("entity_name"), "content.data.employeeCount": _number("employee_count")}
    elif table == "products":
        cells = {"source.url": _text("source_url"), "content.startupName": _text("startup_name"), "content.pricingModel": _text("pricing_model")}
    elif table == "research_papers":
        cells = {
            "source.url": _text("paper_url"), "content.title": _text("title"), "content.authors": _authors(df), "content.paper_url": _text("paper_url"),
            "content.github_url": _text("github_url"), "content.github_stars": _number("github_stars"), "content.published_date": _text("published_date"),
        }
    elif table == "jobs":
        cells = {
            "source.url": _text("source_url"), "content.title": _text("title"), "content.company": _text("company"), "content.date": _time("published_date"),
            "content.is_remote": F.coalesce(F.col("is_remote"), F.lit(False)), "content.role_family": _text("role_family"), "content.job_url": _text("job_url"), "content.description": text.shorten(_text("description"), 500),
        }
    elif table == "news":
        cells = {
            "source.url": _text("source_url"), "content.title": _text("title"), "content.url": _text("url"), "content.published_date": _time("published_date"), "content.author": _text("author"),
            "content.summary": _text("summary"), "content.full_text": text.shorten(_text("full_text"), 1000), "content.content_type": _text("content_type", "FULL_TEXT"),
        }
    elif table == "entity_mapping_log":
        head, cells = {}, {c: _text(c) for c in ("raw_name", "canonical_name", "entity_type", "match_method")}
        cells["confidence"] = F.coalesce(F.bround("confidence", 4).cast("string"), F.lit(""))
        cells |= {c: _text(c) for c in ("source_name", "source_url", "explanation")} | {"resolved_at": _time("resolved_at")}
    else:
        raise ValueError(f"unknown table {table}")
    if head:
        cells = head | cells | {"collectedAt": _time("collected_at")}
    return df.orderBy("id").select(*[c.alias(name) for name, c in cells.items()])


def nested(df: DataFrame, record_type: str) -> DataFrame:
    """One column ``record``: the row as a nested structure of its record type; an unknown type raises."""
    version = F.coalesce(F.col("schema_version"), F.lit(SCHEMA_VERSION)).alias("schemaVersion")
    kind = F.lit(record_type).alias("recordType")
    shapes = {
        "RESEARCH_PAPER": ["title", "authors", "paper_url", "github_url", "github_stars", "published_date"],
        "STARTUP": [F.col("entity_name").alias("entityName"), F.struct(F.col("employee_count").alias("employeeCount")).alias("data")] if "entity_name" in df.columns else None,
        "PRODUCT": [F.col("startup_name").alias("startupName"), F.col("pricing_model").alias("pricingModel")] if "startup_name" in df.columns else None,
        "NEWS": ["title", "url", "published_date", "author", "summary", "full_text", F.coalesce("content_type", F.lit("FULL_TEXT")).alias("content_type")] if "content_type" in df.columns else None,
        "JOB": ["title", "company", F.col("published_date").alias("date"), F.coalesce("is_remote", F.lit(False)).alias("is_remote"), "role_family", "job_url", "description"] if "job_url" in df.columns else None,
    }
    if shapes.get(record_type) is None:
        raise ValueError(f"unknown record type {record_type}")
    content = F.struct(*shapes[record_type]).alias("content")
    if record_type == "RESEARCH_PAPER":
        return df.select(F.struct(version, kind, content).alias("record"))
    source = F.struct(F.col("source_name").alias("name"), F.col("source_url").alias("url")).alias("source")
    return df.select(F.struct(version, kind, source, content, F.col("collected_at").alias("collectedAt")).alias("record"))


def record_lines(df: DataFrame, record_type: str) -> DataFrame:
    """One JSON line for each row; null fields are written."""
    return nested(df, record_type).select(F.to_json("record", {"ignoreNullFields": "false"}).alias("value"))


def write_tabs(tables: dict[str, DataFrame], path: str, spark: SparkSession | None = None) -> None:
    """Each table's tab as CSV with its headings, replacing what is at path/<table>. A table that is absent gives an empty tab, with headings."""
    spark = spark or next(iter(tables.values())).sparkSession
    for name in ("startups", "products", "research_papers", "jobs", "news", "entity_mapping_log"):
        rows = tables[name] if name in tables else spark.createDataFrame([], TABLES[name].ddl)
        cells = tab(rows, name)
        if name not in tables:
            cells = cells.repartition(1)
        cells.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
