"""The engine's tables: columns, unique keys and required columns."""

from __future__ import annotations

from dataclasses import dataclass

SCHEMA_VERSION = "1.0"


@dataclass(frozen=True)
class Table:
    name: str
    record_type: str
    ddl: str
    keys: tuple[str, ...]
    required: tuple[str, ...]


TABLES = {
    t.name: t
    for t in (
        Table(
            "research_papers", "RESEARCH_PAPER",
            "id bigint, schema_version string, record_type string, title string, authors array<string>, paper_url string, github_url string, github_stars int, published_date string, source_name string, collected_at timestamp",
            ("paper_url",), ("schema_version", "record_type", "paper_url", "collected_at"),
        ),
        Table(
            "startups", "STARTUP",
            "id bigint, schema_version string, record_type string, source_name string, source_url string, entity_name string, employee_count int, collected_at timestamp",
            ("source_url", "entity_name"), ("schema_version", "record_type", "source_url", "collected_at"),
        ),
        Table(
            "products", "PRODUCT",
            "id bigint, schema_version string, record_type string, source_name string, source_url string, startup_name string, pricing_model string, collected_at timestamp",
            ("source_url", "startup_name"), ("schema_version", "record_type", "source_url", "collected_at"),
        ),
        Table(
            "news", "NEWS",
            "id bigint, schema_version string, record_type string, source_name string, source_url string, title string, url string, published_date timestamp, author string, summary string, full_text string, content_type string, collected_at timestamp",
            ("url",), ("schema_version", "record_type", "source_name", "source_url", "title", "url", "published_date", "full_text", "content_type", "collected_at"),
        ),
        Table(
            "jobs", "JOB",
            "id bigint, schema_version string, record_type string, source_name string, source_url string, title string, company string, published_date timestamp, is_remote boolean, role_family string, job_url string, description string, collected_at timestamp",
            ("job_url",), ("schema_version", "record_type", "source_name", "source_url", "company", "published_date", "is_remote", "job_url", "collected_at"),
        ),
        Table("seen_urls", "SEEN", "url string, first_seen_at timestamp", ("url",), ("first_seen_at",)),
        Table(
            "entity_mapping_log", "MAPPING",
            "id bigint, raw_name string, canonical_name string, entity_type string, match_method string, confidence double, source_name string, source_url string, explanation string, resolved_at timestamp",
            (), ("raw_name", "canonical_name", "entity_type", "match_method", "confidence", "resolved_at"),
        ),
    )
}
