"""The source registry: a plain dictionary, from YAML where a parser is there."""

from __future__ import annotations


def load_config(path: str) -> dict:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML needs the yaml package; pass a dictionary instead") from error
    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file) or {}


def enabled_sources(config: dict) -> list[str]:
    """Names of the sources that are not switched off, in their order."""
    return [name for name, source in (config.get("sources") or {}).items() if (source or {}).get("enabled", True)]
