"""Star counts of repositories, looked up through any fetcher, one request for each repository."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import text

API = "https://api.github.com/repos/"


def stars_in(reply: str | None) -> int | None:
    """The count in a reply about a repository; null where the reply is none, no JSON object, or holds no number."""
    try:
        found = json.loads(reply or "")
    except ValueError:
        return None
    count = found.get("stargazers_count") if isinstance(found, dict) else None
    return count if isinstance(count, int) and not isinstance(count, bool) else None


def star_counts(repos: DataFrame, url: str, fetch: Callable[[str], str | None], api: str = API) -> DataFrame:
    """(url, stars) for each distinct repository URL: null where it names no repository or the lookup fails.

    ``fetch`` takes the address of the reply; whatever it raises counts as a failure. ``enrich`` joins the result to papers.
    """

    def run(frames):
        for frame in frames:
            stars = []
            for path in frame["path"]:
                try:
                    stars.append(None if path is None else stars_in(fetch(api + path)))
                except Exception:  # noqa: BLE001  a failed lookup leaves the count open
                    stars.append(None)
            yield pd.DataFrame({"url": frame["url"], "stars": pd.array(stars, dtype="Int32")})

    col = F.col(url)
    rows = repos.select(col.alias("url"), F.concat_ws("/", text.repo_owner(col), text.repo_name(col)).alias("path")).where("url is not null").distinct()
    return rows.withColumn("path", F.when(F.contains("path", F.lit("/")), F.col("path"))).mapInPandas(run, "url string, stars int")
