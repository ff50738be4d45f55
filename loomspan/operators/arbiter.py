"""Decisions and extractions by an outside model, behind a small protocol; without one borderline names stay apart.

A model is any callable (system, user) -> text. Replies are data: they are
parsed, checked and stored as a table, and the resolver joins that table, so a
run can be repeated without the model.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions import text
from loomspan.functions.text import FAMILIES, PRICING_MODELS

Model = Callable[[str, str], str]

SYSTEM = "Decide whether two names denote the same organisation. Answer with a JSON object: is_same_entity, canonical_name, confidence (0 to 1), explanation."


class ModelsFailed(RuntimeError):
    pass


class RateLimited(RuntimeError):
    """What a model raises when it is asked too often."""


def with_failover(models: Iterable[Model], attempts: int = 3, pause: float = 1.0, longest: float = 16.0) -> Model:
    """The first model of the chain that answers; all failing raises.

    A model that is rate limited is tried so many times, after waits of pause,
    2 pause, 4 pause... (longest at most, and up to one pause more by chance); any other
    error passes on to the next model at once.
    """
    chain = list(models)

    def complete(system: str, user: str) -> str:
        errors = []
        for model in chain:
            for attempt in range(attempts):
                try:
                    return model(system, user)
                except RateLimited as error:
                    errors.append(repr(error))
                    if attempt + 1 < attempts:
                        time.sleep(min(longest, pause * 2**attempt) + random.random() * pause)
                except Exception as error:  # noqa: BLE001  whatever a client raises
                    errors.append(repr(error))
                    break
        raise ModelsFailed("; ".join(errors) or "no model is configured")

    return complete


def probe(model: Model) -> dict:
    """Whether a model answers at all: success, reply, error and the milliseconds that it took."""
    began = time.monotonic()
    try:
        reply, error = model("You are being tested.", "Answer with the word ok."), None
    except Exception as raised:  # noqa: BLE001  whatever a client raises
        reply, error = None, repr(raised)
    return {"success": error is None, "reply": reply, "error": error, "milliseconds": round((time.monotonic() - began) * 1000, 1)}


def ask_about_pairs(pairs: DataFrame, model: Model) -> DataFrame:
    """(clean_a, clean_b, reply) for borderline pairs; a failing model gives a null reply."""

    def run(frames):
        for frame in frames:
            replies = []
            for a, b in zip(frame["clean_a"], frame["clean_b"], strict=True):
                try:
                    replies.append(model(SYSTEM, f"A: {a}\nB: {b}"))
                except Exception:  # noqa: BLE001  an unanswered pair stays apart
                    replies.append(None)
            yield pd.DataFrame({"clean_a": frame["clean_a"], "clean_b": frame["clean_b"], "reply": replies})

    return pairs.select("clean_a", "clean_b").mapInPandas(run, "clean_a string, clean_b string, reply string")


def ask(prompt: Column, system: str, model: Model) -> Column:
    """The model's reply to each prompt; null for a null prompt or a failing model."""

    @F.pandas_udf("string")
    def run(prompts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                return model(system, text)
            except Exception:  # noqa: BLE001  an unanswered prompt stays empty
                return None

        return prompts.map(one)

    return run(prompt)


def _between(col: Column, low: int, high: int) -> Column:
    return F.when(F.length(col).between(low, high), col)


# Texts that count as true and as false.
TRUE_TEXTS, FALSE_TEXTS = ["true", "t", "yes", "y", "on", "1"], ["false", "f", "no", "n", "off", "0"]


class Reply:
    """The fields of a model's JSON reply, each as the type that is asked of it.

    Loosely typed values are taken where they can mean one thing only: "true",
    "yes" or 1 for a truth value, "0.9" for a number, "12" or 12.0 for a whole one.
    A text must be a text. ``wrong`` tells a value that is there and cannot be
    taken from one that is missing or null.
    """

    def __init__(self, reply: Column):
        self.json = F.try_parse_json(text.reply_json(reply))

    def _kind(self, field: str) -> Column:
        """STRING, BOOLEAN, BIGINT, DECIMAL(p,s)...; VOID for null, null where there is no such field."""
        return F.schema_of_variant(F.try_variant_get(self.json, f"$.{field}", "variant"))

    def _raw(self, field: str) -> Column:
        return F.when(self._kind(field).rlike("^(STRING|BOOLEAN|BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(self.json, f"$.{field}", "string"))

    def string(self, field: str) -> Column:
        return F.when(self._kind(field) == "STRING", self._raw(field))

    def boolean(self, field: str) -> Column:
        raw = self._raw(field)
        word, number = F.lower(raw), F.when(self._kind(field) != "STRING", raw.try_cast("double"))
        return F.when(word.isin(TRUE_TEXTS) | (number == 1), F.lit(True)).when(word.isin(FALSE_TEXTS) | (number == 0), F.lit(False))

    def number(self, field: str) -> Column:
        raw = self._raw(field)
        return F.when(self._kind(field) == "BOOLEAN", (raw == "true").cast("double")).otherwise(F.trim(raw).try_cast("double"))

    def whole(self, field: str) -> Column:
        value = self.number(field)
        return F.when(value == F.floor(value), value.try_cast("bigint"))

    def wrong(self, field: str, value: Column) -> Column:
        """Whether the field holds something, and not a value of its type."""
        return F.coalesce(self._kind(field) != "VOID", F.lit(False)) & value.isNull()


def same_entity(reply: Column) -> Column:
    """The checked decision as a struct; a reply that fails a check means not the same, with confidence 0.5."""
    r = Reply(reply)
    same, name, sure, why = r.boolean("is_same_entity"), r.string("canonical_name"), r.number("confidence"), r.string("explanation")
    good = same.isNotNull() & name.isNotNull() & F.coalesce(sure.between(0, 1), F.lit(False)) & why.isNotNull()
    return F.struct(
        F.coalesce(F.when(good, same), F.lit(False)).alias("is_same"),
        F.coalesce(F.when(good, sure), F.lit(0.5)).alias("confidence"),
        F.substring(why, 1, 990).alias("explanation"),
    )


def decisions(pairs: DataFrame, model: Model) -> DataFrame:
    """The decision table (clean_a, clean_b, is_same, confidence, explanation) for the resolver."""
    return ask_about_pairs(pairs, model).select("clean_a", "clean_b", same_entity(F.col("reply")).alias("d")).select("clean_a", "clean_b", "d.*")


def hiring_extraction(reply: Column) -> Column:
    """A checked job extraction; null unless a company of 1 to 100 characters is there and every field is of its type and in range."""
    r = Reply(reply)
    company, title, place, remote, family = r.string("company"), r.string("title"), r.string("location"), r.boolean("is_remote"), r.string("role_family")
    wrong = r.wrong("title", title) | r.wrong("location", place) | r.wrong("role_family", family) | F.coalesce((r._kind("is_remote") == "VOID") | r.wrong("is_remote", remote), F.lit(False))  # noqa: SLF001
    good = F.length(company).between(1, 100) & ~wrong & (F.coalesce(F.length(title), F.lit(0)) <= 200) & (F.coalesce(F.length(place), F.lit(0)) <= 200)
    good = good & (family.isNull() | family.isin(FAMILIES))
    return F.when(good, F.struct(company.alias("company"), title.alias("title"), place.alias("location"), F.coalesce(remote, F.lit(False)).alias("is_remote"), family.alias("role_family")))


def news_summary(reply: Column) -> Column:
    return _between(Reply(reply).string("summary"), 20, 500)


def extract_hiring(posts: DataFrame, html: str, model: Model) -> DataFrame:
    """posts with ``job``: the checked extraction from the chunked comment, null where there is none."""
    asked = posts.withColumn("_reply", ask(text.chunk_comment(F.col(html)), "Extract company, title, location, is_remote and role_family as a JSON object.", model))
    return asked.withColumn("job", hiring_extraction(F.col("_reply"))).drop("_reply")


def summarise_news(items: DataFrame, body: str, title: str, model: Model) -> DataFrame:
    """items with ``model_summary`` of the chunked article, null where there is none."""
    asked = items.withColumn("_reply", ask(text.chunk_article(F.col(body), F.col(title)), "Summarise the article in a JSON object with one field, summary.", model))
    return asked.withColumn("model_summary", news_summary(F.col("_reply"))).drop("_reply")


def fill_field(rows: DataFrame, field: str, html: str, model: Model) -> DataFrame:
    """rows with the field's nulls filled from the chunked page where the model's checked reply has a value."""
    prompt = F.when(F.col(field).isNull(), text.chunk_html(F.col(html)))
    asked = rows.withColumn("_reply", ask(prompt, f"Find {field}. Answer with a JSON object with one field, {field}; null if it is not stated.", model))
    found = field_value(F.col("_reply"), field).try_cast(dict(rows.dtypes)[field])
    return asked.withColumn(field, F.coalesce(F.col(field), found)).drop("_reply")


def field_value(reply: Column, field: str) -> Column:
    """One checked field of a reply, as text: employee_count, pricing_model, role_family, title or author."""
    r = Reply(reply)
    if field == "employee_count":
        count = r.whole(field)
        return F.when(count >= 1, count.cast("string"))
    value = r.string(field)
    if field == "pricing_model":
        return F.when(value.isin(PRICING_MODELS), value)
    if field == "role_family":
        return F.when(value.isin(FAMILIES), value)
    if field in ("title", "author"):
        return _between(value, 0, 200)
    raise ValueError(f"no check for field {field}")
