"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994).

A language's profile is the list of its most frequent letter n-grams, of one to
three letters with word ends marked, in order of frequency. A document gets the
same kind of list from its whole text, and its distance to a language is the sum
over its n-grams of how far each is out of place in the language's list; an
n-gram that the language's list lacks counts as out of place by the profile
length. The nearest profile is the prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm.common import id_residue, pieces
from loomspan.plans.ranks import fresh
from loomspan.plans.scratch import Scratch

#: Letters are code points below 2**21, so three of them fit in 63 bits.
BITS = 21
UNDETERMINED = "und"
#: A prediction scoring below this matches no profile in any useful way (see ``identify``).
MIN_SCORE = 0.02
#: A prediction is taken from this share of a usual low score on: what all but LOW of the labelled texts like it reach, so that up to LOW of the labels may be wrong.
USUAL_SHARE, LOW = 0.5, 0.1
#: Labelled texts of a language and length from which on they have a bound of their own.
MIN_LABELLED = 50

_FOLD: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Code point -> lower-case letter, 0 for everything that is not a letter."""
    global _FOLD
    if _FOLD is None:
        out = np.zeros(0x110000, dtype=np.int64)
        for start, stop in ((0, 0xD800), (0xE000, 0x110000)):
            for point in range(start, stop):
                letter = chr(point)
                if letter.isalpha():
                    low = letter.lower()
                    out[point] = ord(low) if len(low) == 1 else point
        _FOLD = out
    return _FOLD


def grams(text: str) -> np.ndarray:
    """Every n-gram (n = 1, 2, 3) inside the marked words of a text, as packed integers."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.zeros(len(points) + 2, dtype=np.int64)
    letters[1:-1] = _fold_table()[points]
    blank = letters == 0
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])  # a run of non-letters is one word end
    s = letters[keep]
    if len(s) < 3:
        return np.empty(0, dtype=np.int64)
    two = (s[:-1] << BITS) | s[1:]
    three = (two[:-1] << BITS) | s[2:]
    # a blank inside a trigram joins two words; one at its ends marks a word end
    return np.concatenate([s[s > 0], two | (1 << 62), three[s[1:-1] > 0]])


def ranked(text: str, size: int) -> np.ndarray:
    """The packed n-grams of a text's profile, most frequent first, ties by value."""
    keys, counts = np.unique(grams(text), return_counts=True)
    if len(keys) > size:
        # the size-th largest count bounds what can be in the profile
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.lexsort((keys, -counts))][:size]


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows with a language; each batch is summed before it is sent."""

    def run(batches):
        for batch in pieces(batches, rows=4000, size=2 << 20):
            by: dict[str, list[str]] = {}
            for value, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if value:
                    by.setdefault(name, []).append(value)
            for name, texts in by.items():
                keys, counts = np.unique(grams("\n".join(texts)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, size: int = 400, max_languages: int = 1000, text: str = "text", lang: str = "lang") -> dict:
    """{language: packed n-grams in rank order} from all given rows.

    At most ``size`` n-grams for each of at most ``max_languages`` languages
    reach the driver, so the model that is sent to tasks has a fixed bound; more
    languages raise a ValueError. Rows without text or language teach nothing.
    """
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        count_grams(docs, text, lang)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .limit(size * max_languages + 1)
        .collect()
    )
    if len(top) > size * max_languages:
        raise ValueError(f"more than {max_languages} languages")
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in top:
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {name: np.array([g for _, g in sorted(found)], dtype=np.int64) for name, found in sorted(profiles.items())}


class Judge:
    """Out-of-place distances of one document to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.names = sorted(profiles)
        self.size = size
        self.keys = np.unique(np.concatenate([profiles[x] for x in self.names])) if self.names else np.empty(0, np.int64)
        self.ranks = np.full((len(self.names), len(self.keys) + 1), -1, dtype=np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.keys, profiles[name])] = np.arange(len(profiles[name]))

    def distances(self, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        ranks = self.ranks[:, at]
        gap = np.abs(ranks - np.arange(len(own)))
        gap[ranks < 0] = self.size
        return np.minimum(gap, self.size).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.size) if text else np.empty(0, np.int64)
        if not len(own) or not self.names:
            return UNDETERMINED, 0.0
        far = self.distances(own)
        best = int(np.argmin(far))
        return self.names[best], float(1.0 - far[best] / (len(own) * self.size))


def identify(docs: DataFrame, profiles: dict, size: int = 400, text: str = "text", names: tuple[str, str] = ("lang_pred", "score"), carry: list[str] | None = None) -> DataFrame:
    """docs, or their carried columns, with the prediction and its score under the given names (columns of those names are replaced).

    The score is 1 minus the distance over its greatest possible value: 1 for a
    text that repeats a profile's order, 0 for one that shares no n-gram with
    it. Null, empty and letterless texts, and any text while no profile has been
    learned, give ``und`` and 0. Equal distances go to the language that sorts
    first. The language and source columns are not read. Rows that repeat are
    judged each for itself; an empty table gives an empty result.
    """
    keep = [c for c in (docs.columns if carry is None else carry) if c not in names]

    def run(batches):
        judge = Judge(profiles, size)
        for batch in pieces(batches, column=text):
            found = [judge.predict(x) for x in batch.column(text).to_pylist()]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                [*keep, *names],
            )

    schema = docs.select(*keep).schema.add(names[0], "string").add(names[1], "double")
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def usual_scores(marked: DataFrame, lang: str, guess: str, score: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(g, k, by) and (g, whole): low quantiles of the scores of labelled rows that got their label, by length class and over all."""
    own = marked.where(F.col(lang) == F.col(guess)).select(F.col(guess).alias("g"), F.col(kind).alias("k"), F.col(score).alias("s"))
    low = F.percentile_approx("s", F.lit(LOW), F.lit(10_000))
    by = own.groupBy("g", "k").agg(low.alias("by"), F.count("*").alias("n")).where(F.col("n") >= MIN_LABELLED).drop("n")
    return by, own.groupBy("g").agg(low.alias("whole"))


def accept(docs: DataFrame, profiles: dict, size: int = 400, min_score: float = MIN_SCORE, lang: str = "lang") -> DataFrame:
    """The rows whose language can be told: not ``und``, not below min_score, and not far from every profile. Columns are unchanged, whatever their names.

    A text is far from every profile when it scores less than USUAL_SHARE of
    what labelled texts of the predicted language and a like length (to a factor
    of two, from 32 to 4096 characters) score at their LOW quantile. Where fewer
    than MIN_LABELLED are of that length, those of all lengths count. The label
    of the text itself does not matter. Null, empty and letterless texts go;
    rows that repeat are judged alike; an empty table gives an empty result. At
    most 9 bounds a language are broadcast.
    """
    guess, score, kind, g, k, g2, by_, whole_ = fresh(docs.columns, "_guess", "_score", "_kind", "_g", "_k", "_g2", "_by", "_whole")
    sized = docs.withColumn(kind, F.floor(F.log2(F.least(F.greatest(F.char_length("text"), F.lit(16)), F.lit(4096)))).cast("int"))
    scratch = Scratch(docs.sparkSession, "langid")
    # the scores are kept without the texts, which are judged again below: that costs less than another copy of the corpus
    judged = scratch.keep(identify(sized.where(F.col(lang).isNotNull()).select("text", lang, kind), profiles, size, names=(guess, score), carry=[lang, kind]))
    by, whole = (scratch.keep(x) for x in usual_scores(judged, lang, guess, score, kind))
    by, whole = by.select(F.col("g").alias(g), F.col("k").alias(k), F.col("by").alias(by_)), whole.select(F.col("g").alias(g2), F.col("whole").alias(whole_))
    told = identify(sized, profiles, size, names=(guess, score)).where(F.col(guess) != UNDETERMINED)
    told = told.join(F.broadcast(by), (F.col(guess) == F.col(g)) & (F.col(kind) == F.col(k)), "left").join(F.broadcast(whole), F.col(guess) == F.col(g2), "left")
    usual = F.coalesce(by_, whole_, F.lit(0.0))
    return told.where((F.col(score) >= min_score) & (F.col(score) >= USUAL_SHARE * usual)).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    """Contract of op3: learn where the id's residue is not 2, predict every row.

    A row with a null doc_id has a null held_out, teaches nothing and is predicted. See ``identify`` for other odd rows.
    """
    held_out = id_residue(F.col("doc_id"), 4) == 2
    train = docs.where(~held_out & F.col("lang").isNotNull())
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return identify(rows, learn(train)).select("doc_id", "held_out", "lang_pred", "score")
