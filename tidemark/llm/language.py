"""Language identification, words first.

A known word adds its log frequency in each language. A word that no language
has falls back to its character n-grams: the longest order of which any gram is
known counts, shorter ones are asked only if none is. The model is counted by
Spark on a bounded sample of the labelled documents and holds a bounded number
of words and grams per language.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held, held_out, trim
from tidemark.operators.ranking import fresh
from tidemark.session import materialize

#: At most about this many documents of each language are learned from; chosen by a hash of the id.
TRAIN_DOCS = 4000
WORDS = 15_000
GRAMS = 6_000
ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"
#: What a word or gram counts in a language that does not have it.
ABSENT = 0.3
#: Words longer than this are looked up by their grams only, stretch by stretch.
LONGEST = 40
WORD = re.compile(r"[^\W\d_]+")
#: Words whose figures a worker remembers.
REMEMBERED = 300_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def lettered(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def grams_of(word: str, order: int) -> list[str]:
    """Grams of a word with its ends marked; none if the word is shorter than the order."""
    marked = f"^{word}$" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


@dataclass
class Model:
    """Log frequencies: one row of ``words`` or ``grams`` for each entry, one column per language."""

    languages: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[int, dict[str, int]]
    gram_logs: dict[int, np.ndarray]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def unseen(self, word: str) -> np.ndarray:
        """The mean log frequency of the grams of the longest order that knows any."""
        for order in ORDERS:
            table = self.grams.get(order, {})
            known = [table[g] for g in grams_of(word, order) if g in table]
            if known:
                return self.gram_logs[order][known].mean(axis=0)
        return np.zeros(len(self.languages))


class Scorer:
    """A model with the figures of the words met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, np.ndarray] = {}

    def figures(self, word: str) -> np.ndarray:
        at = self.model.words.get(word)
        row = self.model.word_logs[at] if at is not None else self.model.unseen(word)
        row = row - row.max() if len(row) else row
        self.known[word] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not lettered(words) or not self.model.languages:
            return UNKNOWN, 0.0
        if len(self.known) > REMEMBERED:
            self.known.clear()
        tally = Counter(words)
        get, new = self.known.get, self.figures
        rows = [r if (r := get(w)) is not None else new(w) for w in tally]
        total = np.array(list(tally.values()), dtype=float) @ np.array(rows)
        odds = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.model.languages[best], float(odds[best] / odds.sum())


def sampled(docs: DataFrame, docs_each: int, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, text) of about ``docs_each`` documents of each language at most, none of them held out."""
    usable = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out("id", 5, 0))
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}  # one row per language
    share = F.lit(1.0)
    for name, count in counts.items():
        if count > docs_each:
            share = F.when(F.col("lang") == name, F.lit(docs_each / count)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("lang"), F.col("id")), F.lit(1 << 30))
    return usable.where(F.col("text").isNotNull() & (draw < share * float(1 << 30))).select("lang", "text")


def fit(rows: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Count (lang, text) rows, whose number the caller bounds. No rows give a model that knows no language."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, group in frame.groupby("lang"):
                tally: Counter = Counter()
                for text in group["text"]:
                    tally.update(words_of(text))
                if tally:
                    yield pd.DataFrame({"lang": name, "word": list(tally), "n": list(tally.values())})

    def gram_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tally: Counter = Counter()
            for name, word, n in frame.itertuples(index=False):
                for order in ORDERS:
                    for gram in grams_of(word, order):
                        tally[name, order, gram] += n
            if not tally:
                continue
            names, orders, found = zip(*tally, strict=True)
            yield pd.DataFrame({"lang": names, "size": orders, "gram": found, "n": list(tally.values())})

    def commonest(counts: DataFrame, within: list[str], entry: str, most: int) -> list:
        # Ranked by count, ties by the entry; a bounded number per language reaches the driver.
        order = Window.partitionBy(*within).orderBy(F.col("n").desc(), F.col(entry))
        return counts.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most).drop("at").collect()

    tallied = rows.mapInPandas(counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    tallied = materialize(tallied, "language-words")
    sums = {r[0]: r[1] for r in tallied.groupBy("lang").agg(F.sum("n")).collect()}
    languages = sorted(sums)
    column = {name: i for i, name in enumerate(languages)}
    top = commonest(tallied.where(F.length("word") <= LONGEST), ["lang"], "word", words)
    spelt = tallied.mapInPandas(gram_counts, "lang string, size int, gram string, n bigint")
    spelt = spelt.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    parts = commonest(spelt, ["lang", "size"], "gram", grams)

    def table(entries: list[tuple[str, str, int]], totals: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
        at = {e: i for i, e in enumerate(sorted({entry for _, entry, _ in entries}))}
        counts = np.full((len(at), len(languages)), ABSENT)
        for name, entry, n in entries:
            counts[at[entry], column[name]] += n
        return at, np.log(counts / totals)

    known, logs = table([(r["lang"], r["word"], r["n"]) for r in top], np.array([sums[x] for x in languages], dtype=float))
    gram_at, gram_logs = {}, {}
    for order in ORDERS:
        found = [(r["lang"], r["gram"], r["n"]) for r in parts if r["size"] == order]
        totals = np.ones(len(languages))
        for name, _, n in found:
            totals[column[name]] += n
        gram_at[order], gram_logs[order] = table(found, totals)
    return Model(languages, known, logs, gram_at, gram_logs)


def predict(docs: DataFrame, model: Model, text: str = "text", name: str = "found") -> DataFrame:
    """``docs`` with a struct of the predicted language and the share of its odds among all languages.

    ``und`` with score 0 for a null text, one without letters, and where the
    model knows no language. The model goes to each executor once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        trim()
        scorer = held(f"language-{sent.value.name}", lambda: Scorer(sent.value))
        return pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn(name, of(F.col(text)))


def trained(docs: DataFrame, docs_each: int = TRAIN_DOCS) -> Model:
    return fit(sampled(docs, docs_each))


def judged(docs: DataFrame) -> DataFrame:
    """Per document: whether it was held out, the predicted language and its score.

    Null and empty texts, and those without a letter, are ``und`` with score 0. A null id is not held out, and
    never learned from; rows that repeat are judged alike; no rows give no rows; other columns are not read.
    """
    found = predict(docs.select("doc_id", "text"), trained(docs))
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more; columns stay.

    A model that knows no language (no row to learn from had one) tells nothing
    about a text: then only texts without a letter, and null ones, go.
    """
    if not model.languages:

        @F.pandas_udf("boolean")
        def of(texts: pd.Series) -> pd.Series:
            return pd.Series([lettered(words_of(t)) for t in texts], dtype=bool)

        return docs.where(of(F.col(text)))
    name = fresh(docs, "_found")
    found = predict(docs, model, text, name)
    return found.where((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= least)).select(*docs.columns)
