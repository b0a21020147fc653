"""Quality scores from document statistics.

Random Fourier features of the standardised statistics approximate a Gaussian
kernel; ridge scores are fitted on them by normal equations that each partition
sums for itself; isotonic calibration turns ridge scores into probabilities.
"""

from __future__ import annotations

import functools
import math
import sys
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_share, held_out, trim
from tidemark.operators.ranking import fresh
from tidemark.session import materialize

#: At most about this many labelled rows are learned from; chosen by a hash of the id, the same in every run.
TRAIN_ROWS = 40_000
FEATURES = 320
RIDGE = 3e-4
#: Kernel width: squared distances of standardised statistics are divided by twice this number times their count.
WIDTH = 1.0
BINS = 2048
SEED = 20
#: Partitions that sum normal equations.
PARTS = 8

ENDS = np.array([ord(mark) for mark in ".!?"], dtype=np.uint32)
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL = range(6)


@functools.lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of each code point, by its Unicode category."""
    table = np.full(sys.maxunicode + 1, SYMBOL, np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))
        if kind == "Lu":
            table[code] = UPPER
        elif kind[0] in "LM":
            table[code] = LOWER
        elif kind[0] == "N":
            table[code] = DIGIT
        elif kind[0] == "Z" or code in (9, 10, 11, 12, 13):
            table[code] = SPACE
    for mark in ".,;:'’-":
        table[ord(mark)] = STOP
    return table


STATISTICS = (
    "words", "word_length", "word_spread", "upper", "digits", "spaces", "stops", "symbols", "distinct", "commonest",
    "pairs", "lines", "repeated_lines", "entropy", "deflated", "longest_run", "capitals", "odd_ends", "sentence",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, one pass each; all 0 for a null or empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kinds = character_classes()[codes]
    share = np.bincount(kinds, minlength=6) / len(codes)
    inside = np.r_[False, kinds != SPACE, False]
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    lengths = ends - starts if len(starts) else np.zeros(1)
    last, last_kind = codes[ends - 1], kinds[ends - 1]
    words = text.split()
    count = max(1, len(words))
    tally = Counter(words)
    number = dict(zip(tally, range(len(tally)), strict=True))
    order = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = np.unique(order[:-1] * len(tally) + order[1:], return_counts=True)[1]
    longest = int(np.diff(np.r_[-1, np.flatnonzero(np.diff(order)), len(words) - 1]).max()) if words else 0
    lines = [x for x in text.split("\n") if x.strip()]
    frequency = np.bincount(codes & 0xFF) / len(codes)
    frequency = frequency[frequency > 0]
    raw = text.encode()
    return [
        math.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        share[UPPER],
        share[DIGIT],
        share[SPACE],
        share[STOP],
        share[SYMBOL],
        len(tally) / count**0.8,
        max(tally.values(), default=0) / count,
        int(pairs[pairs > 1].sum()) / count,
        math.log1p(len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        float(-(frequency * np.log2(frequency)).sum()),
        len(zlib.compress(raw, 1)) / len(raw),
        longest / count + math.log1p(longest),
        sum(map(str.isupper, words)) / count,
        int((last_kind == SYMBOL).sum()) / count,
        math.log1p(count / (1 + int(np.isin(last, ENDS).sum()))),
    ]


@dataclass
class Model:
    """A fitted scorer; a few hundred numbers, whatever the size of the corpus."""

    mean: np.ndarray
    spread: np.ndarray
    turns: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return np.c_[np.cos(z @ self.turns + self.shifts) * math.sqrt(2 / len(self.shifts)), np.ones(len(x))]

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.lifted(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities; a trace of the ridge score keeps their order inside a calibrated step."""
        ridge = self.ridge(x)
        if not len(self.knots):
            return np.full(len(x), 0.5)
        return np.clip(0.998 * np.interp(ridge, self.knots, self.levels) + 0.002 / (1 + np.exp(-4 * (ridge - 0.5))), 0, 1)


def isotonic(means: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence to weighted means: pool neighbours that are out of order."""
    blocks: list[list[float]] = []
    for mean, weight in zip(means, weights, strict=True):
        blocks.append([mean, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, n = blocks.pop()
            last = blocks[-1]
            last[0], last[1], last[2] = (last[0] * last[1] + m * w) / (last[1] + w), last[1] + w, last[2] + n
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def measured(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with the array of statistics of each text."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return docs.withColumn(name, of(F.col(text)))


def labelled(docs: DataFrame, labels: DataFrame, label: str, divisor: int, rest: int, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, label) of about ``rows`` labelled documents at most, none of them held out.

    The chosen labels are bounded by ``rows``, so they go to every task and the
    documents are read once, in place. Of labels that disagree the larger counts.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key, divisor, rest))
    count = usable.count()
    chosen = hashed_share(usable, key, rows / max(count, 1)).groupBy(F.col(key).alias("_labelled")).agg(F.max(label).cast("int").alias("_label"))
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("_labelled")).select(
        "id", "text", F.col("_label").alias("label")
    )


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """Fit on (text, label) rows, whose number the caller bounds. No rows, or one label only, give a constant score."""
    known = materialize(measured(rows.select("text", "label"), "text", "x").select("x", "label"), "quality-rows")
    width = len(STATISTICS)
    moments = known.agg(
        F.count(F.lit(1)),
        F.array(*(F.avg(F.col("x")[i]) for i in range(width))),
        F.array(*(F.stddev_pop(F.col("x")[i]) for i in range(width))),
    ).first()
    generator = np.random.default_rng(SEED)
    mean = np.array([m or 0.0 for m in moments[1]])
    spread = np.array([s if s and s > 1e-9 else 1.0 for s in moments[2]])
    turns = generator.normal(0, 1 / math.sqrt(WIDTH * width), (width, features))
    model = Model(mean, spread, turns, generator.uniform(0, 2 * math.pi, features), np.zeros(features + 1), np.empty(0), np.empty(0))
    if not moments[0]:
        return model

    def equations(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for frame in frames:
            z = model.lifted(np.array(frame["x"].to_list()))
            gram += z.T @ z
            right += z.T @ frame["label"].to_numpy(float)
        yield pd.DataFrame({"gram": [gram.tobytes()], "right": [right.tobytes()]})

    gram, right = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
    for part in known.repartition(PARTS).mapInPandas(equations, "gram binary, right binary").collect():  # PARTS rows
        gram += np.frombuffer(part["gram"]).reshape(gram.shape)
        right += np.frombuffer(part["right"])
    model.weights = np.linalg.solve(gram + ridge * moments[0] * np.eye(features + 1), right)

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = model.ridge(np.array(frame["x"].to_list()))
            yield pd.DataFrame({"bin": np.floor(np.clip(found, -1, 2) * BINS).astype(int), "label": frame["label"].astype("int64")})

    bins = known.mapInPandas(binned, "bin bigint, label bigint").groupBy("bin").agg(F.sum("label"), F.count(F.lit(1))).collect()  # 3 * BINS rows at most
    bins.sort()
    at, ones, counts = (np.array(c, dtype=float) for c in zip(*bins, strict=True))
    # One label of each kind at the ends keeps the levels off 0 and 1.
    model.knots = np.r_[at[0] / BINS - 1e-3, (at + 0.5) / BINS, at[-1] / BINS + 1e-3 + 1 / BINS]
    levels = isotonic(np.r_[0.0, ones / counts, 1.0], np.r_[1.0, counts, 1.0])
    model.levels = levels
    return model


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that a document is good. Null and empty texts are scored like any other."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        trim()
        return pd.Series(model.score(np.array([statistics(t) for t in texts])) if len(texts) else [], dtype=float)

    return docs.withColumn(name, of(F.col(text)))


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    return fit(labelled(docs, labels, "quality", 3, 1, rows))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it was held out, its score and the predicted label.

    Null texts count as empty ones, which have a score like any. A null id is not held out, and never
    learned from; rows that repeat are scored alike; no rows give no rows; other columns are not read.
    """
    scored = score(docs.select("doc_id", "text"), trained(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more; columns stay, whatever their names.

    Null and empty texts are scored as such; rows that repeat stay or go together; an empty table stays empty.
    """
    name = fresh(docs, "_score")
    return score(docs, model, text, name).where(F.col(name) >= least).select(*docs.columns)
