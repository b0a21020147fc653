"""Toxicity by a string-kernel support vector machine.

The string kernel counts the letter triples that two pieces of text share as
subsequences, each worth a power of ``DECAY`` for every place it spans, over the
landmark's norm and the smaller of both: endings that a landmark does not have
cost nothing, and characters put between its letters little. A Gaussian over
the distance keeps each landmark to its own surroundings. Nyström landmarks
(beginnings of words that mark toxic documents, and ordinary words) give every
piece a short vector, and a linear machine is trained on these. Of the sentences
of a toxic document the machine learns the worst piece, chosen anew in each
round; of clean sentences it learns the pieces that the last round took for
bad. A logistic curve over a document's three worst pieces and its length
gives the score.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_share, held_out
from tidemark.session import materialize

#: At most about this many labelled documents of each kind are learned from; chosen by a hash of the id.
TRAIN_TOXIC = 3000
TRAIN_CLEAN = 9000
#: Beginnings of words, pieces that resemble their landmarks, and clean pieces by count, by chance and by
#: score, that reach the driver at most.
CANDIDATES = 4000
MARKED = 6000
ORDINARY = 5000
MISTAKEN = 1500
#: Surprise, in standard deviations and as a share of the largest, above which a beginning may be why a document is toxic.
SURPRISE = 3.5
SURPRISE_SHARE = 0.12
#: A marked piece that stands in so many toxic documents and in no clean one is always learned as bad.
SURE = 4
BEGINNINGS = (4, 9)
LANDMARKS = 64
PLAIN_LANDMARKS = 24
#: Beginnings this alike share a landmark; a piece this like one may be why its document is toxic.
ALIKE = 0.65
WORST = 3
DECAY = 0.6
#: A triple spans at most this many places, so up to four characters between its letters.
SPAN = 7
#: Width of the Gaussian, and the likeness below which it is taken for 0.
WIDTH = 0.3
FLOOR = 0.3
#: Letters that the landmarks may use; any other character matches nothing.
LETTERS = 60
#: Longer pieces are cut into stretches of this length that overlap by half.
STRETCH = 32
ROUNDS = 3
PENALTY = 1.0
#: Pieces whose score a worker remembers.
REMEMBERED = 1_200_000
#: Letters set apart by blanks or marks: at least four of them in a row.
APART = re.compile(r"(?<!\S)(?:[^\W\d_][\s.\-_*]+){3,}[^\W\d_](?!\w)")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")


def sentences(text: str | None) -> list[str]:
    """The text cut after a full stop, exclamation or question mark before white space, and at line ends."""
    return [s for s in SENTENCE.split(text) if s.strip()] if text else []


def pieces(text: str | None) -> list[str]:
    """What stands between white space, long ones in overlapping stretches, and letters set apart, joined.

    No piece crosses a sentence's end but for letters set apart, so a text's pieces are those of its sentences.
    """
    if not text:
        return []
    text = text.lower()
    out = text.split()
    if max(map(len, out), default=0) > STRETCH:
        half = STRETCH // 2
        out = [w[i : i + STRETCH] for w in out for i in range(0, max(1, len(w) - half), half)]
    for apart in APART.findall(text):
        joined = re.sub(r"[\W_]+", "", apart)
        out += [joined[i : i + STRETCH] for i in range(0, max(1, len(joined) - STRETCH // 2), STRETCH // 2)]
    return out


class Kernel:
    """The kernel between any strings and a list of landmarks, for many strings at once."""

    #: Places (second, third) of a triple's letters after its first, and what a triple at these places is worth.
    SHAPES = [(b, c, DECAY ** (c - 2)) for c in range(2, SPAN) for b in range(1, c)]

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        tally: dict[str, int] = {}
        for mark in landmarks:
            for c in filter(str.isalnum, mark):
                tally[c] = tally.get(c, 0) + 1
        letters = sorted(tally, key=lambda c: (-tally[c], c))[:LETTERS]
        # 1 is the start of a string; 0 matches nothing.
        self.base = len(letters) + 2
        self.code = np.zeros(0x110000, np.int8)
        self.code[[ord(c) for c in letters]] = np.arange(2, self.base)
        own = [self.own(mark) for mark in landmarks]
        self.norm = np.array([math.sqrt(sum(v * v for v in found.values())) for found in own])
        entries = sorted((key, worth / max(self.norm[at], 1e-9), at) for at, found in enumerate(own) for key, worth in found.items())
        keys = np.array([e[0] for e in entries], np.int64)
        self.worth = np.array([e[1] for e in entries])
        self.column = np.array([e[2] for e in entries], np.int64)
        used, first, count = np.unique(keys, return_index=True, return_counts=True)
        # Row 0 is of triples that no landmark has.
        self.first, self.count = np.r_[0, first], np.r_[0, count]
        self.row = np.zeros(self.base**3, np.int32)
        self.row[used] = np.arange(1, len(used) + 1)

    def coded(self, strings: list[str]) -> np.ndarray:
        """One row of letter numbers per string, after the mark of its start, with room for a span behind."""
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        out = np.zeros((len(strings), int(lengths.max()) + 1 + SPAN), np.int64)
        out[:, 0] = 1
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(np.arange(len(strings)), lengths), at + 1] = self.code[np.frombuffer("".join(strings).encode("utf-32-le"), "<u4")]
        return out

    def triples(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each shape the triples of all strings, -1 where one of the letters matches nothing."""
        width = codes.shape[1] - SPAN
        a, none = codes[:, :width] * self.base**2, codes == 0
        for second, third, worth in self.SHAPES:
            key = a + codes[:, second : second + width] * self.base + codes[:, third : third + width]
            bad = none[:, :width] | none[:, second : second + width] | none[:, third : third + width]
            yield key, ~bad, worth

    def own(self, string: str) -> dict[int, float]:
        """Each triple of a string and what it is worth in all."""
        found: dict[int, float] = {}
        for key, good, worth in self.triples(self.coded([string])):
            for k in key[good].tolist():
                found[k] = found.get(k, 0.0) + worth
        return found

    def likeness(self, strings: list[str]) -> np.ndarray:
        """The string kernel over the norms, strings by landmarks; values below ``FLOOR`` are not exact."""
        size = len(self.landmarks)
        total, square = np.zeros(len(strings) * size), np.zeros(len(strings))
        codes = self.coded(strings)
        for key, good, worth in self.triples(codes):
            square += good.sum(axis=1) * worth**2
            row = np.where(good, self.row[key], 0)
            place, at = np.nonzero(row)
            if len(place):
                row = row[place, at]
                count = self.count[row]
                entry = np.repeat(self.first[row] - np.cumsum(count) + count, count) + np.arange(count.sum())
                total += np.bincount(np.repeat(place, count) * size + self.column[entry], self.worth[entry] * worth, len(total))
        total = total.reshape(len(strings), size)
        # Without triples that repeat in a string its norm is too small and the likeness too large, so nothing is missed here.
        out = total / np.maximum(np.minimum(np.sqrt(square)[:, None], self.norm), 1e-9)
        near = np.flatnonzero(out.max(axis=1, initial=0) >= FLOOR)
        if len(near):
            parts = [(*np.nonzero(good), key[good], worth) for key, good, worth in self.triples(codes[near])]
            whole = np.concatenate([place * self.base**3 + key for place, _, key, _ in parts])
            worth = np.concatenate([np.full(len(key), worth) for _, _, key, worth in parts])
            order = np.argsort(whole, kind="stable")
            whole, worth = whole[order], worth[order]
            first = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
            square = np.bincount(whole[first] // self.base**3, np.add.reduceat(worth, first) ** 2, len(near))
            out[near] = total[near] / np.maximum(np.minimum(np.sqrt(square)[:, None], self.norm), 1e-9)
        return out

    def __call__(self, strings: list[str]) -> np.ndarray:
        """Kernel values, strings by landmarks, in blocks of like length."""
        out = np.zeros((len(strings), len(self.landmarks)))
        order = sorted(range(len(strings)), key=lambda i: len(strings[i]))
        for start in range(0, len(order) if self.landmarks else 0, 512):
            some = order[start : start + 512]
            near = self.likeness([strings[i] for i in some])
            out[some] = np.where(near >= FLOOR, np.exp((np.minimum(near, 1.0) - 1) / WIDTH), 0.0)
        return out


@dataclass
class Model:
    """Landmarks, the map to the machine's space, the machine and its calibration."""

    kernel: Kernel
    inward: np.ndarray
    weights: np.ndarray
    bias: float
    #: Of the logistic curve: over the worst pieces' values, the logarithm of the number of pieces, and 1.
    curve: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def values(self, strings: list[str]) -> np.ndarray:
        """The machine's value of each piece."""
        if not len(self.weights):
            return np.zeros(len(strings))
        return self.kernel(strings) @ (self.inward @ self.weights) + self.bias


class Scorer:
    """A model with the values of the pieces met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def figures(self, texts: list[str | None]) -> np.ndarray:
        """Per text: the values of its worst distinct pieces, the worst first, the logarithm of its pieces, and 1."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out, get = np.full((len(texts), WORST + 2), self.model.bias), self.known.get
        for start in range(0, len(texts), 64):
            cut = [set(pieces(t)) for t in texts[start : start + 64]]
            new = iter(set().union(*cut).difference(self.known))
            while block := list(islice(new, 8192)):
                self.known.update(zip(block, self.model.values(block).tolist(), strict=True))
            for at, found in enumerate(cut, start):
                worst = sorted(map(get, found), reverse=True)[:WORST]
                out[at, : len(worst)] = worst
                out[at, WORST:] = math.log1p(len(found)), 1.0
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.figures(texts) @ self.model.curve, -30, 30)))


#: The scorer that a worker is using, by its model's name.
_scorers: dict[str, Scorer] = {}


def machine(x: np.ndarray, y: np.ndarray, penalty: float, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps; ``y`` is 1 or -1."""
    full = np.c_[x, np.ones(len(x))]
    w = np.zeros(full.shape[1])
    keep = np.r_[np.ones(x.shape[1]), 1e-6]
    for _ in range(30):
        inside = y * (full @ w) < 1
        near = full[inside] * weight[inside, None]
        gradient = keep * w - penalty * near.T @ (y[inside] - full[inside] @ w)
        if np.abs(gradient).max() < 1e-6 * len(y):
            break
        w = w - np.linalg.solve(np.diag(keep) + penalty * near.T @ full[inside], gradient)
    return w[:-1], float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> DataFrame:
    """(id, text, label) of a bounded number of labelled documents of each kind, none of them held out.

    Of labels that disagree the larger counts; of equal texts with equal labels one stays.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 5, 0))
    bad, count = usable.agg(F.count_if(F.col("toxic") > 0), F.count(F.lit(1))).first()
    chosen = hashed_share(usable.where("toxic > 0"), "doc_id", toxic / max(bad, 1)).unionByName(
        hashed_share(usable.where("toxic <= 0"), "doc_id", clean / max(count - bad, 1))
    )
    chosen = chosen.groupBy(F.col("doc_id").alias("_labelled")).agg(F.max("toxic").cast("int").alias("label"))
    found = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), F.col("id") == F.col("_labelled"))
    return found.select("id", "text", "label").dropDuplicates(["text", "label"])


def fit(rows: DataFrame, landmarks: int = LANDMARKS) -> Model:
    """Train on (id, text, label) rows, whose number the caller bounds. Without toxic rows nothing is toxic.

    Every document's sentences are cut into pieces. Pieces that stand in toxic
    documents far oftener than chance come to the driver with their counts, a
    bounded number of them, along with a bounded number of ordinary ones.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, text, label in frame.itertuples(index=False):
                found = sorted({p for s in sentences(text) for p in pieces(s)} | set(pieces(text)))
                if found:
                    yield pd.DataFrame({"id": at, "label": label, "piece": found})

    listed = rows.select("id", "text", "label").mapInPandas(cut, "id bigint, label int, piece string").distinct()
    listed = materialize(listed, "toxic-pieces")
    bad, good = rows.select("id", "label").distinct().agg(F.count_if(F.col("label") > 0), F.count_if(F.col("label") <= 0)).first()
    nothing = Model(Kernel([]), np.zeros((0, 0)), np.zeros(0), 0.0, np.array([0.0] * (WORST + 1) + [-4.0]))
    if not bad or not good:
        return nothing
    in_bad, in_good = F.count_if(F.col("label") > 0).cast("double").alias("bad"), F.count_if(F.col("label") <= 0).cast("double").alias("good")
    counts = materialize(listed.groupBy("piece").agg(in_bad, in_good), "toxic-counts")
    low, high = BEGINNINGS
    begun = listed.where(F.length("piece") >= low).withColumn("size", F.explode(F.sequence(F.lit(low), F.least(F.lit(high), F.length("piece")))))
    begun = begun.select("id", "label", F.expr("substring(piece, 1, size)").alias("piece")).distinct().groupBy("piece").agg(in_bad, in_good)
    # How surely a beginning is commoner in toxic documents than their share lets expect.
    share = bad / (bad + good)
    expected = (F.col("bad") + F.col("good")) * share
    begun = begun.withColumn("surprise", (F.col("bad") - expected) / F.sqrt(expected * (1 - share) + 0.25))
    begun = begun.where(F.col("surprise") > SURPRISE).orderBy(F.col("surprise").desc(), F.length("piece").desc(), "piece").limit(CANDIDATES)
    left = begun.collect()
    left = [r["piece"] for r in left if r["surprise"] >= SURPRISE_SHARE * left[0]["surprise"]]
    clean = counts.where("good > 0")
    common = clean.orderBy(F.col("good").desc(), "piece").limit(ORDINARY).collect()
    drawn = clean.orderBy(F.xxhash64("piece"), "piece").limit(ORDINARY).collect()
    ordinary = {r["piece"]: r["good"] for r in [*common, *drawn]}

    # Landmarks: the surest beginning first, then always the surest that the chosen ones do not resemble yet.
    chosen: list[str] = []
    while len(chosen) < landmarks and left:
        chosen.append(left[0])
        near = Kernel(chosen[-1:]).likeness(left)[:, 0]
        left = [p for p, likeness in zip(left[1:], near[1:], strict=True) if likeness < ALIKE]
    if not chosen or not ordinary:
        return nothing
    plain = [r["piece"] for r in common if len(r["piece"]) > 3 and r["piece"].isalpha()]
    kernel = Kernel(chosen + plain[:: max(1, len(plain) // PLAIN_LANDMARKS)][:PLAIN_LANDMARKS])
    base = kernel(kernel.landmarks)
    values, vectors = np.linalg.eigh((base + base.T) / 2)
    sound = values > 1e-6 * values.max()
    inward = vectors[:, sound] / np.sqrt(values[sound])

    def resembling(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Kernel(chosen)
        for frame in frames:
            most = own(frame["piece"].to_list()).max(axis=1, initial=0)
            kept = frame[most >= math.exp((ALIKE - 1) / WIDTH)]
            yield pd.DataFrame({name: kept[name].to_list() for name in kept}).astype({"bad": "float64", "good": "float64"})

    marked = counts.where("bad > 0").mapInPandas(resembling, counts.schema).orderBy(F.col("bad").desc(), "piece").limit(MARKED)
    marked = marked.collect()
    sure = np.array([r["bad"] if r["bad"] >= SURE and not r["good"] else 0 for r in marked])
    marked = [r["piece"] for r in marked]
    if not marked:
        return nothing

    # Pieces of toxic documents that may be why they are toxic.
    wanted = listed.where("label > 0").join(F.broadcast(counts.sparkSession.createDataFrame([(p,) for p in marked], "piece string")), "piece")
    bags = wanted.groupBy("id").agg(F.collect_set("piece").alias("pieces")).collect()  # at most TRAIN_TOXIC rows
    at = {p: i for i, p in enumerate(marked)}
    bags = [sorted(at[p] for p in bag["pieces"]) for bag in bags]
    similar = Kernel(chosen)(marked).max(axis=1)
    x_bad = kernel(marked) @ inward
    worst = np.array([bag[int(np.argmax(similar[bag]))] for bag in bags])
    for turn in range(ROUNDS):
        names = list(ordinary)
        x_good = kernel(names) @ inward
        times = np.maximum(np.bincount(worst, minlength=len(marked)), sure)
        picked = np.flatnonzero(times)
        x = np.r_[x_bad[picked], x_good]
        y = np.r_[np.ones(len(picked)), -np.ones(len(names))]
        weights, bias = machine(x, y, PENALTY, np.r_[times[picked].astype(float), [ordinary[p] for p in names]])
        value = x_bad @ weights
        worst = np.array([bag[int(np.argmax(value[bag]))] for bag in bags])
        if turn < ROUNDS - 1:
            ordinary |= mistaken(clean, Model(kernel, inward, weights, bias, np.zeros(WORST + 2)))
    model = Model(kernel, inward, weights, bias, np.zeros(WORST + 2))
    return calibrated(model, rows)


def mistaken(clean: DataFrame, model: Model) -> dict[str, float]:
    """The pieces of clean documents that the model takes for the worst, a bounded number, with their counts."""

    def valued(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = frame["piece"].to_list()
            yield pd.DataFrame({"piece": found, "good": frame["good"].to_numpy(), "value": model.values(found)})

    found = clean.select("piece", "good").mapInPandas(valued, "piece string, good double, value double")
    return {r["piece"]: r["good"] for r in found.orderBy(F.col("value").desc(), "piece").limit(MISTAKEN).collect()}


def calibrated(model: Model, rows: DataFrame) -> Model:
    """The model with the logistic curve that best maps its documents' figures to their labels."""

    def valued(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for frame in frames:
            yield pd.DataFrame({"x": list(scorer.figures(frame["text"].to_list())), "label": frame["label"]})

    known = rows.select("text", "label").mapInPandas(valued, "x array<double>, label int").collect()  # a few numbers for each row of the sample
    x, y = np.array([r["x"] for r in known]), np.array([float(r["label"] > 0) for r in known])
    keep, w = np.array([0.05] * (WORST + 1) + [0.0]), np.zeros(WORST + 2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - keep * w
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(keep + 1e-9), gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return Model(model.kernel, model.inward, model.weights, model.bias, w)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the chance that a document is toxic, over its whole text.

    Null and empty texts get the score of a text without pieces, the same for all. The model goes to each executor once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        scorer = _scorers.get(sent.value.name)
        if scorer is None:
            _scorers.clear()
            scorer = _scorers[sent.value.name] = Scorer(sent.value)
        return pd.Series(scorer.scores(texts.to_list()), dtype=float)

    return docs.withColumn(name, of(F.col(text)))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it was held out, its score and the predicted label.

    Null and empty texts get the score of a text without pieces. A null id is not held out, and never
    learned from; rows that repeat are scored alike; no rows give no rows; other columns are not read.
    """
    model = fit(materialize(labelled(docs, labels), "toxic-rows"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
