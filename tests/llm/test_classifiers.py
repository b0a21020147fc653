"""Toxicity, quality and language: held-out accuracy and awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tidemark.llm import language, quality, toxicity
from tidemark.llm.common import table

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, FOLDER, "labels")


def accuracy(scored, labels, name):
    known = scored.where("held_out").join(labels, "doc_id").select("predicted", name).toPandas()
    return (known.predicted == known[name]).mean()


def test_quality(docs, labels):
    scored = quality.judged(docs, labels)
    assert accuracy(scored, labels, "quality") > 0.98
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity(docs, labels):
    scored = toxicity.judged(docs, labels)
    assert accuracy(scored, labels, "toxic") > 0.97
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_gapped_insults():
    kernel = toxicity.Kernel(["idiot", "window"])
    plain, gapped, doubled, ending, other = kernel.likeness(["idiot", "i.d.i.o.t", "idiiot", "idiots", "garden"])[:, 0]
    assert plain > 0.999 and ending > 0.999 and gapped > 0.6 and doubled > 0.7 and other < 0.3
    assert "idiot" in toxicity.pieces("what an i d i o t this is") and "idiot" in toxicity.pieces("an i-d-i-o-t")


def test_kernel_is_the_definition():
    """Against a count of shared subsequences of three characters, start mark included."""

    def features(s, letters):
        s, out = "^" + s, {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    if all(c in letters for c in (s[i], s[j], s[k])):
                        key = s[i] + s[j] + s[k]
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    marks, strings = ["stupid", "rivers"], ["stuupid", "river", "rivriv", "sunrise"]
    letters = set("^" + "".join(marks))
    got = toxicity.Kernel(marks).likeness(strings)
    for a, row in zip(strings, got, strict=True):
        for b, value in zip(marks, row, strict=True):
            x, y = features(a, letters), features(b, letters)
            norm = lambda f: sum(v * v for v in f.values()) ** 0.5
            want = sum(v * y.get(k, 0) for k, v in x.items()) / (norm(y) * min(norm(x), norm(y)))
            assert value == pytest.approx(want) if want >= toxicity.FLOOR else value < toxicity.FLOOR + 1e-9 or value >= want


def test_isotonic():
    out = quality.isotonic(np.array([0.0, 0.4, 0.2, 0.9, 0.8, 1.0]), np.array([1.0, 1.0, 3.0, 1.0, 1.0, 1.0]))
    assert np.allclose(out, [0, 0.25, 0.25, 0.85, 0.85, 1])


def test_language(docs):
    scored = language.judged(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (scored.lang == scored.lang_pred).mean() > 0.99


def test_backoff_to_grams(spark):
    rows = spark.createDataFrame([("aa", "lorum ipsom lorum"), ("bb", "wexly quarz wexly")], "lang string, text string")
    model = language.fit(rows)
    scorer = language.Scorer(model)
    assert scorer.predict("lorumly") [0] == "aa" and scorer.predict("quarzes")[0] == "bb"
    assert scorer.predict("12 !!") == ("und", 0.0) == scorer.predict(None) == scorer.predict("²")


def test_awkward_rows(spark, awkward, empty, labels):
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, 1, 1), (6, 0, 1), (6, 1, 0), (9, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    none = marks.where("false")
    for frame in (awkward, empty):
        for known in (marks, none):
            for scored in (quality.judged(frame, known), toxicity.judged(frame, known)):
                got = scored.collect()
                assert len(got) == frame.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
        found = language.judged(frame).collect()
        assert len(found) == frame.count()
        for r in found:
            assert r["doc_id"] not in (2, 3, 4, 11) or (r["lang_pred"], r["score"]) == ("und", 0.0)


def test_held_out_rule(awkward):
    for r in language.judged(awkward).collect():
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_filters_keep_columns(spark, awkward, labels):
    kept = language.accepted(awkward, language.trained(awkward))
    assert kept.columns == awkward.columns
    assert not {2, 3, 4, 11} & {r["doc_id"] for r in kept.collect()}
