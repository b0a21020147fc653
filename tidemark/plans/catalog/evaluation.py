"""Scores of predictions against the truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import CLASS_SCORES
from tidemark.operators import evaluate as ev
from tidemark.operators.location import knn_authority
from tidemark.operators.ranking import keyed_hash
from tidemark.plans.catalog import query
from tidemark.plans.catalog.common import rounded
from tidemark.plans.catalog.scans import REPORT_SQL, guessed_classes
from tidemark.plans.catalog.spatial import authority_sql
from tidemark.sources.views import Views

HASH = "(('0x' || substr(md5(cast(k as varchar) || ':42'), 1, 12))::bigint % 1000003)"
GUESS = f"p as (select riskLabel as t, cast(1 + {HASH} % 7 as int) as p from unit)"


@query(
    "evl2_confusion_matrix",
    f"""with {GUESS} select cast(a.i as int) as truth, cast(b.i as int) as prediction,
        (select count(*) from p where t = a.i and p.p = b.i) as count from range(1, 8) a(i), range(1, 8) b(i)""",
    ("unit",),
)
def evl2(v: Views):
    return ev.confusion_matrix(guessed_classes(v), "riskLabel", "guess")


@query("evl3_classification_report", REPORT_SQL, ("unit",))
def evl3(v: Views):
    report = ev.classification_report(guessed_classes(v), "riskLabel", "guess")
    return rounded(report, 9, "precision", "recall", "f1")


FLAGS = f"p as (select historicallyFlooded = 1 as t, {HASH} % 3 = 0 as p from unit)"


@query(
    "evl4_binary_metrics",
    f"""with {FLAGS}, c as (select count(*) filter (p and t) as tp, count(*) filter (p and not t) as fp,
          count(*) filter (not p and not t) as tn, count(*) filter (not p and t) as fn from p)
        select *, round(tp * 1.0e0 / (tp + fp), 9) as precision, round(tp * 1.0e0 / (tp + fn), 9) as recall,
          round((tp + tn) * 1.0e0 / (tp + tn + fp + fn), 9) as accuracy, round(2.0e0 * tp / (2 * tp + fp + fn), 9) as f1 from c""",
    ("unit",),
)
def evl4(v: Views):
    df = v.unit.select("historicallyFlooded", (F.pmod(keyed_hash(F.col("k")), F.lit(3)) == 0).alias("p"))
    return rounded(ev.binary_metrics(df, "historicallyFlooded", "p"), 9, "precision", "recall", "accuracy", "f1")


SCORES = ", ".join(
    f"({p}, {t}, {s})" for p, row in enumerate(CLASS_SCORES, 1) for t, s in enumerate(row, 1)
)


@query(
    "evl5_class_score",
    f"""with {GUESS}, s(p, t, score) as (values {SCORES}) select cast(sum(score) as bigint) as score,
        round(avg(score), 9) as mean_score from p join s using (p, t)""",
    ("unit",),
)
def evl5(v: Views):
    return rounded(ev.class_score(guessed_classes(v), "riskLabel", "guess"), 9, "mean_score")


PRICE = f"""p as (select medianPrice as t, case when k % 6 <> 0 then 200000 + {HASH} % 500000 * 1.0e0 end as p from unit)"""


def guessed_prices(v: Views):
    guess = 200000 + F.pmod(keyed_hash(F.col("k")), F.lit(500000)).cast("double")
    return v.unit.select("medianPrice", F.when(F.col("k") % 6 != 0, guess).alias("guess"))


@query(
    "evl6_price_errors",
    f"""with {PRICE} select round(sqrt(avg((p - t) * (p - t))), 6) as rmse, count(*) filter (p is null and t is not null) as missing_prediction,
        count(*) filter (p is null and t is null) as missing_both from p""",
    ("unit",),
)
def evl6(v: Views):
    return rounded(ev.price_errors(guessed_prices(v), "medianPrice", "guess"), 6, "rmse")


@query(
    "evl7_regression_metrics",
    f"""with {PRICE}, c as (select * from p where p is not null and t is not null)
        select round(sqrt(avg((p - t) * (p - t))), 6) as rmse, round(avg(abs(p - t)), 6) as mae,
          round(1 - sum((p - t) * (p - t)) / (var_pop(t) * count(*)), 9) as r2 from c""",
    ("unit",),
)
def evl7(v: Views):
    table = ev.regression_metrics(guessed_prices(v), "medianPrice", "guess")
    return rounded(rounded(table, 6, "rmse", "mae"), 9, "r2")


@query(
    "evl8_authority_accuracy",
    f"""with q as (select postcode as qid, easting, northing from unlabelled), {authority_sql("q")}
        select round(avg(case when u.localAuthority = a.localAuthority then 1.0e0 else 0.0e0 end), 9) as accuracy, count(*) as n
        from unlabelled u join vote a on u.postcode = a.qid""",
    ("labelled", "unlabelled"),
)
def evl8(v: Views):
    near = v.unlabelled.select(F.col("postcode").alias("qid"), "easting", "northing")
    guess = knn_authority(near, v.labelled, "qid").select(F.col("qid").alias("postcode"), F.col("localAuthority").alias("guess"))
    df = v.unlabelled.select("postcode", "localAuthority").join(guess, "postcode")
    return rounded(ev.accuracy(df, "localAuthority", "guess"), 9, "accuracy")
