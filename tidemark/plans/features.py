"""Feature stages of the model pipelines.

Fill values and scales are fitted by aggregates with exact quantiles and put
into the pipeline as literals of one SQL stage, so a fitted pipeline can be
saved, and applies the training statistics to any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import NEAR_WATERCOURSE, NEAR_WATERCOURSE_METRES, NO_WATERCOURSE
from tidemark.operators.quantiles import exact_quantiles, modes, scalars
from tidemark.plans.dictionary import one_hot_stages

WATERCOURSE_RULE = (
    "coalesce(nearestWatercourse, case when distanceToWatercourse < "
    f"{NEAR_WATERCOURSE_METRES} then '{NEAR_WATERCOURSE}' else '{NO_WATERCOURSE}' end)"
)


def _number(value: float) -> str:
    return f"cast('{value!r}' as double)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _numeric_parts(df: DataFrame, standard: Sequence[str], spread: Sequence[str], robust: Sequence[str]) -> list[str]:
    """SQL per numeric feature: fill with the median, then centre and scale."""
    cols = [*standard, *spread, *robust]
    cut = scalars(exact_quantiles(df, cols, [0.25, 0.5, 0.75])) if cols else {}
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit((cut[c] or [0.0] * 3)[1])) for c in cols}
    aggs = [fn(filled[c]).alias(f"{name}:{c}") for c in standard for name, fn in (("mid", F.avg), ("len", F.stddev_pop))]
    aggs += [fn(filled[c]).alias(f"{name}:{c}") for c in spread for name, fn in (("mid", F.min), ("len", F.max))]
    facts = scalars(df.agg(*aggs)) if aggs else {}
    parts = []
    for c in cols:
        low, middle, high = cut[c] or (0.0, 0.0, 0.0)
        if c in robust:
            centre, scale = middle, high - low
        else:
            centre, scale = facts[f"mid:{c}"] or 0.0, facts[f"len:{c}"] or 0.0
            scale = scale - centre if c in spread else scale
        value = f"coalesce(cast(`{c}` as double), {_number(middle)})"
        parts.append(f"({value} - {_number(centre)}) / {_number(scale or 1.0)} as `f_{c}`")
    return parts


def feature_stages(
    df: DataFrame,
    standard: Sequence[str] = (),
    spread: Sequence[str] = (),
    robust: Sequence[str] = (),
    categorical: Sequence[str] = (),
    guess_watercourse: bool = False,
    output: str = "features",
) -> list:
    """Fitted SQL stage, then category codes from a table, one-hot and assemble.

    Categories are kept in sorted order; a value unseen in training becomes all
    zeros. ``standard`` columns are standardised, ``spread`` ones scaled to
    0..1 and ``robust`` ones by median and interquartile range.
    """
    numeric = [*standard, *spread, *robust]
    parts = _numeric_parts(df, standard, spread, robust)
    if categorical:
        rules = {"nearestWatercourse": WATERCOURSE_RULE} if guess_watercourse else {}
        common = scalars(modes(df, list(categorical)))
        for c in categorical:
            fill = common[c]
            value = rules.get(c, f"`{c}`")
            parts.append(f"coalesce({value}, {_text(fill) if fill is not None else 'cast(null as string)'}) as `f_{c}`")
    filled = SQLTransformer(statement=f"select *, {', '.join(parts)} from __THIS__")
    stages: list = [filled]
    if categorical:
        names = [[f"{kind}_{c}" for c in categorical] for kind in ("f", "i", "h")]
        stages += one_hot_stages(filled.transform(df).select(*names[0]), *names)
    inputs = [f"f_{c}" for c in numeric] + [f"h_{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"))
    return stages


def transform_only(model: Transformer | PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Apply a fitted pipeline and keep the named columns only."""
    return model.transform(df).select(*keep)
