"""ML10: the feature code as pipeline stages, so that a saved pipeline takes raw rows.

Stages keep all columns of their input and add or replace their own.  Fitted values are
params, so every stage is written with the pipeline (JSON beside MLlib's own stages) and
loaded by name in any session that can import this package.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pose, scale, select
from .models import complete


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Written as class name and params."""


class PolynomialTerms(Transformer, HasInputCols, _Saved):
    """T5: adds every monomial of ``inputCols`` from degree 2 up to ``degree``."""

    degree = Param(Params._dummy(), "degree", "highest degree", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, degree=2):
        super().__init__()
        self._setDefault(degree=2)
        self._set(**self._input_kwargs)

    def names(self) -> list[str]:
        return [n for n, combo in select.polynomial_terms(self.getInputCols(), self.getOrDefault(self.degree)) if len(combo) > 1]

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for name, combo in select.polynomial_terms(self.getInputCols(), self.getOrDefault(self.degree)):
            if len(combo) > 1:
                e = F.col(combo[0]).cast("double")
                for c in combo[1:]:
                    e = e * F.col(c).cast("double")
                new[name] = e
        return df.withColumns(new)


class PoseFeatures(Transformer, _Saved):
    """Adds the feature row of a pose array (``layout`` 33: see ``pose.POSE33``)."""

    inputCol = Param(Params._dummy(), "inputCol", "pose array", TypeConverters.toString)
    layout = Param(Params._dummy(), "layout", "name of the skeleton in ferrule.operators.pose", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="features", layout="POSE33"):
        super().__init__()
        self._setDefault(inputCol="features", layout="POSE33")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return pose.feature_row(df, self.getOrDefault(self.inputCol), getattr(pose, self.getOrDefault(self.layout)), keep=df.columns)


class AffineScaleModel(Model, HasInputCols, _Saved):
    """(x - shift) / width per column."""

    shift = Param(Params._dummy(), "shift", "subtracted", TypeConverters.toListFloat)
    width = Param(Params._dummy(), "width", "divisor", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, shift=None, width=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(w)
                               for c, m, w in zip(self.getInputCols(), self.getOrDefault(self.shift), self.getOrDefault(self.width))})


class StandardScale(Estimator, HasInputCols, _Saved):
    """Mean and deviation (ddof 0, zero -> 1) of the rows that it is fitted on."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> AffineScaleModel:
        cols = self.getInputCols()
        r = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return AffineScaleModel(inputCols=cols, shift=[float(r[f"m{i}"] or 0.0) for i in range(len(cols))], width=[float(r[f"s{i}"] or 1.0) for i in range(len(cols))])


class RobustScale(Estimator, HasInputCols, _Saved):
    """Exact median and interquartile range (zero -> 1)."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> AffineScaleModel:
        cols = self.getInputCols()
        q = {r["column"]: r for r in scale.quantile_wide(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]), cols, {"med": 0.5, "q1": 0.25, "q3": 0.75}).collect()}
        width = [float(q[c]["q3"] - q[c]["q1"]) if c in q else 1.0 for c in cols]
        return AffineScaleModel(inputCols=cols, shift=[float(q[c]["med"]) if c in q else 0.0 for c in cols], width=[w or 1.0 for w in width])


class RbfModel(Model, HasInputCols, _Saved):
    """Adds rbf0, rbf1, ...: exp(-|x - c|^2 / (2 sigma^2)) of the fitted centroids."""

    centroids = Param(Params._dummy(), "centroids", "JSON list of centroids", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, centroids=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return scale.rbf_features(df, self.getInputCols(), json.loads(self.getOrDefault(self.centroids)), keep=df.columns)


class RbfFeatures(Estimator, HasInputCols, HasSeed, _Saved):
    """Centroids by far-point start and Lloyd rounds (see ``scale.lloyd_centroids``)."""

    k = Param(Params._dummy(), "k", "number of centroids", TypeConverters.toInt)
    rounds = Param(Params._dummy(), "rounds", "Lloyd rounds at most", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "row id that seeds the start", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, idCol=None, k=3, rounds=20, seed=42):
        super().__init__()
        self._setDefault(k=3, rounds=20, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> RbfModel:
        cols = self.getInputCols()
        got = scale.lloyd_centroids(df, cols, self.getOrDefault(self.idCol), self.getOrDefault(self.k), self.getOrDefault(self.rounds), self.getOrDefault(self.seed))
        rows = sorted(got.collect(), key=lambda r: r["cluster"])
        return RbfModel(inputCols=cols, centroids=json.dumps([list(r)[2:] for r in rows]))


def score_saved(path: str, df: DataFrame, cols: list[str], column: str = "prediction") -> DataFrame:
    """A saved pipeline on raw rows: every row comes back, NULL where one of the raw ``cols`` is missing."""
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(path)
    there = complete(cols)
    filled = df.withColumn("_ok", there).withColumns({f"_raw_{c}": F.col(c) for c in cols}).withColumns({c: F.when(F.col("_ok"), F.col(c).cast("double")).otherwise(0.0) for c in cols})
    out = model.transform(filled).withColumn(column, F.when(F.col("_ok"), F.col(column)))
    return out.select(*[F.col(f"_raw_{c}").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns], column)
