"""Model fitting, search and scoring on Spark ML (ML1-ML11, M16, FS10, FS11, D2).

Statistics-based models (OLS, recursive elimination) collect only p x p Gram
matrices (one distributed pass, per fold when needed); iterative learners are
MLlib estimators; scoring is always a distributed ``transform``.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import save


def complete(cols: Sequence[str]):
    """True where every column has a value (neither NULL nor NaN)."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return ok


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vectors for a fit; a missing value raises (drop or fill rows first)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def fit_rows(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """(rows with all of ``cols`` and ``extra``, number of rows left out of the fit)."""
    ok = complete([*cols, *extra])
    return df.where(ok), df.where(~ok).count()


def score_rows(model, df: DataFrame, cols: Sequence[str], column: str = "prediction") -> DataFrame:
    """ML10 scoring: one prediction per input row; NULL where a feature is missing."""
    filled = df.withColumn("_ok", complete(cols)).withColumns(
        {f"_x_{c}": F.when(F.col("_ok"), F.col(c).cast("double")).otherwise(0.0) for c in cols})
    names = [f"_x_{c}" for c in cols]
    out = model.transform(assemble(filled, names))
    return out.withColumn(column, F.when(F.col("_ok"), F.col(column))).drop("_ok", "features", *names)


def gram(df: DataFrame, cols: Sequence[str], target: str, by: Sequence[str] = (), intercept: bool = True) -> DataFrame:
    """Sufficient statistics for least squares: sums of x_i x_j, x_i y, y y and n,
    optionally per group (e.g. per fold), in ONE aggregate."""
    xs = ([F.lit(1.0)] if intercept else []) + [F.col(c).cast("double") for c in cols]
    names = (["_1"] if intercept else []) + list(cols)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col(target) * F.col(target)).alias("yy")]
    for i in range(len(xs)):
        aggs.append(F.sum(xs[i] * F.col(target)).alias(f"xy_{i}"))
        for j in range(i, len(xs)):
            aggs.append(F.sum(xs[i] * xs[j]).alias(f"xx_{i}_{j}"))
    clean = df.dropna(subset=[*cols, target])
    g = clean.groupBy(*by).agg(*aggs) if by else clean.agg(*aggs)
    return g.withColumn("_names", F.array(*[F.lit(n) for n in names]))


def _solve(row: dict, p: int, subset: Sequence[int] | None = None) -> np.ndarray:
    xx = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"]
    xy = np.array([row[f"xy_{i}"] for i in range(p)])
    idx = list(range(p)) if subset is None else list(subset)
    return np.linalg.pinv(xx[np.ix_(idx, idx)]) @ xy[idx]


def ols_normal_equations(df: DataFrame, cols: Sequence[str], target: str, intercept: bool = True) -> DataFrame:
    """ML1 closed form: solve XᵀX b = Xᵀy from the distributed Gram pass."""
    row = gram(df, cols, target, intercept=intercept).first().asDict()
    names = row["_names"]
    b = _solve(row, len(names))
    return df.sparkSession.createDataFrame([(n, float(v)) for n, v in zip(names, b)], "term string, coef double")


def rfe_ranking(df: DataFrame, cols: Sequence[str], target: str, n_keep: int = 1, fold: str | None = None) -> DataFrame:
    """FS10: recursive feature elimination with a linear model: repeatedly drop the
    feature with the smallest |coef| (standardised by the feature std) until
    ``n_keep`` remain.  With ``fold`` the ranking is made per fold from the other folds'
    moments, merged; all from one distributed pass of centred moments."""
    key = F.col(fold).cast("long") if fold else F.lit(-1).cast("long")
    rows = df.select(key.alias("_fold"), *[F.col(c).cast("double").alias(c) for c in [*cols, target]]).dropna(subset=[*cols, target])
    parts = fold_moments(rows, [*cols, target], "_fold")
    out = []
    for f in sorted(parts):
        n, mean, m2 = _merge([m for k, m in parts.items() if k != f]) if fold else parts[f]
        std = np.sqrt(np.maximum(np.diag(m2) / n, 0.0))
        y = len(cols)
        alive, rank_of = list(range(len(cols))), {}
        while len(alive) > n_keep:
            b = np.linalg.pinv(m2[np.ix_(alive, alive)]) @ m2[alive, y]
            worst = min(range(len(alive)), key=lambda k: (abs(b[k]) * std[alive[k]], alive[k]))
            rank_of[alive[worst]] = len(alive)
            del alive[worst]
        rank_of.update({a: 1 for a in alive})
        out += [(f if fold else None, cols[a], int(rk)) for a, rk in rank_of.items()]
    return df.sparkSession.createDataFrame(out, "fold long, feature string, ranking int")


def linear_regression(df: DataFrame, cols: Sequence[str], target: str, reg: float = 0.0, l1_ratio: float = 0.0,
                      intercept: bool = True, weight: str | None = None):
    """ML1/ML9: OLS / ridge / lasso (MLlib objective: regParam is alpha / n of scikit)."""
    from pyspark.ml.regression import LinearRegression
    lr = LinearRegression(featuresCol="features", labelCol=target, regParam=reg, elasticNetParam=l1_ratio,
                          fitIntercept=intercept, standardization=False)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(assemble(df, cols))


def classifier(kind: str, label: str = "label", weight: str | None = None, seed: int = 42,
               multiclass: bool = True, **kw):
    """ML2-ML6: logistic, random forest, gradient-boosted trees (one-vs-rest for
    more than two classes), multilayer perceptron, linear SVM (one-vs-rest)."""
    from pyspark.ml import classification as C
    common = dict(featuresCol="features", labelCol=label)
    if kind == "logistic":
        est = C.LogisticRegression(**common, **kw)
    elif kind == "random_forest":
        est = C.RandomForestClassifier(**common, seed=seed, **({"numTrees": 200} | kw))
    elif kind == "gbt":
        est = (C.OneVsRest(classifier=C.GBTClassifier(seed=seed, **kw), **common) if multiclass
               else C.GBTClassifier(**common, seed=seed, **kw))
    elif kind == "mlp":
        est = C.MultilayerPerceptronClassifier(**common, seed=seed, **kw)
    elif kind == "linear_svc":
        est = C.OneVsRest(classifier=C.LinearSVC(**kw), **common)
    else:
        raise ValueError(f"unknown model {kind}")
    if weight:
        if not hasattr(est, "setWeightCol"):
            raise ValueError(f"{kind} takes no row weights")
        est = est.setWeightCol(weight)
    return est


def cross_validate(estimator, grid: list, df: DataFrame, fold: str, evaluator, parallelism: int = 2):
    """ML7: grid x folds with a user fold column (group-aware folds), refit on best."""
    from pyspark.ml.tuning import CrossValidator
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, foldCol=fold,
                        parallelism=parallelism)
    return cv.fit(df)


def random_search(grid: list[dict], n: int, seed: int = 42) -> list[dict]:
    """ML8: seeded sample of n grid points (all when n >= len(grid))."""
    rnd = random.Random(seed)
    return grid if n >= len(grid) else rnd.sample(grid, n)


def save_and_score(model, path: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ML10: persist a fitted pipeline, load it back and score a batch; the number of
    predictions rows must be that of the input rows."""
    from pyspark.ml import PipelineModel
    model.write().overwrite().save(path)
    out = save(score_rows(PipelineModel.load(path), df, cols), "scored")
    check_same_count(df, out)
    return out


def check_same_count(inp: DataFrame, out: DataFrame) -> None:
    a, b = inp.count(), out.count()
    if a != b:
        raise ValueError(f"scored {b} rows for {a} inputs")


def grid_fold_scores(df: DataFrame, cols: Sequence[str], target: str, grid: Sequence[dict], fold: str = "fold", max_folds: int = 100) -> DataFrame:
    """M16 / ML1 / ML9: every grid point (``{"model": name, "reg": alpha, "l1_ratio": r}``)
    is fitted on the rows outside a fold and scores all rows: ``(model, fold, set,
    y_true, y_pred)``, the store of the metric operators.

    All penalties are solved from one centred moment pass (the training moments of a fold are
    those of the other folds, merged).  Rows without a feature or the target are left out of the fit and have no score.
    """
    rows = save(df.where(complete([*cols, target]) & F.col(fold).isNotNull()).select(fold, *[F.col(c).cast("double").alias(c) for c in [*cols, target]]), "fit-rows")
    folds = [r[0] for r in rows.select(fold).distinct().limit(max_folds + 1).collect()]
    if len(folds) > max_folds:
        raise ValueError(f"more than {max_folds} folds")
    moments = fold_moments(rows, [*cols, target], fold)
    out = []
    for f in sorted(folds):
        train = [m for k, m in moments.items() if k != f]
        if not train:
            raise ValueError("one fold only: nothing to train on")
        for g in grid:
            reg, l1 = float(g.get("reg", 0.0)), float(g.get("l1_ratio", 0.0))
            beta, b0 = _penalised(_merge(train), reg, l1)
            pred = F.lit(float(b0))
            for c, v in zip(cols, beta):
                pred = pred + F.col(c) * F.lit(float(v))
            out.append(F.struct(F.lit(str(g["model"])).alias("model"), F.lit(f).alias("fold"), pred.alias("y_pred")))
    scored = rows.select(F.explode(F.array(*out)).alias("s"), F.col(fold).alias("_own"), F.col(target).alias("y_true"))
    return scored.select("s.model", F.col("s.fold").alias("fold"), F.when(F.col("_own") == F.col("s.fold"), "val").otherwise("train").alias("set"),
                         "y_true", F.col("s.y_pred").alias("y_pred"))


def fold_moments(rows: DataFrame, cols: Sequence[str], fold: str) -> dict:
    """{fold: (n, means, centred cross products)}: running means and covariances, so
    large offsets do not cancel; (columns + 1)^2 numbers per fold reach the driver."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    got = rows.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                                 *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in got:
        m2 = np.zeros((len(cols), len(cols)))
        for i, j in pairs:
            m2[i, j] = m2[j, i] = (r[f"c{i}_{j}"] or 0.0) * r["n"]
        out[r[fold]] = (r["n"], np.array([r[f"m{i}"] for i in range(len(cols))], float), m2)
    return out


def _merge(parts):
    """Moments of several parts together (pairwise update of means and cross products)."""
    n, mean, m2 = parts[0][0], parts[0][1].copy(), parts[0][2].copy()
    for k, mu, c in parts[1:]:
        d = mu - mean
        m2 += c + np.outer(d, d) * (n * k / (n + k))
        mean += d * (k / (n + k))
        n += k
    return n, mean, m2


def _penalised(moments, reg: float, l1_ratio: float = 0.0):
    """Slopes and intercept of least squares with penalty reg (l1_ratio |b|_1 + (1 - l1_ratio) |b|^2 / 2)
    on the mean squared error's half (ridge: n * reg on the sum of squares)."""
    n, mean, m2 = moments
    p = len(mean) - 1
    if l1_ratio > 0 and reg > 0:
        from .crossfit import coordinate_descent
        beta = coordinate_descent(m2[:p, :p] / n, m2[:p, p] / n, reg, l1_ratio)
    else:
        beta = np.linalg.pinv(m2[:p, :p] / n + reg * np.eye(p)) @ (m2[:p, p] / n)
    return [float(b) for b in beta], float(mean[p] - mean[:p] @ beta)


def feature_importances(model, names: Sequence[str], k: int = 20) -> DataFrame:
    """FS11: importance table of a fitted tree model, top k."""
    from pyspark.sql import SparkSession
    imp = model.featureImportances.toArray()
    rows = sorted(((n, float(v)) for n, v in zip(names, imp)), key=lambda t: -t[1])[:k]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def mar_test(df: DataFrame, cols: Sequence[str], fold: str, seed: int = 42, max_folds: int = 100) -> DataFrame:
    """D2 (re-aimed): for every column, predict its null indicator from the other
    columns (NULL -> 0) with logistic regression, one fit per fold; exact ROC AUC of the
    training rows and of the held-out fold.  ``(column, set, auc_mean, auc_std, n_folds,
    n_undefined)``: a fold whose rows have one class only has no AUC and is counted in
    ``n_undefined``, not left out silently.  ddof 1."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    from .metrics import roc_auc
    src = save(df.select(fold, *cols), "mar-rows")
    folds = [r[0] for r in src.select(fold).where(F.col(fold).isNotNull()).distinct().limit(max_folds + 1).collect()]
    if len(folds) > max_folds:
        raise ValueError(f"more than {max_folds} folds")
    out = []
    for c in cols:
        others = [o for o in cols if o != c]
        t = src.select(fold, F.col(c).isNull().cast("double").alias("_y"),
                       *[F.coalesce(F.col(o).cast("double"), F.lit(0.0)).alias(o) for o in others])
        t = assemble(t, others)
        both = {r[0]: (r[1], r[2]) for r in t.groupBy(fold).agg(F.sum("_y"), F.count(F.lit(1))).collect()}
        pos, n = sum(v[0] for v in both.values()), sum(v[1] for v in both.values())
        for f in sorted(folds):
            if 0 < pos - both[f][0] < n - both[f][1]:
                m = LogisticRegression(featuresCol="features", labelCol="_y").fit(t.where(F.col(fold) != f))
                s = m.transform(t).select(F.when(F.col(fold) == f, "test").otherwise("train").alias("set"), F.col("_y").alias("y_true"),
                                          vector_to_array("probability")[1].alias("score"))
                out.append(roc_auc(s, ["set"]).select(F.lit(c).alias("column"), "set", "roc_auc"))
            else:
                out.append(src.sparkSession.range(1).select(F.explode(F.array(F.lit("train"), F.lit("test"))).alias("set")).select(
                    F.lit(c).alias("column"), "set", F.lit(None).cast("double").alias("roc_auc")))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res.groupBy("column", "set").agg(F.avg("roc_auc").alias("auc_mean"), F.stddev_samp("roc_auc").alias("auc_std"),
                                            F.count(F.lit(1)).alias("n_folds"), F.count_if(F.col("roc_auc").isNull()).alias("n_undefined"))


def vote_table(preds: DataFrame, group: str, pred: str = "prediction") -> DataFrame:
    """ML11: per-group majority vote of row predictions (ties -> smallest label)."""
    from .folds import majority_label
    return majority_label(preds, group, pred, "vote")

