"""Scaling, expansion and reduction (T1-T9) -- fit as an aggregate, apply as a projection.

Fitted state is a one-row (or one-row-per-fold) table; applying it is a join
on a constant key / the fold id against that bounded table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import portable_hash
from ..storage import save
from .models import complete
from .ordering import attach_group
from .profile import attach_row
from .quantile import quantile_wide


def standard_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population std (ddof 0) per column, one row; zero std -> 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_pop(c).alias(f"{c}__sd")]
    row = df.agg(*aggs)
    return row.select(*[F.col(f"{c}__mu") for c in cols],
                      *[F.when(F.col(f"{c}__sd") == 0, 1.0).otherwise(F.col(f"{c}__sd")).alias(f"{c}__sd")
                        for c in cols])


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std with scikit semantics (ddof 0, zero std -> 1)."""
    st = stats if stats is not None else standard_stats(df, cols)
    t = attach_row(df, st)
    return t.withColumns({c: (F.col(c) - F.col(f"{c}__mu")) / F.col(f"{c}__sd") for c in cols}).drop(
        *[f"{c}__{k}" for c in cols for k in ("mu", "sd")])


def robust_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - median) / (Q3 - Q1) with exact interpolated quantiles; IQR 0 -> 1."""
    q = quantile_wide(df, cols, {"med": 0.5, "q1": 0.25, "q3": 0.75})
    row = q.agg(*[F.max(F.when(F.col("column") == c, F.col(k))).alias(f"{c}__{k}")
                  for c in cols for k in ("med", "q1", "q3")])
    t = attach_row(df, row)
    iqr = lambda c: F.col(f"{c}__q3") - F.col(f"{c}__q1")
    return t.withColumns({c: (F.col(c) - F.col(f"{c}__med")) / F.when(iqr(c) == 0, 1.0).otherwise(iqr(c))
                          for c in cols}).drop(*[f"{c}__{k}" for c in cols for k in ("med", "q1", "q3")])


def min_max_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0."""
    row = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols], *[F.max(c).alias(f"{c}__hi") for c in cols])
    t = attach_row(df, row)
    return t.withColumns({c: F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}__lo"),
                                                     F.col(f"{c}__hi") - F.col(f"{c}__lo")), F.lit(0.0))
                          for c in cols}).drop(*[f"{c}__{k}" for c in cols for k in ("lo", "hi")])


def fold_standardize(df: DataFrame, cols: Sequence[str], fold: str = "fold") -> DataFrame:
    """T4: standardise the rows of fold f with mean/std (ddof 0) of the rows NOT in f
    (the training part).  One pass of per-fold counts, means and variances; the fold's
    own part is taken out of the whole by the update formulas of mean and squared
    deviations, so large offsets do not cancel.  The fold table is joined by key (a
    NULL fold is a fold); Spark broadcasts it only when it is small."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__m"), (F.var_pop(c) * F.count(c)).alias(f"{c}__q")]
    per = df.groupBy(fold).agg(*aggs)
    whole = Window.partitionBy()
    out = [F.col(fold)]
    for c in cols:
        n, m, q = F.col(f"{c}__n"), F.coalesce(F.col(f"{c}__m"), F.lit(0.0)), F.coalesce(F.col(f"{c}__q"), F.lit(0.0))
        n_all = F.sum(n).over(whole)
        m_all = F.sum(m * F.try_divide(n, n_all)).over(whole)
        out += [n.alias(f"{c}__n"), m.alias(f"{c}__m"), q.alias(f"{c}__q"), n_all.alias(f"{c}__an"), m_all.alias(f"{c}__am")]
    t = per.select(*out)
    t = t.withColumns({f"{c}__aq": F.sum(F.col(f"{c}__q") + F.col(f"{c}__n") * (F.col(f"{c}__m") - F.col(f"{c}__am")) * (F.col(f"{c}__m") - F.col(f"{c}__am"))).over(whole) for c in cols})
    stats = [F.col(fold)]
    for c in cols:
        n, m, q, n_all, m_all, q_all = (F.col(f"{c}__{k}") for k in ("n", "m", "q", "an", "am", "aq"))
        left = n_all - n
        mu = m_all + (m_all - m) * F.try_divide(n, left)
        m2 = q_all - q - (m - mu) * (m - mu) * F.try_divide(n * left, n_all)
        sd = F.sqrt(F.greatest(F.try_divide(m2, left), F.lit(0.0)))
        stats += [mu.alias(f"{c}__mu"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"{c}__sd")]
    t = attach_group(df, t.select(*stats), [fold])
    return t.withColumns({c: (F.col(c) - F.col(f"{c}__mu")) / F.col(f"{c}__sd") for c in cols}).drop(
        *[f"{c}__{k}" for c in cols for k in ("mu", "sd")])


def rbf_sigma(centroids: np.ndarray, sigma: float | None = None) -> float:
    """Mean non-zero distance between centroids (1.0 for one centroid) unless given."""
    if sigma is not None:
        return float(sigma)
    if len(centroids) <= 1:
        return 1.0
    d = np.linalg.norm(centroids[:, None, :] - centroids[None, :, :], axis=2)
    return float(d[d != 0].mean())


def rbf_features(df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]],
                 sigma: float | None = None, prefix: str = "rbf", keep: Sequence[str] = ()) -> DataFrame:
    """T6 transform: phi_m = exp(-||x - c_m||^2 / (2 sigma^2)); centroids are a small
    literal (M x d), so the N x M x d intermediate never exists."""
    c = np.asarray(centroids, dtype=float)
    s = rbf_sigma(c, sigma)
    exprs = []
    for m, row in enumerate(c):
        sq = F.lit(0.0)
        for x, v in zip(cols, row):
            sq = sq + (F.col(x) - F.lit(float(v))) * (F.col(x) - F.lit(float(v)))
        exprs.append(F.exp(-sq / (2 * s * s)).alias(f"{prefix}{m}"))
    return df.select(*keep, *exprs)


def kmeans_centroids(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42) -> np.ndarray:
    """T6 fit: MLlib k-means (distributed Lloyd iterations); centroids are k x d."""
    from pyspark.ml.clustering import KMeans
    from .models import assemble, fit_rows
    vec = assemble(fit_rows(df, cols)[0], cols, "_v")
    model = KMeans(k=k, seed=seed, featuresCol="_v").fit(vec)
    return np.array([list(c) for c in model.clusterCenters()])


def lloyd_centroids(df: DataFrame, cols: Sequence[str], id_col: str, k: int, rounds: int = 20, seed=42) -> DataFrame:
    """T6 fit, reproducible: ``(cluster, n, <cols>)``.  The start is the row with the least hash of
    its id and then, k - 1 times, the row farthest from the centroids so far (among equals the
    least values); then rounds of nearest centroid (the first among equals) and mean, until no
    centroid moves or ``rounds`` are done.  A centroid without rows stays where it is.  Each step is
    one aggregate over the saved complete rows; k x d numbers reach the driver."""
    x = [f"x{i}" for i in range(len(cols))]
    rows = save(df.where(complete(cols)).select(portable_hash(id_col, seed).alias("_h"), *[F.col(c).cast("double").alias(v) for c, v in zip(cols, x)]), "lloyd-rows")

    def squared(c):
        out = F.lit(0.0)
        for v, m in zip(x, c):
            out = out + (F.col(v) - F.lit(float(m))) * (F.col(v) - F.lit(float(m)))
        return out

    first = rows.agg(F.min(F.struct("_h", *x)).alias("r")).first()["r"]
    schema = "cluster int, n long, " + ", ".join(f"`{c}` double" for c in cols)
    if first is None:
        return df.sparkSession.createDataFrame([], schema)
    centres, n = [list(first[1:])], [0] * k
    while len(centres) < k:
        far = rows.agg(F.min(F.struct((-F.least(*[squared(c) for c in centres], F.lit(float("inf")))).alias("d"), *x)).alias("r")).first()["r"]
        centres.append(list(far[1:]))
    for _ in range(rounds):
        d = [squared(c) for c in centres]
        near = F.least(*d, F.lit(float("inf")))
        at = F.coalesce(*[F.when(v == near, F.lit(i)) for i, v in enumerate(d)])
        got = {r["c"]: r for r in rows.groupBy(at.alias("c")).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(v) for v in x]).collect()}
        n = [got[i]["n"] if i in got else 0 for i in range(k)]
        new = [[got[i][v] for v in x] if i in got else centres[i] for i in range(k)]
        if new == centres:
            break
        centres = new
    return df.sparkSession.createDataFrame([(i, int(n[i]), *map(float, c)) for i, c in enumerate(centres)], schema)


def pca_to_share(df: DataFrame, cols: Sequence[str], share: float, keep: Sequence[str] = ()) -> DataFrame:
    """Standardised columns on the fewest components that explain ``share`` of the variance:
    ``keep`` and pc0, pc1, ...; a component's largest weight is positive.  One pass of moments,
    the decomposition is p x p; a row with a missing value stays, with NULL components."""
    from .models import fold_moments
    got = fold_moments(df.where(complete(cols)).select(F.lit(0).alias("_f"), *[F.col(c).cast("double").alias(c) for c in cols]), cols, "_f")
    if not got:
        return df.select(*keep, F.lit(None).cast("double").alias("pc0"))
    n, mean, m2 = got[0]
    sd = np.sqrt(np.diag(m2) / n)
    sd[sd == 0] = 1.0
    vals, vecs = np.linalg.eigh(m2 / n / np.outer(sd, sd))
    vals, vecs = vals[::-1], vecs[:, ::-1]
    total = vals.sum()
    k = int(np.searchsorted(np.cumsum(vals) / total, share - 1e-12) + 1) if total > 0 else 1
    out = []
    for j in range(min(k, len(cols))):
        v = vecs[:, j] * np.sign(vecs[np.argmax(np.abs(vecs[:, j]) > np.abs(vecs[:, j]).max() - 1e-9), j])
        e = F.lit(0.0)
        for c, m, s, w in zip(cols, mean, sd, v):
            e = e + (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w))
        out.append(F.when(complete(cols), e).alias(f"pc{j}"))
    return df.select(*keep, *out)


def pca_variance(df: DataFrame, cols: Sequence[str], standardize_first: bool = True) -> DataFrame:
    """Explained-variance ratio and cumulative curve.  The p x p covariance comes
    from one distributed moments pass; the eigen-decomposition is p x p on the driver."""
    from .select import covariance_pairs
    src = standardize(df.select(*cols).dropna(), cols) if standardize_first else df.select(*cols).dropna()
    cov = _matrix(covariance_pairs(src, cols).collect(), cols)
    vals = np.sort(np.linalg.eigvalsh(cov))[::-1]
    ratio = vals / vals.sum()
    rows = [(k + 1, float(r), float(cr)) for k, (r, cr) in enumerate(zip(ratio, np.cumsum(ratio)))]
    return df.sparkSession.createDataFrame(rows, "component int, explained_variance_ratio double, cumulative double")


def _matrix(pair_rows, cols) -> np.ndarray:
    idx = {c: i for i, c in enumerate(cols)}
    m = np.zeros((len(cols), len(cols)))
    for r in pair_rows:
        m[idx[r["a"]], idx[r["b"]]] = m[idx[r["b"]], idx[r["a"]]] = r["cov"]
    return m


def pca_components_for(ratio_df: DataFrame, target: float) -> int:
    """Smallest k whose cumulative explained variance reaches ``target``."""
    r = ratio_df.where(F.col("cumulative") >= target - 1e-12).agg(F.min("component")).first()[0]
    return int(r)


def pca_project(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = ()) -> DataFrame:
    """T8 projection with MLlib PCA, fitted on the complete rows; a row with a missing
    value stays, with NULL components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    from .models import assemble, fit_rows
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(assemble(fit_rows(df, cols)[0], cols, "_v"))
    t = df.select(*keep, complete(cols).alias("_ok"), *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_x{i}") for i, c in enumerate(cols)])
    out = model.transform(assemble(t, [f"_x{i}" for i in range(len(cols))], "_v")).withColumn("_a", vector_to_array("_p"))
    return out.select(*keep, *[F.when(F.col("_ok"), F.col("_a")[i]).alias(f"pc{i}") for i in range(k)])


def pls_weights(df: DataFrame, cols: Sequence[str], target: str, n_components: int = 2) -> dict:
    """PLS1 (NIPALS) from the covariances of one distributed pass (running means, no
    cancelling sums); the k deflation steps are p x p algebra on the driver."""
    names = [*cols, target]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    r = df.select(*names).dropna().agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
                                       *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    p = len(cols)
    mu, y_mean = np.array([r[f"m{i}"] for i in range(p)]), r[f"m{p}"]
    cov = np.zeros((p + 1, p + 1))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
    sxx, sxy = cov[:p, :p].copy(), cov[:p, p].copy()
    W, P, Q = [], [], []
    for _ in range(n_components):
        w = sxy / (np.linalg.norm(sxy) or 1.0)
        tt = float(w @ sxx @ w)
        pvec = sxx @ w / tt
        q = float(sxy @ w) / tt
        W.append(w); P.append(pvec); Q.append(q)
        sxx = sxx - tt * np.outer(pvec, pvec)
        sxy = sxy - tt * q * pvec
    W, P = np.array(W).T, np.array(P).T
    rot = W @ np.linalg.pinv(P.T @ W)
    return {"mean": mu, "rotation": rot, "y_loadings": np.array(Q), "y_mean": y_mean}


def pls_scores(df: DataFrame, cols: Sequence[str], fit: dict, keep: Sequence[str] = ()) -> DataFrame:
    """T9 transform: scores T = (X - mean) @ rotation, one projection."""
    rot, mu = fit["rotation"], fit["mean"]
    exprs = []
    for k in range(rot.shape[1]):
        e = F.lit(0.0)
        for i, c in enumerate(cols):
            e = e + (F.col(c) - float(mu[i])) * float(rot[i, k])
        exprs.append(e.alias(f"pls{k}"))
    return df.select(*keep, *exprs)

