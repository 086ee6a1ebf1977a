"""Cross-fitting, nested search and penalty paths from moments (ML1, ML4, ML7-ML9, ML11, FS10).

Rows are read once: every fold (or group) is summed up as one row of weighted products of
the centred columns.  Sums add and subtract, so the training part of a fold is the total
less the fold, and the error of any linear model on any part is a quadratic form of that
part's sums.  Fits run in the tasks, a fold's numbers at a time, so the number of folds is
not bounded by the driver; models that need the rows (trees) are fitted once per held-out
fold.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import save
from .models import assemble, complete
from .ordering import attach_group

FIT_ROWS = 50_000  # rows that a task of a fit takes


# --------------------------------------------------------------------------- sums

class Sums:
    """``table``: (keys..., s) with s the upper triangle of sum w z z', where
    z = (1, columns less ``centre``), the target last."""

    def __init__(self, table: DataFrame, cols: Sequence[str], target: str, centre: list[float]):
        self.table, self.cols, self.target, self.centre = table, list(cols), target, centre
        self.size = len(self.cols) + 2

    def total(self, by: Sequence[str] = (), name: str = "total") -> DataFrame:
        """Sums added up by ``by`` (one row without)."""
        n = self.size * (self.size + 1) // 2
        added = F.expr("array(" + ", ".join(f"sum(s[{i}])" for i in range(n)) + f") AS {name}")
        return self.table.groupBy(*by).agg(added)


def column_sums(df: DataFrame, cols: Sequence[str], target: str, keys: Sequence[str], weight: str | None = None) -> Sums:
    """One row of sums per ``keys``; a NULL key is a key.  Rows without one of the columns,
    the target or the weight are left out."""
    names = [*cols, target]
    used = df.where(complete([*names, *([weight] if weight else [])]))
    mean = used.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(names)]).first()
    centre = [float(v or 0.0) for v in mean]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    z = used.select(*keys, w.alias("_w"), *[(F.col(c).cast("double") - F.lit(m)).alias(f"_z{i}") for i, (c, m) in enumerate(zip(names, centre), 1)])
    k = len(names) + 1
    one = lambda i, j: " * ".join(["_w", *([f"_z{i}"] if i else []), *([f"_z{j}"] if j else [])])
    sums = "array(" + ", ".join(f"sum({one(i, j)})" for i in range(k) for j in range(i, k)) + ") AS s"
    return Sums(z.groupBy(*keys).agg(F.expr(sums)), cols, target, centre)


def _square(s, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = np.asarray(s, float)
    return out + np.triu(out, 1).T


def _rest(total: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Sums without a part; zero where the part is everything (no rounding left over)."""
    out = total - part
    return out if out[0, 0] > 1e-12 * total[0, 0] else np.zeros_like(out)


def _moments(s: np.ndarray):
    """(weight, means, covariances) of a square of sums."""
    n = s[0, 0]
    mean = s[0, 1:] / n
    return n, mean, s[1:, 1:] / n - np.outer(mean, mean)


def coordinate_descent(c: np.ndarray, b: np.ndarray, reg: float, l1_ratio: float, start: np.ndarray | None = None, tol: float = 1e-12, rounds: int = 100_000) -> np.ndarray:
    """Slopes that minimise  x'c x / 2 - b'x + reg (l1_ratio |x|_1 + (1 - l1_ratio) |x|^2 / 2)
    by covariance updates: the gradient is kept, a changed slope costs one column of ``c``."""
    x = np.zeros(len(b)) if start is None else start.copy()
    slope, ridge = reg * l1_ratio, reg * (1.0 - l1_ratio)
    grad = b - c @ x
    scale = max(float(np.abs(b).max(initial=0.0)), 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(b)):
            if c[j, j] + ridge <= 0:
                continue
            r = grad[j] + c[j, j] * x[j]
            new = np.sign(r) * max(abs(r) - slope, 0.0) / (c[j, j] + ridge)
            if new != x[j]:
                grad -= c[:, j] * (new - x[j])
                moved = max(moved, abs(new - x[j]) * (c[j, j] + ridge))
                x[j] = new
        if moved <= tol * scale:
            break
    return x


def linear_fit(s: np.ndarray, centre: Sequence[float], reg: float = 0.0, l1_ratio: float = 0.0, use: Sequence[int] | None = None,
               start: np.ndarray | None = None) -> np.ndarray:
    """(intercept, slopes) on the original scale from a square of sums; columns outside ``use`` get 0."""
    p = len(s) - 2
    at = np.arange(p) if use is None else np.asarray(use, int)
    beta = np.zeros(p)
    if s[0, 0] <= 0:
        return np.full(p + 1, np.nan)
    _, mean, cov = _moments(s)
    c, b = cov[np.ix_(at, at)], cov[at, p]
    if l1_ratio > 0 and reg > 0:
        beta[at] = coordinate_descent(c, b, reg, l1_ratio, None if start is None else start[at])
    else:
        beta[at] = np.linalg.pinv(c + reg * np.eye(len(at)), hermitian=True) @ b
    x0 = np.asarray(centre)
    return np.concatenate(([mean[p] + x0[p] - beta @ (mean[:p] + x0[:p])], beta))


def squared_error(s: np.ndarray, centre: Sequence[float], coef: np.ndarray) -> tuple[float, float]:
    """(sum of squared residuals, total sum of squares) of a linear model on the rows behind ``s``."""
    x0, p = np.asarray(centre), len(s) - 2
    v = np.concatenate(([x0[p] - coef[0] - coef[1:] @ x0[:p]], -coef[1:], [1.0]))
    return float(v @ s @ v), float(s[-1, -1] - s[0, -1] ** 2 / s[0, 0]) if s[0, 0] > 0 else 0.0


def r_squared(s: np.ndarray, centre, coef) -> float | None:
    sse, sst = squared_error(s, centre, coef)
    return 1.0 - sse / sst if sst > 0 and np.isfinite(sse) else None


def _map_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Each row (a dict) to any number of rows (tuples of ``schema``)."""
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        to = to_arrow_schema(target)
        for b in batches:
            rows = [r for row in b.to_pylist() for r in fn(row)]
            cols = list(zip(*rows)) if rows else [[]] * len(to)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, to)], schema=to)

    return df.mapInArrow(run, schema)


# --------------------------------------------------------------------------- out-of-fold predictions

def fold_coefficients(df: DataFrame, cols: Sequence[str], target: str, fold: str, weight: str | None = None, reg: float = 0.0, l1_ratio: float = 0.0) -> DataFrame:
    """``(fold, coef)``: per fold the model (intercept, slopes) of all rows outside it; with one
    fold only there is nothing to train on and the coefficients are NaN.  Rows with a NULL fold
    belong to no held-out part and take part in no fit."""
    sums = column_sums(df.where(F.col(fold).isNotNull()), cols, target, [fold], weight)
    size, centre = sums.size, sums.centre
    table = save(sums.table, "fold-sums")
    sums.table = table
    total = sums.total().first()["total"]
    kind = df.schema[fold].dataType.simpleString()

    def fit(row):
        yield row[fold], linear_fit(_rest(_square(total, size), _square(row["s"], size)), centre, reg, l1_ratio).tolist()

    return _map_rows(table, fit, f"{fold} {kind}, coef array<double>")


def linear_prediction(cols: Sequence[str], coef: str = "coef"):
    return F.expr(" + ".join([f"{coef}[0]", *[f"{coef}[{i}] * CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols, 1)]]))


def cross_fit_linear(df: DataFrame, cols: Sequence[str], target: str, fold: str, weight: str | None = None, reg: float = 0.0, l1_ratio: float = 0.0,
                     name: str = "prediction") -> DataFrame:
    """ML1/ML9 out of fold: every row with the prediction of the model that saw no row of its
    fold (NULL where a column or the fold is missing)."""
    coefs = fold_coefficients(df, cols, target, fold, weight, reg, l1_ratio).select(F.col(fold).alias("_cf"), F.col("coef").alias("_coef"))
    out = df.join(coefs, F.col(fold) == F.col("_cf"), "left")
    return out.withColumn(name, F.when(complete(cols), linear_prediction(cols, "_coef"))).drop("_cf", "_coef")


def cross_fit_classifier(df: DataFrame, cols: Sequence[str], label: str, fold: str, k: int, estimator, name: str = "prediction") -> DataFrame:
    """ML4 out of fold with any MLlib classifier (its weight column included): one fit per
    held-out fold 0..k-1, each scoring that fold only; every row with a fold comes back once."""
    rows = save(df.where(complete(cols) & F.col(fold).isNotNull()), "cross-fit-rows")
    vec = assemble(rows, cols, "features")
    # The rows are few bytes each, so their files make few tasks; a learner's work goes by rows.
    tasks = math.ceil(rows.count() / FIT_ROWS)
    dealt = vec.repartition(tasks) if tasks > 1 else vec
    parts = []
    for f in range(k):
        model = estimator.fit(dealt.where(F.col(fold) != f))
        parts.append(model.transform(vec.where(F.col(fold) == f)).select(*rows.columns, F.col("prediction").alias(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def out_of_fold_votes(preds: DataFrame, group: str, fold: str, pred: str = "prediction") -> DataFrame:
    """ML11: ``(group, fold, vote, n_rows, share)``: majority vote of a group's out-of-fold row
    predictions (ties to the smallest label; rows without a prediction don't vote) and the
    share of the votes that it got.  A NULL group is a group."""
    counts = preds.where(F.col(pred).isNotNull()).groupBy(group, fold, pred).agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(group).agg(F.min(fold).alias(fold), F.min_by(F.col(pred), F.struct(-F.col("_c"), F.col(pred))).alias("vote"),
                                     F.sum("_c").alias("n_rows"), (F.max("_c") / F.sum("_c")).alias("share"))


# --------------------------------------------------------------------------- nested search

def sampled(grid: Sequence[dict], trials: int | None, outer, seed) -> list[int]:
    """ML8: the grid points that an outer fold tries: all, or the first ``trials`` by
    md5(name:outer:seed)."""
    at = range(len(grid))
    if trials is None or trials >= len(grid):
        return list(at)
    return sorted(sorted(at, key=lambda i: (hashlib.md5(f"{grid[i]['model']}:{outer}:{seed}".encode()).hexdigest(), i))[:trials])


def nested_search(df: DataFrame, cols: Sequence[str], target: str, group: str, folds: DataFrame, grid: Sequence[dict], weight: str | None = None,
                  trials: int | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """ML7/ML8 with refit.  ``folds`` is ``(outer_fold, group, inner_fold)`` as of
    ``nested_group_folds``: the groups an outer fold trains on; its other groups are its test
    part.  ``grid``: ``{"model": name, "reg": .., "l1_ratio": .., "cols": [..]}`` (all optional but
    the name).  Returns

    * ``(outer_fold, inner_fold, model, score)``: held-out R² of every candidate (NULL where the
      held-out target doesn't vary);
    * ``(outer_fold, model, inner_score, test_score, intercept, <cols>)``: the candidate with the
      best mean score (ties to the first of the grid), refitted on the whole training part.

    Each group is summed up once; everything else works on sums.
    """
    grid, cols = [dict(g) for g in grid], list(cols)
    uses = [[cols.index(c) for c in g.get("cols", cols)] for g in grid]
    sums = column_sums(df, cols, target, [group], weight)
    size, centre = sums.size, sums.centre
    sums.table = save(sums.table, "group-sums")
    # Sums by (outer, inner), all of an outer fold's training groups, and all groups.
    keyed = attach_group(folds.select("outer_fold", "inner_fold", group), sums.table, [group])
    parts = Sums(keyed, cols, target, centre)
    inner = save(parts.total(["outer_fold", "inner_fold"], "s"), "inner-sums")
    parts.table = inner
    outer = save(parts.total(["outer_fold"]), "outer-sums")
    everything = sums.total().first()["total"]

    def fit(s, i, start=None):
        return linear_fit(s, centre, float(grid[i].get("reg", 0.0)), float(grid[i].get("l1_ratio", 0.0)), uses[i], start)

    def candidates(row):
        val = _square(row["s"], size)
        train = _rest(_square(row["total"], size), val)
        for i in sampled(grid, trials, row["outer_fold"], seed):
            yield row["outer_fold"], row["inner_fold"], i, grid[i]["model"], r_squared(val, centre, fit(train, i))

    pairs = inner.join(outer, "outer_fold").select("outer_fold", "inner_fold", "s", "total")
    scores = save(_map_rows(pairs, candidates, "outer_fold int, inner_fold int, candidate int, model string, score double"), "inner-scores")
    mean = scores.groupBy("outer_fold", "candidate").agg(F.avg("score").alias("score"))
    best = mean.groupBy("outer_fold").agg(F.min_by(F.struct("candidate", "score"), F.struct(F.col("score").isNull(), -F.col("score"), F.col("candidate"))).alias("b"))
    best = best.select(F.col("outer_fold").alias("_o"), "b.candidate", "b.score")

    def refit(row):
        train = _square(row["total"], size)
        coef = fit(train, row["candidate"])
        test = r_squared(_rest(_square(everything, size), train), centre, coef)
        yield row["outer_fold"], grid[row["candidate"]]["model"], row["score"], test, *map(float, coef)

    names = ", ".join(f"`{c}` double" for c in cols)
    chosen = _map_rows(outer.join(best, F.col("outer_fold") == F.col("_o")).select("outer_fold", "total", "candidate", "score"), refit,
                       f"outer_fold int, model string, inner_score double, test_score double, intercept double, {names}")
    return scores.drop("candidate"), save(chosen, "refit")


# --------------------------------------------------------------------------- penalty path, elimination

def elastic_net_path(df: DataFrame, cols: Sequence[str], target: str, regs: Sequence[float], l1_ratio: float = 1.0, fold: str | None = None, weight: str | None = None) -> DataFrame:
    """ML1: ``(fold, reg, intercept, <cols>, train_r2, val_r2)`` along descending penalties, each fit
    started from its predecessor's slopes.  Per fold the model of the other folds (``val_r2`` on
    the fold), without ``fold`` one model of all rows (fold and val_r2 NULL)."""
    key = fold or "_all"
    src = df.where(F.col(fold).isNotNull()) if fold else df.withColumn("_all", F.lit(0))
    sums = column_sums(src, cols, target, [key], weight)
    sums.table = save(sums.table, "path-sums")
    total, size, centre = sums.total().first()["total"], sums.size, sums.centre
    order = sorted({float(r) for r in regs}, reverse=True)

    def path(row):
        own, start = _square(row["s"], size), None
        train = _rest(_square(total, size), own) if fold else own
        for reg in order:
            coef = linear_fit(train, centre, reg, l1_ratio, start=start)
            start = coef[1:]
            yield int(row[key]) if fold else None, reg, *map(float, coef), r_squared(train, centre, coef), r_squared(own, centre, coef) if fold else None

    names = ", ".join(f"`{c}` double" for c in cols)
    return _map_rows(sums.table, path, f"fold long, reg double, intercept double, {names}, train_r2 double, val_r2 double")


def _eliminate(s: np.ndarray, p: int, step: float, down_to: int = 1):
    """Sets of columns, from all to ``down_to``: the smallest standardised slopes go, ``step`` at a
    time (a share below 1: of all columns, one at least)."""
    _, _, cov = _moments(s)
    std = np.sqrt(np.maximum(np.diag(cov), 0.0))
    each = max(1, int(step * p)) if step < 1 else int(step)
    alive = list(range(p))
    yield list(alive)
    while len(alive) > down_to:
        b = np.linalg.pinv(cov[np.ix_(alive, alive)], hermitian=True) @ cov[alive, p]
        weak = sorted(range(len(alive)), key=lambda k: (abs(b[k]) * std[alive[k]], alive[k]))[: min(each, len(alive) - down_to)]
        alive = [a for k, a in enumerate(alive) if k not in weak]
        yield list(alive)


def rfe_cv(df: DataFrame, cols: Sequence[str], target: str, fold: str, step: float = 1, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """FS10 with the number of features chosen by cross-validation.  Returns

    * ``(fold, n_features, score)``: R² on the fold of the least-squares model of the other folds
      on each of the nested sets that elimination on those folds leaves;
    * ``(feature, ranking, chosen)``: elimination on all rows; ``chosen`` marks the set of the size
      with the best mean score (ties to the smaller set), ranked 1; those that went first rank last.
    """
    cols, p = list(cols), len(cols)
    sums = column_sums(df.where(F.col(fold).isNotNull()), cols, target, [fold], weight)
    sums.table = save(sums.table, "rfe-sums")
    total, size, centre = sums.total().first()["total"], sums.size, sums.centre

    def scores(row):
        own = _square(row["s"], size)
        train = _rest(_square(total, size), own)
        if train[0, 0] > 0:
            for alive in _eliminate(train, p, step):
                yield int(row[fold]), len(alive), r_squared(own, centre, linear_fit(train, centre, use=alive))

    table = save(_map_rows(sums.table, scores, "fold long, n_features int, score double"), "rfe-scores")
    mean = table.groupBy("n_features").agg(F.avg("score").alias("score"))
    best = mean.agg(F.min_by("n_features", F.struct(F.col("score").isNull(), -F.col("score"), F.col("n_features")))).first()[0]
    sets = list(_eliminate(_square(total, size), p, step, best or p)) if total[0] else [list(range(p))]
    rank = {}
    for n, alive in enumerate(reversed(sets)):
        for a in alive:
            rank.setdefault(a, n + 1)
    chosen = df.sparkSession.createDataFrame([(c, rank[i], rank[i] == 1) for i, c in enumerate(cols)], "feature string, ranking int, chosen boolean")
    return table, chosen
