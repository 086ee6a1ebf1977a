"""Cross-fitting, nested search, penalty paths and elimination against plain NumPy and MLlib."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.operators import crossfit, models

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 4)) * [1, 10, 0.1, 3] + [5, -2, 1000, 0]
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + 4 * x[:, 2] + r.normal(size=300)
    w = r.uniform(0.5, 2, size=300)
    return x, y, w


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, w = data
    return spark.createDataFrame([(i, i % 30, i % 5, *map(float, x[i]), float(y[i]), float(w[i])) for i in range(300)],
                                 "id long, grp long, fold long, a double, b double, c double, d double, y double, w double")


def solve(x, y, w, reg=0.0):
    mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc, n = x - mx, w.sum()
    b = np.linalg.solve((xc * w[:, None]).T @ xc / n + reg * np.eye(x.shape[1]), (xc * w[:, None]).T @ (y - my) / n)
    return np.concatenate(([my - mx @ b], b))


def r2(x, y, w, coef):
    e = y - coef[0] - x @ coef[1:]
    return 1 - (w * e * e).sum() / (w * (y - np.average(y, weights=w)) ** 2).sum()


def test_out_of_fold_predictions(rows, data):
    x, y, w = data
    got = {r.id: r.prediction for r in crossfit.cross_fit_linear(rows, COLS, "y", "fold", "w", reg=0.2).collect()}
    assert len(got) == 300
    for f in range(5):
        own = np.arange(300) % 5 == f
        coef = solve(x[~own], y[~own], w[~own], 0.2)
        assert np.allclose([got[i] for i in np.flatnonzero(own)], coef[0] + x[own] @ coef[1:])


def test_missing_values_and_folds(rows):
    """Rows without a column get no prediction, rows without a fold neither train nor get one; one fold trains nothing."""
    odd = rows.withColumn("a", F.when(F.col("id") == 7, None).otherwise(F.col("a"))).withColumn("fold", F.when(F.col("id") == 8, None).otherwise(F.col("fold")))
    got = {r.id: r.prediction for r in crossfit.cross_fit_linear(odd, COLS, "y", "fold").collect()}
    assert len(got) == 300 and {i for i, p in got.items() if p is None} == {7, 8}
    same = crossfit.cross_fit_linear(rows.where("fold = 0").unionByName(rows.where("fold = 1").withColumn("fold", F.lit(None).cast("long"))), COLS, "y", "fold")
    assert same.where("prediction IS NOT NULL AND NOT isnan(prediction)").isEmpty()
    assert crossfit.cross_fit_linear(rows.limit(0), COLS, "y", "fold").collect() == []


def test_votes(spark):
    p = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (1, 0, 1), (2, 1, 0), (2, 1, 1), (None, 1, 1), (3, 0, None)], "g int, fold int, prediction int")
    got = {r.g: (r.fold, r.vote, r.n_rows, round(r.share, 3)) for r in crossfit.out_of_fold_votes(p, "g", "fold").collect()}
    assert got == {1: (0, 1, 3, 0.667), 2: (1, 0, 2, 0.5), None: (1, 1, 1, 1.0)}


def test_cross_fit_trees_cover_all_rows(rows):
    """Weighted boosted trees out of fold: every row once, better than chance, and not the model that saw the row."""
    lab = rows.withColumn("label", (F.col("y") > 4008).cast("double"))
    est = models.classifier("gbt", label="label", weight="w", multiclass=False, maxIter=3)
    out = crossfit.cross_fit_classifier(lab, COLS, "label", "fold", 5, est).select("id", "label", "prediction").collect()
    assert sorted(r.id for r in out) == list(range(300)) and np.mean([r.label == r.prediction for r in out]) > 0.7


def test_elastic_net_equals_mllib(rows):
    """Coordinate descent on covariances and MLlib's solver agree to 1e-6, warm starts included.
    MLlib divides the squared penalty by the target's deviation; its parameters are set to match."""
    from pyspark.ml.regression import LinearRegression
    regs, sd = [3.0, 0.5, 0.05], rows.agg(F.stddev_pop("y")).first()[0]
    vec = models.assemble(rows, COLS)
    for l1 in (1.0, 0.4):
        path = {r.reg: r for r in crossfit.elastic_net_path(rows, COLS, "y", regs, l1).collect()}
        assert list(path) == regs
        for reg in regs:
            a, b = reg * l1, reg * (1 - l1) * sd
            m = LinearRegression(labelCol="y", regParam=a + b, elasticNetParam=a / (a + b), standardization=False, tol=1e-13, maxIter=2000).fit(vec)
            got = [path[reg][c] for c in COLS]
            assert np.allclose(got, m.coefficients.toArray(), rtol=0, atol=1e-6) and path[reg].intercept == pytest.approx(m.intercept, abs=1e-3)
            grad_ok(rows, got, reg, l1)


def grad_ok(rows, beta, reg, l1):
    """The solution's own optimality conditions, to 1e-9."""
    p = rows.select(*COLS, "y").toPandas()
    x, y = p[COLS].to_numpy(), p["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    g = xc.T @ (yc - xc @ np.array(beta)) / len(y) - reg * (1 - l1) * np.array(beta)
    for gj, b in zip(g, beta):
        assert abs(gj - reg * l1 * np.sign(b)) < 1e-8 if b else abs(gj) <= reg * l1 + 1e-8


def test_nested_search(spark, rows, data):
    x, y, w = data
    grid = [{"model": "all"}, {"model": "two", "cols": ["a", "c"]}, {"model": "ridge", "reg": 5.0}]
    folds = spark.createDataFrame([(o, g, (g // 3) % 4) for o in range(3) for g in range(30) if g % 3 != o], "outer_fold int, grp long, inner_fold int")
    scores, chosen = crossfit.nested_search(rows, COLS, "y", "grp", folds, grid, weight="w")
    grp = np.arange(300) % 30
    uses = [[0, 1, 2, 3], [0, 2], [0, 1, 2, 3]]

    def model(at, i):
        coef = np.zeros(5)
        c = solve(x[at][:, uses[i]], y[at], w[at], grid[i].get("reg", 0.0))
        coef[0], coef[np.array(uses[i]) + 1] = c[0], c[1:]
        return coef

    want = {}
    for o in range(3):
        for k in range(4):
            train, val = (grp % 3 != o) & (grp // 3 % 4 != k), (grp % 3 != o) & (grp // 3 % 4 == k)
            for i, g in enumerate(grid):
                want[o, k, g["model"]] = r2(x[val], y[val], w[val], model(train, i))
    got = {(r.outer_fold, r.inner_fold, r.model): r.score for r in scores.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    for r in chosen.collect():
        mean = [np.mean([want[r.outer_fold, k, g["model"]] for k in range(4)]) for g in grid]
        best = int(np.argmax(mean))
        train = grp % 3 != r.outer_fold
        assert r.model == grid[best]["model"] and r.inner_score == pytest.approx(mean[best])
        assert r.test_score == pytest.approx(r2(x[~train], y[~train], w[~train], model(train, best)), abs=1e-9)
    few, _ = crossfit.nested_search(rows, COLS, "y", "grp", folds, grid, trials=2, seed=1)
    tried = {(r.outer_fold, r.model) for r in few.collect()}
    assert len(tried) == 6 and tried == {(r.outer_fold, r.model) for r in crossfit.nested_search(rows, COLS, "y", "grp", folds, grid, trials=2, seed=1)[0].collect()}


def test_rfe_cv(rows, data):
    x, y, w = data
    scores, chosen = crossfit.rfe_cv(rows, COLS, "y", "fold")

    def sets(at):
        alive = [0, 1, 2, 3]
        out = [list(alive)]
        while len(alive) > 1:
            b = solve(x[at][:, alive], y[at], np.ones(at.sum()))[1:]
            alive = [a for k, a in enumerate(alive) if k != int(np.argmin(np.abs(b) * x[at][:, alive].std(0)))]
            out.append(list(alive))
        return out

    got = {(r.fold, r.n_features): r.score for r in scores.collect()}
    want = {}
    for f in range(5):
        own = np.arange(300) % 5 == f
        for s in sets(~own):
            want[f, len(s)] = r2(x[own][:, s], y[own], np.ones(own.sum()), solve(x[~own][:, s], y[~own], np.ones((~own).sum())))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    best = max(range(1, 5), key=lambda n: (np.mean([want[f, n] for f in range(5)]), -n))
    assert {r.feature for r in chosen.collect() if r.chosen} == {COLS[i] for i in sets(np.ones(300, bool))[4 - best]}
    half = crossfit.rfe_cv(rows, COLS, "y", "fold", step=0.5)[0]
    assert {r.n_features for r in half.collect()} == {4, 2, 1}
