"""The model path end to end: fits, searches, persisted scoring, reductions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.operators import folds, metrics, models, scale, select


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(240, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    data = [(i, i % 12, *map(float, x[i]), float(y[i]), float(3 * x[i, 0] - 2 * x[i, 2] + 1)) for i in range(240)]
    return spark.createDataFrame(data, "id long, grp long, a double, b double, c double, label double, target double")


COLS = ["a", "b", "c"]


@pytest.mark.parametrize("kind, extra", [("logistic", {}), ("random_forest", {"numTrees": 10}), ("gbt", {"maxIter": 5}), ("linear_svc", {"maxIter": 20}),
                                         ("mlp", {"layers": [3, 6, 2], "maxIter": 60})])
def test_classifiers_learn(rows, kind, extra):
    est = models.classifier(kind, multiclass=kind == "linear_svc", **extra)
    out = models.score_rows(est.fit(models.assemble(rows, COLS)), rows, COLS)
    s = metrics.classification_scores(out.select(F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))).first()
    assert s["accuracy"] > 0.85 and out.count() == 240


def test_ridge_equals_normal_equations(rows):
    f = rows.withColumn("fold", (F.col("id") % 4).cast("int"))
    got = models.grid_fold_scores(f, COLS, "target", [{"model": "ols"}, {"model": "ridge", "reg": 0.3}, {"model": "lasso", "reg": 0.01, "l1_ratio": 1.0}], "fold")
    assert got.count() == 240 * 4 * 3 and got.where("set = 'val'").groupBy("model").count().where("count <> 240").count() == 0
    sc = {(r["model"], r["set"]): r["r2"] for r in metrics.regression_scores(got, ["model", "set"]).collect()}
    assert sc[("ols", "val")] == pytest.approx(1.0) and 0.7 < sc[("ridge", "val")] < 1 and sc[("lasso", "val")] > 0.99
    p = rows.toPandas()
    x, y = p[COLS].to_numpy()[p["id"] % 4 != 0], p["target"].to_numpy()[p["id"] % 4 != 0]
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc / len(x) + 0.3 * np.eye(3), xc.T @ yc / len(x))
    want = sorted((p[COLS].to_numpy()[p["id"] % 4 == 0] - x.mean(0)) @ beta + y.mean())
    mine = sorted(r.y_pred for r in got.where("model = 'ridge' AND set = 'val' AND fold = 0").collect())
    assert mine == pytest.approx(want)


def test_search_and_persisted_pipeline(rows, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import ParamGridBuilder
    est = models.classifier("logistic")
    f = folds.strict_group_folds(rows.withColumn("one", F.lit(1)), "grp", "one", 3)
    assert f.groupBy("grp").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0
    best = models.cross_validate(est, ParamGridBuilder().addGrid(est.regParam, [0.0, 10.0]).build(), models.assemble(f, COLS), "fold", BinaryClassificationEvaluator())
    assert best.avgMetrics[0] >= best.avgMetrics[1]
    assert models.random_search([{"k": i} for i in range(9)], 3, 1) == models.random_search([{"k": i} for i in range(9)], 3, 1)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=[f"_x_{c}" for c in COLS], outputCol="v"), models.classifier("random_forest", numTrees=5).setFeaturesCol("v")])
    fitted = pipe.fit(rows.select("*", *[F.col(c).alias(f"_x_{c}") for c in COLS]))
    holes = rows.withColumn("b", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("b")))
    out = models.save_and_score(fitted, f"file://{tmp_path}/m", holes, COLS)
    assert out.count() == 240 and out.where("prediction IS NULL").count() == 48
    top = models.feature_importances(fitted.stages[-1], COLS, 2).collect()
    assert top[0]["feature"] == "a" and len(top) == 2


def test_reductions_match_numpy(rows):
    p = rows.toPandas()[COLS].to_numpy()
    v = scale.pca_variance(rows, COLS)
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(p.T)))[::-1]
    assert [r.explained_variance_ratio for r in v.orderBy("component").collect()] == pytest.approx(list(want / want.sum()))
    assert scale.pca_components_for(v, 1.0) == 3
    proj = np.array([[r.pc0, r.pc1] for r in scale.pca_project(rows, COLS, 2, keep=["id"]).orderBy("id").collect()])
    _, vec = np.linalg.eigh(np.cov(p.T))
    assert np.abs(proj) == pytest.approx(np.abs(p @ vec[:, ::-1][:, :2]))
    fit = scale.pls_weights(rows, COLS, "target", 3)
    t = np.array([[r.pls0, r.pls1, r.pls2] for r in scale.pls_scores(rows, COLS, fit).collect()])
    g = t.T @ t
    assert np.abs(g - np.diag(np.diag(g))).max() < 1e-6 * np.diag(g).max()  # scores are orthogonal
    y = rows.toPandas()["target"].to_numpy()
    assert sorted(t @ fit["y_loadings"] + fit["y_mean"]) == pytest.approx(sorted(y), abs=1e-6)  # all components: least squares
    far = rows.selectExpr("a + 1e9 AS a", "b", "c", "target")
    shifted = scale.pls_weights(far, COLS, "target", 1)["rotation"][:, 0]
    assert shifted == pytest.approx(scale.pls_weights(rows, COLS, "target", 1)["rotation"][:, 0], abs=1e-4)


def test_kmeans_centres_feed_rbf(rows):
    c = scale.kmeans_centroids(rows, COLS, 3)
    assert c.shape == (3, 3)
    r = scale.rbf_features(rows, COLS, c).agg(*[F.max(f"rbf{i}") for i in range(3)]).first()
    assert all(0 < v <= 1 for v in r)


def test_unknown_model_raises(rows):
    sc = rows.selectExpr("'m' AS model", "grp AS p", "a AS score")
    assert metrics.score_curve(sc, "p", "score", "m").count() == 12
    with pytest.raises(ValueError):
        metrics.score_curve(sc, "p", "score", "other")


def test_select_polynomials(rows):
    assert len(select.polynomial_terms(COLS, 2)) == 9


def test_lloyd_rounds_equal_plain_rounds(spark):
    """Far-point start and rounds as in NumPy; partitioning doesn't matter; rows with holes take no part."""
    r = np.random.default_rng(6)
    x = np.concatenate([r.normal(size=(80, 2)) + c for c in ([0, 0], [9, 0], [0, 9])])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)] + [(-1, None, 1.0)], "id long, a double, b double")
    import hashlib
    start = min(range(240), key=lambda i: int(hashlib.md5(f"{i}42".encode()).hexdigest()[:8], 16))
    c = [x[start]]
    while len(c) < 3:
        c.append(x[np.argmax(np.min([((x - m) ** 2).sum(1) for m in c], axis=0))])
    for _ in range(20):
        at = np.argmin([((x - m) ** 2).sum(1) for m in c], axis=0)
        c = [x[at == k].mean(0) for k in range(3)]
    for n in (1, 5):
        got = scale.lloyd_centroids(df.repartition(n), ["a", "b"], "id", 3).orderBy("cluster").collect()
        assert np.allclose([[g.a, g.b] for g in got], c) and [g.n for g in got] == [int((at == k).sum()) for k in range(3)]
    few = scale.lloyd_centroids(df.limit(1), ["a", "b"], "id", 2).collect()
    assert sorted(g.n for g in few) == [0, 1] and scale.lloyd_centroids(df.limit(0), ["a", "b"], "id", 2).collect() == []


def test_pca_to_share(rows):
    p = rows.toPandas()
    z = (p[COLS] - p[COLS].mean()) / p[COLS].std(ddof=0)
    vals, vecs = np.linalg.eigh(np.cov(z.T, ddof=0))
    share = np.cumsum(vals[::-1]) / vals.sum()
    for k in (1, 2, 3):
        out = scale.pca_to_share(rows, COLS, float(share[k - 1]), ["id"]).toPandas().sort_values("id")
        assert list(out.columns) == ["id", *[f"pc{i}" for i in range(k)]]
        assert np.allclose(np.abs(out["pc0"]), np.abs(z.to_numpy()[p["id"].argsort()] @ vecs[:, -1]))


def test_saved_pipeline_takes_raw_rows(spark, rows, tmp_path):
    """Feature stages are saved with the model; a new session scores raw rows the same, holes give NULL."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from ferrule.operators import stages
    terms = stages.PolynomialTerms(inputCols=["a", "b"], degree=2)
    names = ["a", "b", *terms.names(), "rbf0", "rbf1"]
    pipe = Pipeline(stages=[stages.RbfFeatures(inputCols=["a", "b"], idCol="id", k=2), terms, stages.StandardScale(inputCols=["a", "b"]), stages.RobustScale(inputCols=terms.names()),
                            VectorAssembler(inputCols=names, outputCol="v"), LinearRegression(featuresCol="v", labelCol="target")])
    raw = rows.select("id", "a", "b", "target")
    model, path = pipe.fit(raw), f"file://{tmp_path}/pipe"
    model.write().save(path)
    want = {r.id: r.prediction for r in model.transform(raw).collect()}
    other = spark.newSession().createDataFrame(raw.collect() + [(999, None, 1.0, 0.0)], raw.schema)
    got = {r.id: r.prediction for r in stages.score_saved(path, other, ["a", "b"]).collect()}
    assert got.pop(999) is None and got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert [type(s).__name__ for s in PipelineModel.load(path).stages[:4]] == ["RbfModel", "PolynomialTerms", "AffineScaleModel", "AffineScaleModel"]
    kept = stages.score_saved(path, other, ["a", "b"])
    assert kept.columns == ["id", "a", "b", "target", "prediction"] and kept.where("id = 999 AND a IS NULL").count() == 1


def test_pose_stage_equals_the_operator(spark, sf_dir, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from ferrule.operators import pose, stages
    from ferrule.sources import tables
    p33 = tables.pose33_frame(spark, sf_dir)
    path = f"file://{tmp_path}/pose"
    Pipeline(stages=[stages.PoseFeatures(inputCol="features")]).fit(p33).write().save(path)
    got = PipelineModel.load(path).transform(p33).drop("features", "patient_id", "target").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, pose.feature_row(p33, "features", pose.POSE33, keep=["row_id"]).collect()))
