"""Queries of fitted reductions: centroids by Lloyd rounds, components to a share, PLS."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round_all
from ..operators import scale
from ..sources import tables
from . import sql_fragments as S
from .catalog import register

ROUNDS = 4


def _li(spark, d):
    li = tables.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    return li.withColumn("rate", F.col("l_discount") * 500).withColumn("row_id", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_extendedprice"))


def _lloyd_sql() -> str:
    """Two centroids over (quantity, 500 x discount): hash start, farthest row, rounds unrolled."""
    dist = lambda c: f"((x - {c}.x) * (x - {c}.x) + (y - {c}.y) * (y - {c}.y))"
    out = [f"""li AS (SELECT l_quantity::DOUBLE AS x, l_discount::DOUBLE * 500 AS y, {S.portable_hash_sql("(l_orderkey || ':' || l_linenumber || ':' || l_extendedprice)")} AS h FROM lineitem)""",
           "a0 AS (SELECT x, y, 0 AS n FROM li ORDER BY h, x, y LIMIT 1)", f"b0 AS (SELECT li.x, li.y, 0 AS n FROM li, a0 ORDER BY -((li.x - a0.x) * (li.x - a0.x) + (li.y - a0.y) * (li.y - a0.y)), li.x, li.y LIMIT 1)"]
    for r in range(ROUNDS):
        near = f"CASE WHEN {dist('a').replace('(x -', '(li.x -').replace('(y -', '(li.y -')} <= {dist('b').replace('(x -', '(li.x -').replace('(y -', '(li.y -')} THEN 0 ELSE 1 END"
        out.append(f"g{r} AS (SELECT {near} AS c, avg(li.x) AS x, avg(li.y) AS y, count(*) AS n FROM li, a{r} a, b{r} b GROUP BY 1)")
        for t, i in (("a", 0), ("b", 1)):
            out.append(f"{t}{r + 1} AS (SELECT coalesce(g.x, o.x) AS x, coalesce(g.y, o.y) AS y, coalesce(g.n, 0) AS n FROM {t}{r} o LEFT JOIN g{r} g ON g.c = {i})")
    out.append(f"cen AS (SELECT 0 AS cluster, * FROM a{ROUNDS} UNION ALL SELECT 1, * FROM b{ROUNDS})")
    return ", ".join(out)


def _centroids(spark, d):
    return scale.lloyd_centroids(_li(spark, d), ["l_quantity", "rate"], "row_id", 2, ROUNDS)


@register("scale_lloyd_centroids", f"WITH {_lloyd_sql()} SELECT cluster, n, round(x, 6) AS l_quantity, round(y, 6) AS rate FROM cen")
def q_scale_lloyd_centroids(spark, d):
    return round_all(_centroids(spark, d))


@register("scale_rbf_fitted", f"""WITH {_lloyd_sql()}, s AS (SELECT sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2) AS s, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS b_y FROM a{ROUNDS} a, b{ROUNDS} b)
SELECT l_orderkey, l_linenumber, round(exp(-((l_quantity - ax) ^ 2 + (l_discount * 500 - ay) ^ 2) / (2 * s * s)), 6) AS rbf0,
  round(exp(-((l_quantity - bx) ^ 2 + (l_discount * 500 - b_y) ^ 2) / (2 * s * s)), 6) AS rbf1 FROM lineitem, s""")
def q_scale_rbf_fitted(spark, d):
    """RBF features of the centroids that the rounds found."""
    centres = [[r["l_quantity"], r["rate"]] for r in _centroids(spark, d).orderBy("cluster").collect()]
    return round_all(scale.rbf_features(_li(spark, d), ["l_quantity", "rate"], centres, keep=["l_orderkey", "l_linenumber"]))


@register("scale_pca_to_share", """WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS mp, stddev_pop(l_quantity) AS sx, stddev_pop(l_extendedprice) AS sp, sign(corr(l_quantity, l_extendedprice)) AS g FROM lineitem)
SELECT l_orderkey, l_linenumber, round(((l_quantity - mx) / sx + g * (l_extendedprice - mp) / sp) / sqrt(2), 5) AS pc0,
  round(((l_quantity - mx) / sx - g * (l_extendedprice - mp) / sp) / sqrt(2), 5) AS pc1 FROM lineitem, m""")
def q_scale_pca_to_share(spark, d):
    """Two correlated columns: 99.9 % of the variance takes both components."""
    return round_all(scale.pca_to_share(_li(spark, d), ["l_quantity", "l_extendedprice"], 0.999, ["l_orderkey", "l_linenumber"]), 5)


@register("scale_pls_scores", """WITH m AS (SELECT avg(l_quantity) AS m0, avg(l_discount) AS m1, avg(l_tax) AS m2, covar_pop(l_quantity, l_extendedprice) AS c0, covar_pop(l_discount, l_extendedprice) AS c1, covar_pop(l_tax, l_extendedprice) AS c2 FROM lineitem)
SELECT l_orderkey, l_linenumber, round(((l_quantity - m0) * c0 + (l_discount - m1) * c1 + (l_tax - m2) * c2) / sqrt(c0 * c0 + c1 * c1 + c2 * c2), 6) AS pls0 FROM lineitem, m""")
def q_scale_pls_scores(spark, d):
    li, cols = _li(spark, d), ["l_quantity", "l_discount", "l_tax"]
    fit = scale.pls_weights(li, cols, "l_extendedprice", 1)
    return round_all(scale.pls_scores(li, cols, fit, ["l_orderkey", "l_linenumber"]))


# --------------------------------------------------------------------------- saved pipeline

@register("ml_saved_pipeline", """WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS x, l_quantity::DOUBLE ^ 2 AS y, l_extendedprice::DOUBLE AS t FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(t) AS mt, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, t) AS xt, covar_pop(y, t) AS yt FROM li)
SELECT l_orderkey, l_linenumber, round(mt + (x - mx) * (xt * yy - yt * xy) / (xx * yy - xy * xy) + (y - my) * (yt * xx - xt * xy) / (xx * yy - xy * xy), 2) AS prediction FROM li, m""")
def q_ml_saved_pipeline(spark, d):
    """Terms, scaling and a linear model fitted on raw rows, saved, loaded, and applied to raw rows."""
    import uuid
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from ..operators import stages
    from ..storage import shared_dir
    li = _li(spark, d).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    names = ["l_quantity", "l_quantity^2"]
    pipe = Pipeline(stages=[stages.PolynomialTerms(inputCols=["l_quantity"], degree=2), stages.StandardScale(inputCols=names),
                            VectorAssembler(inputCols=names, outputCol="v"), LinearRegression(featuresCol="v", labelCol="l_extendedprice", solver="normal")])
    path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    pipe.fit(li).write().save(path)
    return round_all(stages.score_saved(path, li, ["l_quantity"]).select("l_orderkey", "l_linenumber", "prediction"), 2)


# --------------------------------------------------------------------------- logistic regression on PLS scores

def _pls_logistic_sql(steps: int = 8) -> str:
    """Newton's method on intercept and slope, a scan of the rows each."""
    out = ["""li AS (SELECT l_quantity::DOUBLE AS a, l_discount::DOUBLE AS b, l_tax::DOUBLE AS c, (l_returnflag = 'R')::INT::DOUBLE AS y FROM lineitem),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, covar_pop(a, y) AS ca, covar_pop(b, y) AS cb, covar_pop(c, y) AS cc FROM li),
s AS (SELECT ((a - ma) * ca + (b - mb) * cb + (c - mc) * cc) / sqrt(ca * ca + cb * cb + cc * cc) AS x, y FROM li, m),
n0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1)"""]
    for k in range(steps):
        out.append(f"""e{k} AS (SELECT b0, b1, x, y, 1 / (1 + exp(-b0 - b1 * x)) AS p FROM s, n{k}),
h{k} AS (SELECT any_value(b0) AS b0, any_value(b1) AS b1, sum(y - p) AS g0, sum((y - p) * x) AS g1, sum(p * (1 - p)) AS w0, sum(p * (1 - p) * x) AS w1, sum(p * (1 - p) * x * x) AS w2 FROM e{k}),
n{k + 1} AS (SELECT b0 + (g0 * w2 - g1 * w1) / (w0 * w2 - w1 * w1) AS b0, b1 + (g1 * w0 - g0 * w1) / (w0 * w2 - w1 * w1) AS b1 FROM h{k})""")
    return f"WITH {', '.join(out)} SELECT 'intercept' AS term, round(b0, 5) AS coef FROM n{steps} UNION ALL SELECT 'pls0', round(b1, 5) FROM n{steps}"


@register("ml_pls_logistic", _pls_logistic_sql())
def q_ml_pls_logistic(spark, d):
    """ML2: one PLS score against a returned item, then logistic regression on it."""
    from ..operators import models
    li = tables.read_table(spark, d, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("double"))
    cols = ["l_quantity", "l_discount", "l_tax"]
    scored = scale.pls_scores(li, cols, scale.pls_weights(li, cols, "y", 1), ["y"])
    est = models.classifier("logistic", label="y", tol=1e-13, maxIter=500)
    m = est.fit(models.assemble(scored, ["pls0"]))
    return round_all(spark.createDataFrame([("intercept", float(m.intercept)), ("pls0", float(m.coefficients[0]))], "term string, coef double"), 5)


# --------------------------------------------------------------------------- columns

@register("prof_numeric_means", """SELECT 'o_orderkey' AS "column", round(avg(o_orderkey), 4) AS mean FROM orders
UNION ALL SELECT 'o_custkey', round(avg(o_custkey), 4) FROM orders UNION ALL SELECT 'o_totalprice', round(avg(o_totalprice), 4) FROM orders""")
def q_prof_numeric_means(spark, d):
    """the numeric columns that are left when some (one of them absent) are dropped."""
    from ..functions.columns import numeric_columns
    o = tables.read_table(spark, d, "orders").drop("o_shippriority", "not_there")
    cols = numeric_columns(o)
    means = o.agg(*[F.avg(c).alias(c) for c in cols])
    return round_all(means.unpivot([], cols, "column", "mean"), 4)


@register("pose_components", f"WITH {S.POSE_CTE} SELECT row_id, " + ", ".join(f"features[{2 * j + 1}] AS x{j}, features[{33 + 2 * j}] AS xstd{j}" for j in (0, 7, 15)) + " FROM pose")
def q_pose_components(spark, d):
    """The component arrays of interleaved poses."""
    from ..operators import pose
    p = tables.pose_frame(spark, d).withColumn("i", pose.to_interleaved("features", 16)).withColumns({"x": pose.component("i", 16, 0), "s": pose.component("i", 16, 2)})
    return p.select("row_id", *[F.get(c, F.lit(j)).alias(f"{n}{j}") for j in (0, 7, 15) for n, c in (("x", "x"), ("xstd", "s"))])
