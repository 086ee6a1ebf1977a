"""Isolation filter: planted outliers, reruns, missing values, small and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.operators import isolation

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(2000, 2))
    x[:10] += r.choice([-1, 1], size=(10, 2)) * 12
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")


def test_planted_outliers_rank_first_and_reruns_agree(rows):
    got = [isolation.isolation_scores(rows.repartition(n), "id", COLS).select("id", "score").collect() for n in (1, 7)]
    first, again = ({r.id: r.score for r in g} for g in got)
    assert first == again and len(first) == 2000
    assert set(sorted(first, key=lambda i: -first[i])[:10]) == set(range(10))
    assert 0.3 < np.median(list(first.values())) < 0.5 < min(first[i] for i in range(10))


def test_sample_size_and_depth(rows):
    forest = isolation.grow_forest(rows, "id", COLS, trees=20, sample=100, depth=6)
    roots = [r.n for r in forest.where("node = 0").collect()]
    assert len(roots) == 20 and 60 < np.mean(roots) < 140
    assert forest.agg(F.max("node")).first()[0] < 2 ** 7 - 1 and forest.where("feature IS NOT NULL AND n < 2").isEmpty()
    children = forest.where("node > 0").groupBy("tree", F.expr("(node - 1) div 2").alias("up")).agg(F.sum("n").alias("n"))
    both = children.join(forest.select(F.col("tree").alias("t"), F.col("node").alias("v"), F.col("n").alias("m")), F.expr("tree = t AND up = v"))
    assert both.where("n <> m").isEmpty() and both.count() > 20


def test_counts_and_missing(spark, rows):
    odd = rows.unionByName(spark.createDataFrame([(-1, None, 1.0), (-2, float("nan"), 2.0)], "id long, a double, b double"))
    scored = isolation.isolation_scores(odd, "id", COLS)
    c = isolation.filter_counts(scored).first()
    kept = isolation.isolation_filter(scored)
    assert (c.before, c.unscored) == (2002, 2) and c.after == c.before - c.dropped == kept.count() and kept.columns == rows.columns
    assert {r.id for r in kept.where("id < 10").collect()} == {-1, -2}


def test_constant_tiny_and_empty(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)], "id long, a double, b double")
    assert {round(r.score, 9) for r in isolation.isolation_scores(same, "id", COLS).collect()} == {0.5}
    assert isolation.isolation_scores(same.limit(0), "id", COLS).collect() == []
    assert isolation.isolation_scores(same.limit(1), "id", COLS).count() == 1
