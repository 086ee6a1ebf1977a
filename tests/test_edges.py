"""Hand-made edge fixtures (FIXTURES.md section 4) and invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.operators import folds, metrics, pose, profile, quantile, select, sequence

SEQ = "rec long, frame long, joint int, x double, y double"


def _feat(spark, rows):
    df = spark.createDataFrame(rows, SEQ)
    return {r["rec"]: r for r in sequence.motion_features(df, ["rec", "joint"]).collect()}


def test_short_sequences_give_zero(spark):
    f = _feat(spark, [(1, 0, 0, 1.0, 2.0), (2, 0, 0, 1.0, 1.0), (2, 1, 0, 4.0, 5.0)])
    assert f[1]["path_length"] == 0 and f[1]["speed_mean"] == 0 and f[1]["direction_changes"] == 0
    assert f[2]["path_length"] == 5.0 and f[2]["direction_changes"] == 0
    assert f[2]["speed_per_frame"] == 2.5 and f[2]["speed_mean"] == 5.0


def test_still_sequence(spark):
    f = _feat(spark, [(1, k, 0, 3.0, 3.0) for k in range(5)])[1]
    assert f["amplitude"] == 0 and f["path_length"] == 0
    assert f["orientation_changes"] == 0 and f["path_norm_2amp"] == 0 and f["path_norm_amp"] == 0


def test_turns_across_pi_wrapped_vs_unwrapped(spark):
    # steps with angles +170, -170, +170 ... degrees: unwrapped jump 340 deg, wrapped 20 deg
    pts, x, y = [], 0.0, 0.0
    for k in range(6):
        pts.append((1, k, 0, x, y))
        a = math.radians(170 if k % 2 == 0 else -170)
        x, y = x + math.cos(a), y + math.sin(a)
    f = _feat(spark, pts)[1]
    assert f["direction_changes"] == 0          # wrapped 20 deg < 0.5 rad
    assert f["orientation_changes"] == 4        # unwrapped 340 deg > 45 deg


def test_lookback_blocks_match_plain_window(spark):
    rows = [(1, k, 0, float((k * 7) % 5), float((k * 3) % 4)) for k in range(40)]
    df = spark.createDataFrame(rows, SEQ)
    small = sequence.motion_steps(df, ["rec", "joint"], block_rows=8).orderBy("frame").collect()
    big = sequence.motion_steps(df, ["rec", "joint"]).orderBy("frame").collect()
    assert [(r.frame, r.step, r.sx, r.dangle) for r in small] == [(r.frame, r.step, r.sx, r.dangle) for r in big]


def test_vote_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (1, 1), (1, 2)], "g long, p int")
    assert folds.majority_label(df, "g", "p", "v").first()["v"] == 1


def test_iqr_quantiles_and_null_outside(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,), (None,)], "v double")
    b = profile.iqr_bounds(df, ["v"], 1.5).first()
    assert b["q1"] == 1.75 and b["q3"] == 5.25
    flags = {r["v"]: r["inlier"] for r in profile.iqr_flag(df, ["v"], 1.5).collect()}
    assert flags[None] is False and flags[9.0] is True


def test_strict_folds_raise_with_few_groups(spark):
    df = spark.createDataFrame([(g, 0 if g < 5 else 1) for g in range(7)], "g long, y int")
    with pytest.raises(Exception):
        folds.strict_group_folds(df, "g", "y", k=3).collect()


def test_strict_folds_disjoint_and_complete(spark):
    df = spark.range(600).select((F.col("id") % 60).alias("g"), (F.col("id") % 60 % 3).alias("y"), "id")
    out = folds.strict_group_folds(df, "g", "y", k=4)
    assert out.count() == 600
    assert out.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert out.select("fold").distinct().count() == 4


def test_unknown_code_raises(spark):
    df = spark.createDataFrame([("E1",), ("E9",)], "e string")
    with pytest.raises(Exception):
        pose.one_hot_closed(df, "e", ["E1", "E2"]).collect()


def test_zero_denominators_are_safe(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0)], "a double, b double, c double")
    assert profile.coefficient_of_variation(df, ["a"]).first()["cv"] is None
    assert select.corr_pairs(df, ["a", "b"]).count() == 1


def test_near_constant_stages(spark):
    rows = [(5.0, 0.0 if i < 97 else 1.0, 1.0 + (1e-6 if i == 0 else 0.0), float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "const double, zeros double, near double, normal double")
    st = profile.near_constant_stats(df, ["const", "zeros", "near", "normal"])
    dec = {r["column"]: r["drop"] for r in profile.near_constant_filter(st).collect()}
    assert dec == {"const": True, "zeros": True, "near": True, "normal": False}


def test_mcar_empty_side_is_null(spark):
    from ferrule.operators import quality
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0), (4.0, 5.0)], "a double, b double")
    res = {r["column"]: r for r in quality.little_mcar(df, ["a", "b"]).collect()}
    assert res["a"]["p_value"] is None
    assert res["b"]["statistic"] is not None


def test_exact_quantiles_match_numpy_on_skewed_group(spark):
    import numpy as np
    vals = [float(v) for v in np.random.default_rng(0).lognormal(size=3000)]
    df = spark.createDataFrame([(1 if i % 3 else 2, v) for i, v in enumerate(vals)], "g int, v double")
    q = {(r["g"], r["prob"]): r["quantile"] for r in quantile.quantiles(df, ["v"], [0.1, 0.5, 0.9], by=["g"]).collect()}
    for g in (1, 2):
        arr = np.array([v for i, v in enumerate(vals) if (1 if i % 3 else 2) == g])
        for p in (0.1, 0.5, 0.9):
            assert abs(q[(g, p)] - np.quantile(arr, p)) < 1e-12


def test_number_rows_under_skew(spark):
    """One outlier key, a tied first key, a heavy tail and a NULL group: numbers are dense
    and no range holds more than twice its share."""
    from ferrule.operators.ordering import number_rows, ranged
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("hot")).alias("g"),
        F.when(F.col("id") == 5, 1e12).when(F.col("id") % 2 == 0, F.exp((F.col("id") % 97) / 5.0)).otherwise((F.col("id") % 10).cast("double")).alias("o"), "id")
    got = number_rows(df, ["g"], ["o", "id"], "rn", total="n").toPandas()
    assert len(got) == n
    for _, part in got.groupby("g", dropna=False):
        part = part.sort_values(["o", "id"])
        assert list(part["rn"]) == list(range(len(part))) and set(part["n"]) == {len(part)}
    sizes = [r["count"] for r in ranged(df, ["g", "o", "id"]).groupBy("_chunk").count().collect()]
    assert max(sizes) <= 2 * n / len(sizes)
    text = df.select(F.concat(F.lit("k"), "id").alias("k"), "id")
    assert [r.k for r in number_rows(text, [], ["k"], "rn").orderBy("rn").collect()] == sorted(f"k{i}" for i in range(n))


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else f"g{i % 9}", i % 2, float(i), i) for i in range(90)], "g string, y int, v double, id long")
    for out in (folds.strict_group_folds(df, "g", "y", k=2), folds.stratified_group_kfold(df, "g", "y", k=2), folds.leave_one_group_out(df, "g")):
        assert out.count() == 90 and out.where("fold IS NULL").count() == 0
        assert out.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n <> 1").count() == 0
    assert metrics.winsorized_mape(df.withColumnRenamed("v", "y_true").withColumn("y_pred", F.lit(1.0)), ["g"]).where("g IS NULL").count() == 1
    nc = profile.near_constant_stats(df.withColumn("none", F.lit(None).cast("double")), ["v", "none"], ["g"])
    assert nc.where("g IS NULL").count() == 2 and nc.where("column = 'none' AND range IS NULL").count() == 10
    assert pose.arm_over_patient_max(df, "v", "g").count() == 90


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (3.0,)], "v double")
    r = profile.describe(df, ["v"]).first()
    assert (r["count"], r["mean"], r["q75"]) == (3, 2.0, 2.5)


def test_large_offsets_do_not_cancel(spark):
    from ferrule.operators import scale
    off = 1e9
    df = spark.createDataFrame([(off + i % 7, off + i % 7 + 0.01 * (i % 2), i % 3) for i in range(300)], "y_true double, y_pred double, fold int")
    import numpy as np
    y = np.array([i % 7 for i in range(300)], float)
    want = 1 - np.mean([(0.01 * (i % 2)) ** 2 for i in range(300)]) / y.var()
    assert metrics.regression_scores(df, []).first()["r2"] == pytest.approx(want, abs=1e-7)
    got = [r.y_true for r in scale.fold_standardize(df.select("fold", "y_true"), ["y_true"]).where("fold = 0").collect()]
    train = np.array([i % 7 for i in range(300) if i % 3], float)
    want = sorted((np.array([i % 7 for i in range(0, 300, 3)]) - train.mean()) / train.std())
    assert sorted(got) == pytest.approx(want, abs=1e-5)
    c = select.corr_pairs(df, ["y_true", "y_pred"]).first()["corr"]
    assert c == pytest.approx(np.corrcoef(y, y + np.array([0.01 * (i % 2) for i in range(300)]))[0, 1], abs=1e-6)


def test_scores_use_the_labels_of_their_group(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (0, 0, 0), (1, 0, 0), (1, 1, 1), (1, 2, 2)], "fold int, y_true int, y_pred int")
    got = {r.fold: r for r in metrics.classification_scores(df, ["fold"]).collect()}
    assert got[0].macro_f1 == 1.0 and got[1].macro_f1 == 1.0
    extra = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 2)], "y_true int, y_pred int")
    r = metrics.classification_scores(extra).first()
    assert r.balanced_accuracy == 0.75 and r.macro_recall == 0.5
    zero = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "y_true double, y_pred double")
    assert metrics.regression_scores(zero, []).first()["smape"] == pytest.approx(100 * (2 / 3) / 2)


def test_scoring_keeps_every_row(spark):
    from ferrule.operators import models, scale
    df = spark.createDataFrame([(float(i), float(i % 4) if i % 5 else None, 3.0 * i + (i % 4 if i % 5 else 0)) for i in range(40)], "a double, b double, y double")
    train, left = models.fit_rows(df, ["a", "b"], ["y"])
    assert (train.count(), left) == (32, 8)
    m = models.linear_regression(train, ["a", "b"], "y")
    out = models.score_rows(m, df, ["a", "b"])
    assert out.count() == 40 and out.where("prediction IS NULL").count() == 8 and out.columns == [*df.columns, "prediction"]
    assert scale.pca_project(df, ["a", "b"], 1).count() == 40
    with pytest.raises(ValueError):
        models.classifier("mlp", weight="a", layers=[2, 2])


def test_imputer_on_text_columns(spark):
    from ferrule.operators import quality
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(60)], "id long, c string")
    r = quality.evaluate_imputer(df, "id", ["c"], "mode", 0.2).first()
    assert r["n_masked"] == 12 and 0.3 < r["score"] <= 1.0


def test_histogram_of_a_wide_range(spark):
    df = spark.createDataFrame([(0.0,), (3e6,), (3e6 - 1,)], "v double")
    assert profile.shared_histogram(df, ["v"], empty=False).count() == 3
    with pytest.raises(Exception):
        profile.shared_histogram(df, ["v"]).collect()
    assert profile.shared_histogram(df, ["v"], nbins=10).agg(F.sum("count")).first()[0] == 3


def test_confusion_sums_to_n_and_auc_ties(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.9), (1, 0, 0.2), (0, 0, 0.1)], "y_true int, y_pred int, score double")
    conf = metrics.confusion(df)
    assert conf.agg(F.sum("n")).first()[0] == 4 and conf.count() == 4
    assert metrics.roc_auc(df).first()["roc_auc"] == 0.625


def test_dominant_sets_and_grid_order(spark):
    items = spark.createDataFrame([("a", 0.5), ("a b", 0.4), ("b", 0.1), ("a^2 b", 0.6)], "name string, score double")
    kept = {r["name"] for r in select.dominant_sets(items).collect()}
    assert kept == {"a", "b", "a^2 b"}
    grid = select.parameter_grid({"p": [1, 2], "q": ["x", "y"]})
    assert grid == [{"p": 1, "q": "x"}, {"p": 2, "q": "x"}, {"p": 1, "q": "y"}, {"p": 2, "q": "y"}]
    gdf = {r["ordinal"]: (r["p"], r["q"]) for r in select.parameter_grid_df(spark, {"p": [1, 2], "q": ["x", "y"]}).collect()}
    assert gdf == {0: ("1", "x"), 1: ("2", "x"), 2: ("1", "y"), 3: ("2", "y")}


def test_greedy_group_folds(spark):
    """Equal to a plain greedy over single groups, in one fold each, and no worse balanced than the round-robin."""
    import numpy as np
    from ferrule.operators import folds
    r = np.random.default_rng(4)
    rows = [(g, int(r.integers(3))) for g in range(60) for _ in range(int(r.pareto(1.2) * 3) + 1)] + [(None, 1)] * 4 + [(100 + i, 0) for i in range(30)]
    df = spark.createDataFrame(rows, "g long, y int")
    got = {}
    for x in folds.greedy_group_kfold(df, "g", "y", 4).collect():
        got.setdefault(x.g, set()).add(x.fold)
    assert len(got) == 91 and all(len(f) == 1 for f in got.values())
    count = {g: np.array([sum(1 for a, b in rows if a == g and b == c) for c in range(3)]) for g in got}
    total, held, want = sum(count.values()), np.zeros((4, 3)), {}
    for g in sorted(count, key=lambda g: (-(3 * (count[g] ** 2).sum() - count[g].sum() ** 2), tuple(count[g]))):
        cost = []
        for f in range(4):
            h = held.copy()
            h[f] += count[g]
            cost.append((round(float((h / total).std(axis=0).sum()), 12), held[f].sum(), f))
        held[min(cost)[2]] += count[g]
        want.setdefault(tuple(count[g]), []).append(min(cost)[2])
    have = {}
    for g, f in got.items():
        have.setdefault(tuple(count[g]), []).extend(f)
    assert {v: sorted(f) for v, f in have.items()} == {v: sorted(f) for v, f in want.items()}

    def spread(fold_of):
        h = np.zeros((4, 3))
        for g, f in fold_of.items():
            h[f] += count[g]
        return (h / total).std(axis=0).sum()

    plain = {x.g: x.fold for x in folds.stratified_group_kfold(df, "g", "y", 4).collect()}
    assert spread({g: min(f) for g, f in got.items()}) <= spread(plain)


def test_greedy_group_folds_of_many_equal_groups(spark):
    from ferrule.operators import folds
    df = spark.range(20000).select(F.col("id").alias("g"), (F.col("id") % 2).cast("int").alias("y"))
    got = folds.greedy_group_kfold(df, "g", "y", 3).groupBy("fold", "y").count().collect()
    assert len(got) == 6 and all(3300 < r["count"] < 3370 for r in got)
    assert folds.greedy_group_kfold(df.limit(0), "g", "y", 3).collect() == []


def test_mcar_reads_its_input_once(spark):
    """One aggregate over the rows; statistic and tail as from plain NumPy."""
    import numpy as np
    from ferrule.operators import quality, select
    r = np.random.default_rng(9)
    x = r.normal(size=(400, 3)) + [1e6, 0, 5]
    hole = r.random((400, 3)) < 0.1
    rows = [tuple(None if h else float(v) for v, h in zip(a, b)) for a, b in zip(x, hole)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {q["column"]: q for q in quality.little_mcar(df, ["a", "b", "c"]).collect()}
    for i, c in enumerate("abc"):
        o = [k for k in range(3) if k != i]
        kept = ~hole[:, o].any(axis=1)
        v, miss = x[kept][:, o], hole[kept][:, i]
        d = v[miss].mean(0) - v[~miss].mean(0)
        stat = miss.sum() * d @ np.linalg.pinv(np.cov(v.T)) @ d
        assert got[c]["n_missing"] == miss.sum() and abs(got[c]["statistic"] - stat) < 1e-6 * stat
        assert abs(got[c]["p_value"] - np.exp(-stat / 2)) < 1e-6 and abs(select.chi2_sf(stat, 2) - np.exp(-stat / 2)) < 1e-9


def test_stage_probe(spark):
    """Counts come from the one run of the pipeline."""
    from ferrule.operators import quality
    probe = quality.StageProbe()
    ran = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    a = probe.watch("all", spark.range(100).mapInArrow(once, "id long"))
    b = probe.watch("even", a.where("id % 2 = 0").withColumn("x", F.lit(1)))
    assert b.groupBy().sum("id").first()[0] == 2450
    assert [tuple(r) for r in probe.sizes(spark).collect()] == [("all", 100, 1), ("even", 50, 2)] and ran.value == 100


def test_confusion_of_many_labels(spark):
    """10,000 labels: scores come from the cells that occur, without the dense grid."""
    df = spark.range(30000).select((F.col("id") % 10000).alias("y_true"), F.when(F.col("id") < 20000, F.col("id") % 10000).otherwise(F.lit(3)).alias("y_pred"))
    s = metrics.classification_scores(df).first()
    assert s["accuracy"] == pytest.approx(20001 / 30000) and s["balanced_accuracy"] == pytest.approx(20001 / 30000)
    assert metrics.classification_report(df).count() == 10003


def test_null_keys_stay(spark):
    """NULL folds, labels and recordings are groups like any other."""
    p = spark.createDataFrame([(None, 1, 0, 0), (None, 1, 1, 0), (0, 2, 1, 1), (0, None, None, 1)], "fold int, g int, y_true int, y_pred int")
    assert {(r["fold"], r["g"]): r["fold_accuracy"] for r in metrics.group_scores(p, "fold", "g").collect()} == {(None, 1): 0.5, (0, 2): 1.0, (0, None): 1.0}
    cells = {(r["fold"], r["true"], r["pred"]): r["n"] for r in metrics.confusion(p, ["fold"]).collect()}
    assert len(cells) == 8 and cells[None, 1, 0] == 1 and cells[0, None, 1] == 1 and cells[0, None, None] == 0
    f = spark.createDataFrame([(None, 0, 0, 0.0, 0.0), (None, 0, 1, 3.0, 4.0), (1, 0, 0, 1.0, 1.0), (1, 0, 1, 1.0, 2.0)], "rec int, frame int, joint int, x double, y double")
    assert {r["rec"]: r["mean_distance"] for r in sequence.pair_distance(f, ["rec"], 0, 1).collect()} == {None: 5.0, 1: 1.0}
    parts = spark.createDataFrame([("p", "l", 0), ("p", "l", 1)], "part string, side string, joint int")
    assert {r["rec"]: r["median"] for r in sequence.part_stats(f.withColumn("step", F.col("x")), parts, ["rec"], "step").collect()} == {None: 3.0, 1: 2.0}


def test_flatten_and_side_by_side(spark):
    from ferrule.operators.ordering import side_by_side
    f = spark.createDataFrame([("a", i, float(i), None if i == 1 else 10.0 * i) for i in (0, 1, 2, 4)] + [(None, 0, 7.0, 8.0), ("a", None, 1.0, 1.0)], "k string, frame int, x double, y double")
    got = {(r["k"], r["piece"]): tuple(r)[2:] for r in sequence.flatten_frames(f, ["k"], ["x", "y"], 3, fill=-1.0).collect()}
    assert got == {("a", 0): (3, 0.0, 0.0, 1.0, -1.0, 2.0, 20.0), ("a", 1): (1, -1.0, -1.0, 4.0, 40.0, -1.0, -1.0), (None, 0): (1, 7.0, 8.0, -1.0, -1.0, -1.0, -1.0)}
    a, b = spark.createDataFrame([(3,), (1,), (2,)], "u int"), spark.createDataFrame([("z",), ("x",)], "v string")
    assert sorted(map(tuple, side_by_side(a, b, ["u"], ["v"]).select("pos", "u", "v").collect())) == [(0, 1, "x"), (1, 2, "z"), (2, 3, None)]


def test_quantiles_rank_a_small_share_of_the_values(spark, monkeypatch):
    """Values between the sketch's brackets are only counted; ties, gaps, infinities, NaN and NULL included."""
    rng = np.random.default_rng(5)
    a, b = rng.lognormal(size=60_000), rng.integers(0, 7, 60_000).astype(float)
    a[:50], b[50:90] = np.nan, np.inf
    df = spark.createDataFrame([(float(x), None if i % 9 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))], "a double, b double")
    ranked, whole = [], quantile.histogram_ranks
    monkeypatch.setattr(quantile, "histogram_ranks", lambda hist, *r: ranked.append(hist.count()) or whole(hist, *r))
    probs = [0.0, 0.1, 0.1001, 0.5, 0.9, 1.0]
    keep = b[np.arange(60_000) % 9 != 0]
    want = {("a", p): np.quantile(a[50:], p) for p in probs} | {("b", p): np.quantile(keep, p, method="lower") for p in probs}
    got = {(r["column"], r["prob"]): r["quantile"] for r in quantile.quantiles(df, ["a", "b"], probs, accuracy=500, least_rows=1000).collect()}
    assert got.keys() == want.keys() and sum(ranked) < 6000
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want if k != ("b", 1.0))


def test_quantiles_where_the_sketch_misses(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 3).cast("double").alias("x"))
    monkeypatch.setattr(quantile, "_brackets", lambda *a: {"c0": [(30.0, 60.0), (9000.0, 9003.0)]})
    got = [r["quantile"] for r in quantile.quantiles(df, ["x"], [0.25, 0.5]).orderBy("prob").collect()]
    assert got == pytest.approx([3 * 0.25 * 4999, 3 * 0.5 * 4999])


def test_centre_and_scale_works_out_each_part_once(spark):
    df = spark.createDataFrame([(1, [float(i * i % 7) for i in range(64)])], "id int, features array<double>")
    n = df.select(pose.centre_and_scale("features", 16).alias("n"))
    assert n._jdf.queryExecution().optimizedPlan().toString().count("array_sort") == 2
    x = np.array([i * i % 7 for i in range(64)], float)
    cx, cy = np.median(x[0:32:2]), np.median(x[1:32:2])
    s = np.hypot(x[0:32:2] - cx, x[1:32:2] - cy).mean()
    want = np.concatenate(((x[:32].reshape(16, 2) - [cx, cy]).ravel(), x[32:])) / s
    row = n.first()["n"]
    assert row["features"] == pytest.approx(want.tolist()) and (row["cx"], row["cy"], row["scale"]) == pytest.approx((cx, cy, s))


def test_recordings_are_read_from_saved_rows(spark, sf_dir):
    """Fits read the features again and again: the events and their features are not behind them."""
    from ferrule.plans import selection
    rows = selection._recordings(spark, sf_dir)
    assert rows.inputFiles() and not [f for f in rows.inputFiles() if "events" in f]


def test_cross_fit_deals_rows_out(spark, monkeypatch):
    from ferrule.operators import crossfit
    monkeypatch.setattr(crossfit, "FIT_ROWS", 100)
    seen = []

    class Fake:
        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return self

        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0))

    df = spark.range(600).coalesce(1).select((F.col("id") % 2).cast("int").alias("fold"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("label"))
    out = crossfit.cross_fit_classifier(df, ["x"], "label", "fold", 2, Fake())
    assert seen == [6, 6] and out.count() == 600
