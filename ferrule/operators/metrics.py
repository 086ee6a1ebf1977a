"""Metrics, reports and leaderboards from a long prediction table.

Prediction store: ``(keys..., y_true, y_pred[, weight])`` where the keys are
e.g. ``model, fold, set``.  Every metric is a grouped aggregate over it
(map-side combined); confusion tables are (class x class) per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import div_or
from ..storage import save
from .ordering import attach_group
from .quantile import histogram_ranks, read_quantiles, trimmed_mean_long, value_ranks

EPS = 2.220446049250313e-16  # float64 machine epsilon (MAPE denominator floor)


def regression_scores(preds: DataFrame, keys: Sequence[str], y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """M1/M3/M4/M5: MSE, RMSE, MAPE (|y| floored at eps), R², sMAPE (percent) and
    signed sMAPE per group, one aggregate.  The total sum of squares comes from the
    running variance (no large sums cancel); a row with y = p = 0 has sMAPE 0."""
    e = F.col(p) - F.col(y)
    scale = F.abs(F.col(y)) + F.abs(F.col(p))
    agg = preds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPS))).alias("mape"),
        F.var_pop(y).alias("_var"),
        (F.avg(div_or(2 * F.abs(e), scale)) * 100).alias("smape"),
        F.try_divide(F.sum(e), F.sum(scale)).alias("signed_smape"))
    return agg.select(*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mape",
                      (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"), "smape", "signed_smape")


def winsorized_mape(preds: DataFrame, keys: Sequence[str], q: float = 0.95,
                    y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """M2: relative errors capped at their q-quantile (exact, per group), then averaged.
    Both come from one histogram of the errors; a NULL key is a group."""
    keys = list(keys)
    err = preds.select(*keys, (F.abs(F.col(p) - F.col(y)) / F.greatest(F.abs(y), F.lit(EPS))).alias("value"))
    ranks = save(value_ranks(err.where("value IS NOT NULL"), keys), "error-ranks")
    thr = read_quantiles(ranks, keys, [q]).select(*keys, F.col("quantile").alias("_thr"))
    return attach_group(ranks, thr, keys).groupBy(*keys).agg(
        (F.sum(F.least(F.col("value"), F.col("_thr")) * F.col("cnt")) / F.sum("cnt")).alias("wmape"))


def confusion_cells(preds: DataFrame, keys: Sequence[str] = (), y: str = "y_true", p: str = "y_pred", weight: str | None = None) -> DataFrame:
    """(keys, true, pred, n): the cells that occur, one aggregate."""
    w = F.col(weight) if weight else F.lit(1)
    return preds.groupBy(*keys, F.col(y).alias("true"), F.col(p).alias("pred")).agg(F.sum(w).alias("n"))


def confusion(preds: DataFrame, keys: Sequence[str] = (), y: str = "y_true", p: str = "y_pred",
              weight: str | None = None) -> DataFrame:
    """M7: (keys, true, pred, n), zero-filled over the labels that the group itself holds,
    true or predicted.  The result has a row per pair of labels; the counts are joined to it
    null-safe, so a NULL key or label is one like any other."""
    keys = list(keys)
    cells = save(confusion_cells(preds, keys, y, p, weight), "confusion-cells")
    labels = cells.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array("true", "pred"))))).alias("_ls"))
    grid = labels.select(*keys, F.explode("_ls").alias("true"), "_ls").select(*keys, "true", F.explode("_ls").alias("pred"))
    return attach_group(grid, cells, [*keys, "true", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def per_class(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per class of the group precision, recall, F1 (zero division -> 0) and support,
    from one pass over the confusion cells that occur."""
    keys, kind = list(keys), cells.schema["n"].dataType
    zero = F.lit(0).cast(kind)
    both = cells.select(*keys, F.explode(F.array(
        F.struct(F.col("true").alias("label"), F.col("n").alias("s"), zero.alias("p"), F.when(F.col("true").eqNullSafe(F.col("pred")), F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("pred").alias("label"), zero.alias("s"), F.col("n").alias("p"), zero.alias("tp")))).alias("c")).select(*keys, "c.*")
    t = both.groupBy(*keys, "label").agg(F.sum("tp").alias("tp"), F.sum("s").alias("support"), F.sum("p").alias("predicted"))
    prec, rec = div_or("tp", "predicted"), div_or("tp", "support")
    t = t.select(*keys, "label", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    return t.withColumn("f1", div_or(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def classification_report(preds: DataFrame, keys: Sequence[str] = (), y: str = "y_true", p: str = "y_pred",
                          weight: str | None = None) -> DataFrame:
    """M8: per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows:
    ``(keys, row, precision, recall, f1, support)``."""
    keys = list(keys)
    pc = save(per_class(confusion_cells(preds, keys, y, p, weight), keys), "class-scores")
    cls = pc.select(*keys, F.col("label").cast("string").alias("row"), "precision", "recall", "f1",
                    F.col("support").cast("double").alias("support"))
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    tot = pc.groupBy(*keys).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum("support").alias("s"), weighted("precision").alias("wp"), weighted("recall").alias("wr"),
        weighted("f1").alias("wf"), F.try_divide(F.sum("tp"), F.sum("support")).alias("acc"))
    rows = F.explode(F.array(
        F.struct(F.lit("accuracy").alias("row"), F.col("acc").alias("precision"), F.col("acc").alias("recall"),
                 F.col("acc").alias("f1"), F.col("s").cast("double").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("s").cast("double").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("s").cast("double").alias("support"))))
    summary = tot.select(*keys, rows.alias("r")).select(*keys, "r.*")
    return cls.unionByName(summary)


def classification_scores(preds: DataFrame, keys: Sequence[str] = (), y: str = "y_true", p: str = "y_pred",
                          weight: str | None = None) -> DataFrame:
    """Accuracy, macro precision/recall/F1, balanced accuracy (mean recall over
    the classes that occur) and the macro-F1 loss 1 - F1 per group (weights replace
    counts when given)."""
    keys = list(keys)
    pc = per_class(confusion_cells(preds, keys, y, p, weight), keys)
    return pc.groupBy(*keys).agg(
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"), F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        (1 - F.avg("f1")).alias("f1_loss"))


def roc_auc(preds: DataFrame, keys: Sequence[str] = (), y: str = "y_true", score: str = "score") -> DataFrame:
    """Exact ROC AUC by the rank-sum formula with average ranks for ties, from
    the distributed rank table (no single sorted pass)."""
    keys = list(keys)
    long = preds.select(*keys, F.col(score).cast("double").alias("value"), F.col(y).cast("int").alias("_y"))
    long = long.where("value IS NOT NULL AND _y IS NOT NULL")
    hist = save(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("cnt"), F.sum("_y").alias("_pos")), "score-histogram")
    r = attach_group(histogram_ranks(hist, keys), hist.select(*keys, "value", "_pos"), [*keys, "value"])
    avg_rank = F.col("cum_before") + (F.col("cnt") + 1) / 2.0
    agg = r.groupBy(*keys).agg(F.sum(avg_rank * F.col("_pos")).alias("_rs"), F.sum("_pos").alias("_np"),
                               F.first("n").alias("_n"))
    npos, nneg = F.col("_np"), F.col("_n") - F.col("_np")
    return agg.select(*keys, F.try_divide(F.col("_rs") - npos * (npos + 1) / 2, npos * nneg).alias("roc_auc"))


def fold_summary(scores: DataFrame, keys: Sequence[str], value: str, fold: str = "fold") -> DataFrame:
    """Mean, std (ddof 0), max and min over folds."""
    return scores.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"),
                                     F.max(value).alias("max"), F.min(value).alias("min"),
                                     F.count_distinct(fold).alias("n_folds"))


def fold_average_report(reports: DataFrame, keys: Sequence[str] = ("row",)) -> DataFrame:
    """Mean and std (ddof 0) of precision/recall/F1 per report row over folds."""
    return reports.groupBy(*keys).agg(
        *[f(c).alias(f"{c}_{n}") for c in ("precision", "recall", "f1")
          for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def group_scores(preds: DataFrame, fold: str, group: str, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Accuracy of every held-out fold with the groups it holds, long form
    ``(fold, group, fold_accuracy)``, best fold first (O6)."""
    acc = preds.groupBy(fold).agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("fold_accuracy"))
    groups = preds.select(fold, group).distinct()
    return attach_group(groups, acc, [fold]).orderBy(F.desc("fold_accuracy"), fold, group)


def overfit_table(scores: DataFrame, keys: Sequence[str], metric: str = "metric", model: str = "model",
                  set_col: str = "set", value: str = "score", train: str = "train", val: str = "val",
                  trim: float = 0.1) -> DataFrame:
    """Per model and metric the train - validation gap of the fold-mean scores
    (pivot on set), then its 10 % trimmed mean over models."""
    keys = list(keys)
    piv = scores.groupBy(*keys, metric, model).pivot(set_col, [train, val]).agg(F.avg(value))
    gaps = piv.select(*keys, metric, model, (F.col(train) - F.col(val)).alias("value"))
    return trimmed_mean_long(gaps, [*keys, metric], trim, out="trimmed_gap")


def candidate_leaderboard(cands: DataFrame, split_cols: Sequence[str], key: Sequence[str]) -> DataFrame:
    """L1: mean and std (ddof 0) of the split scores and the rank (min method,
    descending).  The rank runs over the candidate table (one row per grid point,
    bounded by the grid the user declares), not over data rows."""
    arr = F.array(*[F.col(c) for c in split_cols])
    n = float(len(split_cols))
    mean = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / n
    t = cands.select(*key, *split_cols, mean.alias("mean_test_score"))
    var = F.aggregate(F.array(*[F.col(c) for c in split_cols]), F.lit(0.0),
                      lambda a, x: a + (x - F.col("mean_test_score")) * (x - F.col("mean_test_score"))) / n
    t = t.withColumn("std_test_score", F.sqrt(var))
    return t.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.desc("mean_test_score"))))


def train_cv_gap(cands: DataFrame, train_cols: Sequence[str], test_cols: Sequence[str],
                 key: Sequence[str]) -> DataFrame:
    """L2: row means of the train and test split scores and their difference."""
    mean = lambda cs: F.aggregate(F.array(*[F.col(c) for c in cs]), F.lit(0.0), lambda a, x: a + x) / float(len(cs))
    return cands.select(*key, mean(train_cols).alias("mean_train"), mean(test_cols).alias("mean_test"),
                        (mean(train_cols) - mean(test_cols)).alias("gap"))


def score_curve(scores: DataFrame, param: str, value: str, model: str | None = None, model_col: str = "model",
                by: Sequence[str] = ()) -> DataFrame:
    """L3/L4: mean score against a parameter, per model and remaining hyper-parameters
    ``by``, sorted by them.  An unknown ``model`` raises."""
    if model is not None:
        if not scores.where(F.col(model_col) == model).limit(1).count():
            raise ValueError(f"unknown model {model}")
        scores = scores.where(F.col(model_col) == model)
    keys = [model_col, *by, param]
    return scores.groupBy(*keys).agg(F.avg(value).alias("mean_score"), F.count(F.lit(1)).alias("n_scores")).orderBy(*keys)


def best_per_group(df: DataFrame, group: Sequence[str], order_desc: str, tie: Sequence[str], k: int = 1, name: str = "rank") -> DataFrame:
    """Best k rows per group by a descending score, ties by the ``tie`` columns
    (``row_number`` with a limit, planned with a partial per-task limit before the shuffle)."""
    w = Window.partitionBy(*group).orderBy(F.desc(order_desc), *tie)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
