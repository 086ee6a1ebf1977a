"""Splits and validation folds (V1-V10) as columns.

Folds are reproducible outside Spark: the row order is a portable md5 hash of
the id (``functions.columns.portable_hash``), ties broken by the id.  All
numbering goes through ``ordering.number_rows`` so a large class or group never
lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import portable_hash
from ..storage import save
from .ordering import attach_group, number_rows


def _hashed(df: DataFrame, id_col: str, seed) -> DataFrame:
    return df.withColumn("_h", portable_hash(id_col, seed))


def _contiguous_fold(rn, n, k: int):
    """KFold sizes: the first n % k folds get n // k + 1 rows, the rest n // k."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(rn < big, F.floor(rn / (q + 1))).otherwise(r + F.floor((rn - big) / q)).cast("int")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed=42, name: str = "fold") -> DataFrame:
    """V1 shuffled k-fold: hash order, contiguous folds of KFold sizes."""
    t = number_rows(_hashed(df, id_col, seed), [], ["_h", id_col], "_rn", total="_n")
    return t.withColumn(name, _contiguous_fold(F.col("_rn"), F.col("_n"), k)).drop("_h", "_rn", "_n")


def train_test_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed=42,
                     stratify: str | None = None, name: str = "set") -> DataFrame:
    """V2: the first ceil(f * n) rows in hash order (per stratum) are 'test'."""
    by = [stratify] if stratify else []
    t = number_rows(_hashed(df, id_col, seed), by, ["_h", id_col], "_rn", total="_n")
    test = F.col("_rn") < F.ceil(F.col("_n") * F.lit(float(test_fraction)))
    return t.withColumn(name, F.when(test, "test").otherwise("train")).drop("_h", "_rn", "_n")


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed=42,
                     name: str = "fold") -> DataFrame:
    """V3: position within class (hash order) modulo k."""
    t = number_rows(_hashed(df, id_col, seed), [label], ["_h", id_col], "_rn")
    return t.withColumn(name, (F.col("_rn") % k).cast("int")).drop("_h", "_rn")


def majority_label(df: DataFrame, group: str, label: str, name: str = "group_label") -> DataFrame:
    """Most frequent label per group, ties to the smallest label.  The
    count table is (group x label), built with map-side combine."""
    counts = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(group).agg(
        F.min_by(F.col(label), F.struct(-F.col("_c"), F.col(label))).alias(name))


def strict_group_folds(df: DataFrame, group: str, label: str, k: int = 5, seed=42,
                       name: str = "fold") -> DataFrame:
    """V5: every group takes its majority label; groups of each class are dealt
    to folds round-robin in hash order.  Raises when a class has fewer than k
    groups.  Returns the rows with the fold of their group."""
    g = majority_label(df, group, label, "_gl")
    g = number_rows(_hashed(g, group, seed), ["_gl"], ["_h", group], "_rn", total="_ng")
    g = g.select(group,
                 F.when(F.col("_ng") < k, F.raise_error(F.concat(
                     F.lit("class "), F.col("_gl").cast("string"),
                     F.lit(" has fewer groups than folds"))))
                  .otherwise((F.col("_rn") % k).cast("int")).alias(name))
    return attach_group(df, g, [group])


def stratified_group_kfold(df: DataFrame, group: str, label: str, k: int = 5, seed=42,
                           name: str = "fold") -> DataFrame:
    """V4 without a sequential part (``greedy_group_kfold`` balances better): groups keep their majority class; within a class,
    groups sorted by size (largest first, hash tie-break) are dealt round-robin,
    which balances class counts and fold sizes.  No group is on both sides."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    g = attach_group(majority_label(df, group, label, "_gl"), sizes, [group])
    g = _hashed(g, group, seed).withColumn("_neg", -F.col("_size"))
    g = number_rows(g, ["_gl"], ["_neg", "_h", group], "_rn")
    g = g.select(group, (F.col("_rn") % k).cast("int").alias(name))
    return attach_group(df, g, [group])


def _deal(k: int, totals: list[float]):
    """Distinct class-count vectors, widest spread first, with how many groups have each, to the
    number of groups that each fold gets (cumulated).  Every group goes to the fold that leaves
    the least sum over classes of the deviation of the folds' shares, among equals to the
    smallest, then the first.  Of very many equal groups several go at a time (a 64th of those
    left per fold), so a vector takes some 64 k log(m) steps."""
    total = np.array(totals, float)

    def run(batches):
        held, size = np.zeros((k, len(total))), np.zeros(k)
        for b in batches:
            out = []
            for vec, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.array(vec, float)
                on = np.flatnonzero(v)
                got, left = np.zeros(k, np.int64), m
                while left:
                    unit = max(1, left // (64 * k))
                    share = np.repeat((held[:, on] / total[on])[None], k, axis=0)
                    share[np.arange(k), np.arange(k)] += unit * v[on] / total[on]
                    cost = np.round(share.std(axis=1).sum(axis=1), 12)
                    f = min(range(k), key=lambda i: (cost[i], size[i], i))
                    held[f] += unit * v
                    size[f] += unit * v.sum()
                    got[f] += unit
                    left -= unit
                out.append(np.cumsum(got).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], names=["_v", "_upto"])

    return run


def greedy_group_kfold(df: DataFrame, group: str, label: str, k: int = 5, seed=42, name: str = "fold") -> DataFrame:
    """V4 greedy: no group on two sides, folds balanced in every class.  Groups with the widest
    spread of class counts are placed first (see ``_deal``); groups with the same counts share
    one row of a table of distinct vectors, and are told apart by hash order.  A NULL group or
    label is one like any other.  Returns the rows with the fold of their group."""
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(label).asc_nulls_first()).collect()
    counts = [F.count_if(F.col(label).eqNullSafe(F.lit(r[0]).cast(df.schema[label].dataType))) for r in classes]
    g = _hashed(df.groupBy(group).agg(F.array(*counts).cast("array<bigint>").alias("_v")), group, seed)
    g = number_rows(g, ["_v"], ["_h", group], "_rn", total="_m")
    one = F.aggregate("_v", F.lit(0).cast("long"), lambda s, x: s + x)
    square = F.aggregate("_v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    vectors = g.groupBy("_v").agg(F.first("_m").alias("_m")).withColumn("_s", square * len(classes) - one * one)
    dealt = vectors.orderBy(F.desc("_s"), "_v").select("_v", "_m").coalesce(1).mapInArrow(_deal(k, [r["n"] for r in classes]), "_v array<long>, _upto array<long>")
    g = attach_group(g, save(dealt, "fold-vectors"), ["_v"])
    fold = F.size(F.filter("_upto", lambda u: u <= F.col("_rn")))
    return attach_group(df, g.select(group, fold.cast("int").alias(name)), [group])


def leave_one_group_out(df: DataFrame, group: str, name: str = "fold") -> DataFrame:
    """V6: fold = 0-based rank of the group id (k = number of groups)."""
    g = number_rows(df.select(group).distinct(), [], [group], name)
    g = g.select(group, F.col(name).cast("int").alias(name))
    return attach_group(df, g, [group])


def nested_group_folds(df: DataFrame, group: str, label: str, k_outer: int, k_inner: int,
                       seed=42) -> DataFrame:
    """V7: strict outer folds, and for every outer fold strict inner folds over the
    groups of its training part.  Returns ``(outer_fold, group, inner_fold)``."""
    g = majority_label(df, group, label, "_gl")
    g = number_rows(_hashed(g, group, seed), ["_gl"], ["_h", group], "_rn")
    g = g.withColumn("outer_fold", (F.col("_rn") % k_outer).cast("int"))
    outer = g.select(F.explode(F.sequence(F.lit(0), F.lit(k_outer - 1))).alias("_o"), group,
                     "_gl", "_h", "outer_fold").where(F.col("_o") != F.col("outer_fold"))
    inner = number_rows(outer, ["_o", "_gl"], ["_h", group], "_ri")
    return inner.select(F.col("_o").cast("int").alias("outer_fold"), group,
                        (F.col("_ri") % k_inner).cast("int").alias("inner_fold"))


def fold_audit(df: DataFrame, fold: str, group: str, label: str, k: int) -> DataFrame:
    """V8: per fold and side (train/test): number of rows, groups and rows per class.

    Rows are counted once into (fold, group, label) cells; the train side is the total
    less the fold (a group counts there unless all its rows of the class lie in the fold)."""
    cells = save(df.groupBy(F.col(fold).alias("fold"), group, label).agg(F.count(F.lit(1)).alias("c")), "fold-cells")
    own = Window.partitionBy(group, label)
    cells = cells.withColumn("only", F.count(F.lit(1)).over(own) == 1)
    test = cells.groupBy(F.col("fold").cast("int").alias("fold"), label).agg(
        F.sum("c").alias("rows"), F.count(F.lit(1)).alias("groups"), F.count_if("only").alias("only"))
    total = cells.groupBy(label).agg(F.sum("c").alias("all_rows"), F.count_distinct(F.struct(group)).alias("all_groups"))
    grid = total.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"), label, "all_rows", "all_groups")
    t = test.select(F.col("fold").alias("_f"), F.col(label).alias("_l"), "rows", "groups", "only")
    x = grid.join(t, (F.col("fold") == F.col("_f")) & F.col(label).eqNullSafe(F.col("_l")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    sides = F.explode(F.array(
        F.struct(F.lit("test").alias("side"), zero("rows").alias("n_rows"), zero("groups").alias("n_groups")),
        F.struct(F.lit("train").alias("side"), (F.col("all_rows") - zero("rows")).alias("n_rows"),
                 (F.col("all_groups") - zero("only")).alias("n_groups"))))
    return x.select("fold", label, sides.alias("s")).select("fold", "s.side", label, "s.n_rows", "s.n_groups").where("n_rows > 0")


def balanced_class_weights(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """N / (k * n_c) per class, as a small table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()
    return counts.select(label, "n_c", (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c")))
                         .alias(name))


def nested_samples(df: DataFrame, id_col: str, sizes: Sequence[int], seed=42) -> DataFrame:
    """V9: samples of the given sizes, nested: the first ``size`` rows in hash order, one copy
    of a row per size that holds it (at most the largest size rows are copied)."""
    t = number_rows(_hashed(df, id_col, seed), [], ["_h", id_col], "_rn")
    t = t.where(F.col("_rn") < max(sizes))
    return t.select("*", F.explode(F.filter(F.array(*[F.lit(int(s)) for s in sizes]), lambda s: s > F.col("_rn"))).alias("size")).drop("_h", "_rn")


def learning_curve(scores: DataFrame, size: str, param: str, score: str,
                   target_size: float) -> DataFrame:
    """V9: best parameter per training size (highest score, smallest parameter on
    ties), a least-squares line param ~ size, and its value at ``target_size``."""
    best = scores.groupBy(size).agg(
        F.min_by(F.col(param), F.struct(-F.col(score), F.col(param))).alias("best_param"))
    return best.agg(F.regr_slope("best_param", size).alias("slope"),
                    F.regr_intercept("best_param", size).alias("intercept"),
                    (F.regr_intercept("best_param", size) + F.regr_slope("best_param", size)
                     * F.lit(float(target_size))).alias("extrapolated"))
