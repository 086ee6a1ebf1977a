"""Missingness tests, imputation checks and stage probes.

D1 needs a p x p (pseudo-)inverse: the moments come from one distributed
aggregate, the algebra is p x p on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import portable_hash
from ..storage import save
from .models import _merge, fold_moments
from .ordering import attach_group, number_rows
from .quantile import quantiles_long, to_long
from .select import chi2_sf


def little_mcar(df: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """D1 per column c: rows whose *other* columns are complete; d = mean(others |
    c missing) - mean(others | c present); S = n_miss * d' pinv(Sigma) d with Sigma the
    sample covariance (ddof 1) of the others over the kept rows; p = chi2 tail with
    p' = #others degrees of freedom.  NULL result when one side is empty.

    One scan: only rows without a hole or with one matter, so the moments are grouped by
    which column is missing (#columns + 1 groups) and merged per tested column."""
    cols, p = list(cols), len(cols)
    gaps = [F.col(c).isNull().cast("int") for c in cols]
    missing = sum(gaps[1:], gaps[0])
    which = F.coalesce(*[F.when(g == 1, F.lit(i)) for i, g in enumerate(gaps)], F.lit(-1))
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], missing.alias("_m"), which.alias("_w")).where("_m <= 1")
    parts = fold_moments(rows, [f"x{i}" for i in range(p)], "_w")
    out = []
    for i, c in enumerate(cols):
        others = [k for k in range(p) if k != i]
        own = [(n, mean[others].astype(float), m2[np.ix_(others, others)]) for n, mean, m2 in (parts[k] for k in (i, -1) if k in parts)]
        if not others or len(own) < 2:
            out.append((c, int(parts[i][0]) if i in parts else 0, None, None, None))
            continue
        d = own[0][1] - own[1][1]
        n, _, m2 = _merge(own)
        stat = float(own[0][0] * d @ np.linalg.pinv(m2 / (n - 1)) @ d)
        pval = chi2_sf(stat, len(others))
        out.append((c, int(own[0][0]), stat, pval, pval >= alpha))
    return df.sparkSession.createDataFrame(out, "column string, n_missing long, statistic double, p_value double, mcar boolean")


def fill_constant(df: DataFrame, value: float = 0.0, cols: Sequence[str] | None = None) -> DataFrame:
    """Constant fill of NULLs."""
    return df.fillna(value, subset=list(cols) if cols else None)


def evaluate_imputer(df: DataFrame, id_col: str, cols: Sequence[str], strategy: str = "mean",
                     sample_frac: float = 0.1, repeats: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """D3: for every column and repeat, hide floor(frac * n_known) known values (the
    first in a seeded hash order), impute them from the remaining values with the
    mean / median / mode, and score RMSE, or accuracy for ``mode`` (columns of any
    type, compared as text).  The repeats are a key of one numbering; scores are
    averaged over repeats."""
    if strategy not in ("mean", "median", "mode"):
        raise ValueError(strategy)
    if strategy == "mode":
        long = df.select(id_col, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
            [id_col], list(cols), "column", "value").where("value IS NOT NULL")
    else:
        long = to_long(df, cols, [id_col])
    seeds = F.explode(F.array(*[F.struct(F.lit(int(s)).alias("repeat"), portable_hash(F.col(id_col), f"imp{s}").alias("_h")) for s in repeats]))
    long = long.select(id_col, "column", "value", seeds.alias("s")).select(id_col, "column", "value", "s.*")
    keys = ["column", "repeat"]
    long = number_rows(long, keys, ["_h", id_col], "_rn", total="_n")
    long = save(long.withColumn("_masked", F.col("_rn") < F.floor(F.col("_n") * F.lit(float(sample_frac)))), "masked")
    known = long.where(~F.col("_masked"))
    if strategy == "mean":
        fill = known.groupBy(*keys).agg(F.avg("value").alias("_fill"))
    elif strategy == "median":
        fill = quantiles_long(known, keys, [0.5]).select(*keys, F.col("quantile").alias("_fill"))
    else:  # most frequent, ties to the smallest
        counts = known.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c"))
        fill = counts.groupBy(*keys).agg(F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("_fill"))
    masked = attach_group(long.where("_masked"), fill, keys)
    if strategy == "mode":
        score = F.avg((F.col("value") == F.col("_fill")).cast("double"))
    else:
        score = F.sqrt(F.avg((F.col("value") - F.col("_fill")) * (F.col("value") - F.col("_fill"))))
    per = masked.groupBy(*keys).agg(score.alias("score"), F.count(F.lit(1)).alias("n_masked"))
    return per.groupBy("column").agg(F.avg("score").alias("score"), F.avg("n_masked").alias("n_masked"))


def stage_sizes(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows and feature count per pipeline stage (one count per stage)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_features")) for name, df in stages]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class StageProbe:
    """D8 while the pipeline runs: ``watch`` marks a stage, and once a result of the pipeline has
    been computed ``sizes`` tells how many rows passed each.  Nothing is computed for it: the
    rows are counted as they go by (one observation per stage).  A failed task's rows don't
    count; a stage that Spark computes again after a lost shuffle counts again."""

    def __init__(self):
        self.stages: list[tuple[str, Observation, int]] = []

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"stage-{len(self.stages)}-{name}")
        self.stages.append((name, seen, len(df.columns)))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def sizes(self, spark: SparkSession) -> DataFrame:
        rows = [(name, int(seen.get["n_rows"]), n) for name, seen, n in self.stages]
        return spark.createDataFrame(rows, "stage string, n_rows long, n_features int")
