"""Column profiling, outlier fences and histograms.

Statistics are computed for all columns in one aggregate (one scan) and
returned in long form ``(column, ...)``; quantiles come from the distributed
exact rank table in ``quantile``.  Per-column scalars are attached to the rows
with a join on a constant key against a table of one row per column set,
which is of bounded size (one row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..storage import save
from .ordering import attach_group
from .quantile import histogram_ranks, quantile_wide, read_quantiles, to_long, trimmed_mean_long

# Fence multipliers swept by the outlier report, in order.
IQR_MULTIPLIERS = [1.5, 2, 3, 4, 5, 6, 7, 8, 9, 10.0, 100.0, 1000.0, 10000.0]


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row (broadcast of one row)."""
    return df.withColumn("_one", F.lit(1)).join(
        F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one")


def _wide_bounds(df: DataFrame, cols: Sequence[str], multiplier: float) -> DataFrame:
    """One row: ``<c>__lo, <c>__hi`` fences for every column."""
    q = quantile_wide(df, cols, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    b = q.select("column", (F.col("q1") - multiplier * iqr).alias("lo"),
                 (F.col("q3") + multiplier * iqr).alias("hi"))
    return b.agg(*[F.max(F.when(F.col("column") == c, F.col(k))).alias(f"{c}__{k}")
                   for c in cols for k in ("lo", "hi")])


def iqr_bounds(df: DataFrame, cols: Sequence[str], multiplier: float = 3.0) -> DataFrame:
    """``(column, q1, q3, iqr, lower, upper)``."""
    q = quantile_wide(df, cols, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select("column", "q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - multiplier * iqr).alias("lower"),
                    (F.col("q3") + multiplier * iqr).alias("upper"))


def _inside(cols: Sequence[str], multiplier_col=None):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.coalesce((F.col(c) >= F.col(f"{c}__lo")) & (F.col(c) <= F.col(f"{c}__hi")),
                                 F.lit(False))
    return cond


def iqr_flag(df: DataFrame, cols: Sequence[str], multiplier: float = 3.0,
             name: str = "inlier") -> DataFrame:
    """``inlier`` is true when every column lies inside [Q1 - m IQR, Q3 + m IQR];
    a NULL counts as outside."""
    b = _wide_bounds(df, cols, multiplier)
    t = attach_row(df, b)
    return t.withColumn(name, _inside(cols)).drop(*[f"{c}__{k}" for c in cols for k in ("lo", "hi")])


def iqr_split(df: DataFrame, cols: Sequence[str], multiplier: float = 3.0):
    """(inliers, outliers) -- two DataFrames over the same flagged plan."""
    flagged = iqr_flag(df, cols, multiplier)
    return (flagged.where("inlier").drop("inlier"), flagged.where(~F.col("inlier")).drop("inlier"))


def iqr_sweep(df: DataFrame, cols: Sequence[str],
              multipliers: Sequence[float] = tuple(IQR_MULTIPLIERS)) -> DataFrame:
    """Number of outlier rows for every (ascending) multiplier in one pass: the fences
    are nested, so a row is described by the number of multipliers that leave it out;
    one aggregate counts rows by that number and sums over its few rows follow."""
    ms = [float(m) for m in multipliers]
    if ms != sorted(ms):
        raise ValueError("multipliers must ascend")
    q = quantile_wide(df, cols, {"q1": 0.25, "q3": 0.75}).agg(
        *[F.max(F.when(F.col("column") == c, F.col(k))).alias(f"{c}__{k}") for c in cols for k in ("q1", "q3")])
    t = attach_row(df.select(*cols), q)
    left_out = None  # the first multiplier that keeps the row; most rows stop at the first test
    for i, m in enumerate(ms):
        inside = F.lit(True)
        for c in cols:
            iqr = F.col(f"{c}__q3") - F.col(f"{c}__q1")
            inside = inside & F.coalesce((F.col(c) >= F.col(f"{c}__q1") - m * iqr)
                                         & (F.col(c) <= F.col(f"{c}__q3") + m * iqr), F.lit(False))
        left_out = F.when(inside, i) if left_out is None else left_out.when(inside, i)
    left_out = left_out.otherwise(len(ms))
    counts = t.groupBy(left_out.alias("k")).agg(F.count(F.lit(1)).alias("c"))
    each = F.array(*[F.struct(F.lit(m).alias("multiplier"), F.sum(F.when(F.col("k") > i, F.col("c")).otherwise(0)).alias("n_outliers"))
                     for i, m in enumerate(ms)])
    row = counts.agg(each.alias("a"), F.sum("c").alias("n"))
    return row.select(F.explode("a").alias("s"), "n").select("s.multiplier", "s.n_outliers", F.try_divide("s.n_outliers", "n").alias("share"))


def spread_ratio(df: DataFrame, cols: Sequence[str], tail: float = 0.05) -> DataFrame:
    """A5: std (ddof 1) / (q(1 - tail) - q(tail)) per column."""
    q = quantile_wide(df, cols, {"lo": tail, "hi": 1 - tail})
    std = to_long(df, cols).groupBy("column").agg(F.stddev_samp("value").alias("std"))
    return q.join(std, "column").select(
        "column", F.try_divide(F.col("std"), F.col("hi") - F.col("lo")).alias("spread_ratio"))


def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, count, mean, std, min, max)`` from one aggregate over all columns; NaN is
    missing."""
    df = nan_to_null(df, cols)
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    row = df.agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
        F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in cols]))
    return row.select(stacked.alias("s")).select("s.*")


def coefficient_of_variation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Std (ddof 1) / |mean| per column (sort by ``cv`` for the report)."""
    m = column_moments(df, cols)
    return m.select("column", F.try_divide(F.col("std"), F.abs("mean")).alias("cv"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, 25 %, 50 %, 75 %, max per column (pandas ``describe``)."""
    q = quantile_wide(df, cols, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return column_moments(df, cols).join(q, "column", "left")


def missing_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, n_missing, missing_rate)``."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot(["_n"], list(cols), "column", "n_missing").select(
        "column", "n_missing", (F.col("n_missing") / F.col("_n")).alias("missing_rate"))


def missing_mask(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A16 cell mask: 1 where the value is missing."""
    return df.select(*[F.col(c).isNull().cast("int").alias(c) for c in cols])


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per missingness pattern, pattern written as a 0/1 string in column order."""
    pat = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in cols])
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


MAX_BINS = 1_000_000  # bins of a shared histogram, all columns together


def shared_histogram(df: DataFrame, cols: Sequence[str], nbins: int | None = None,
                     x_range: tuple[float, float] | None = None, empty: bool = True) -> DataFrame:
    """Equal-width bins over one range shared by all columns.  Default range is
    the global min/max, default bin count ``int(max - min) + 1``; the last bin is
    closed; NULLs are dropped; empty bins have count 0, or are left out with
    ``empty=False`` (a range of more than ``MAX_BINS`` bins needs that or ``nbins``).
    Returns ``(column, bin, bin_lo, bin_hi, count)``."""
    long = to_long(df, cols)
    spark = df.sparkSession
    if x_range is None:
        rng = long.agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    else:
        rng = spark.range(1).select(F.lit(float(x_range[0])).alias("_lo"), F.lit(float(x_range[1])).alias("_hi"))
    nb = F.lit(int(nbins)).cast("long") if nbins else F.floor(F.col("_hi") - F.col("_lo")) + 1
    rng = rng.withColumn("_nb", nb).withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.col("_nb"))
    t = attach_row(long, rng).where((F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi")))
    b = F.least(F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("_lo"), F.col("_w"))), F.lit(0)),
                F.col("_nb") - 1)
    counts = t.groupBy("column", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    if empty:
        names = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
        fits = F.when(F.col("_nb") * len(cols) <= MAX_BINS, F.col("_nb")).otherwise(
            F.raise_error(F.lit(f"more than {MAX_BINS} bins: give nbins, or empty=False")).cast("long"))
        grid = attach_row(names, rng).select("column", F.explode(F.sequence(F.lit(0).cast("long"), fits - 1)).alias("bin"), "_lo", "_w")
        found = grid.withColumn("bin", F.col("bin").cast("int")).join(counts, ["column", "bin"], "left")
    else:
        found = attach_row(counts, rng)
    return found.select(
        "column", "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def class_quantile_summary(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Min, quartiles and max of every column per class."""
    return quantile_wide(df, cols, {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}, by)


def trimmed_mean(df: DataFrame, cols: Sequence[str], proportion: float = 0.1,
                 by: Sequence[str] = ()) -> DataFrame:
    """Scipy ``trim_mean`` per column (and group)."""
    return trimmed_mean_long(to_long(df, cols, by), [*by, "column"], proportion)


def bounding_box(df: DataFrame, xcols: Sequence[str], ycols: Sequence[str], pad: float = 0.1) -> DataFrame:
    """One range over all x and y columns together, each end times (1 + pad)."""
    cols = [*xcols, *ycols]
    lo = F.least(*[F.min(c) for c in cols]) if len(cols) > 1 else F.min(cols[0])
    hi = F.greatest(*[F.max(c) for c in cols]) if len(cols) > 1 else F.max(cols[0])
    return df.agg((lo * (1 + pad)).alias("box_min"), (hi * (1 + pad)).alias("box_max"))


def near_constant_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Range, zero share, median, MAD (median |x - median|) and dominant-value
    share (largest value count / n rows) per column, all from one histogram
    ``(column, value) -> count``.  A column (of a group) without a value stays, with
    NULL statistics and zero shares."""
    by = list(by)
    keys = [*by, "column"]
    r = save(histogram_ranks(to_long(df, cols, by).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("cnt")), keys), "value-ranks")
    base = r.groupBy(*keys).agg((F.max("value") - F.min("value")).alias("range"), F.max("cnt").alias("_top"),
                                F.sum(F.when(F.col("value") == 0, F.col("cnt")).otherwise(0)).alias("_zeros"))
    med = save(read_quantiles(r, keys, [0.5]).select(*keys, F.col("quantile").alias("median")), "medians")
    dev = attach_group(r, med, keys).select(*keys, F.abs(F.col("value") - F.col("median")).alias("value"), "cnt") \
        .groupBy(*keys, "value").agg(F.sum("cnt").alias("cnt"))
    mad = read_quantiles(histogram_ranks(dev, keys), keys, [0.5]).select(*keys, F.col("quantile").alias("mad"))
    found = attach_group(attach_group(base, med, keys), mad, keys)
    n_rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    grid = n_rows.select(*by, "n_rows", F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    f = found.select(*[F.col(c).alias("_f_" + c) for c in keys], "range", "_zeros", "median", "mad", "_top")
    cond = F.lit(True)
    for c in keys:
        cond = cond & grid[c].eqNullSafe(f["_f_" + c])
    out = grid.join(f, cond, "left")
    return out.select(*by, "column", "range", (F.coalesce("_zeros", F.lit(0)) / F.col("n_rows")).alias("zero_share"),
                      "median", "mad", (F.coalesce("_top", F.lit(0)) / F.col("n_rows")).alias("dominant_share"))


def near_constant_filter(stats: DataFrame, tol: float = 0.95, mad_eps: float = 1e-12,
                         rcv_thresh: float = 1e-3, use_zero_proxy: bool = True,
                         exact_dominant: bool = False) -> DataFrame:
    """FS4 decision per column from ``near_constant_stats``: no value at all, constant,
    zero-dominant, flat by MAD (absolute or relative to |median|), optionally dominant value."""
    drop = F.col("range").isNull() | (F.col("range") == 0)
    if use_zero_proxy:
        drop = drop | (F.col("zero_share") >= tol)
    drop = drop | (F.col("mad") <= mad_eps) | (F.col("mad") / (F.abs("median") + 1e-12) <= rcv_thresh)
    if exact_dominant:
        drop = drop | (F.col("dominant_share") >= tol)
    return stats.select("column", F.coalesce(drop, F.lit(False)).alias("drop"))
