"""Exact, interpolated quantiles and rank statistics without a single hot task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a continuous column over 100 TB ends in one task.  Here
the exact answer is computed from a distributed rank table instead:

1. ``(group, value) -> count`` with map-side combine (hot values collapse);
2. that histogram is dealt out by ranges of ``(group, value)`` and written once (so
   the input is scanned once and skewed values spread evenly); every range gets local
   cumulative counts and an offset from a small per-range totals table;
3. a quantile at probability ``p`` is read from the one or two histogram rows
   that cover positions ``floor(p(n-1))`` and ``ceil(p(n-1))`` and linearly
   interpolated -- the rule of DuckDB ``quantile_cont`` and numpy ``linear``.

Everything returned is tiny (one row per group x column x probability).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from .ordering import chunk_offsets, ranged


def to_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
            name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot ``cols`` to ``(by..., column, value)`` as DOUBLE; NULL and NaN are dropped."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(by), list(cols), name, value)
    return long.where(F.col(value).isNotNull() & ~F.isnan(value))


def histogram_ranks(hist: DataFrame, by: Sequence[str], value: str = "value", cnt: str = "cnt") -> DataFrame:
    """Ranks of a table ``(by..., value, cnt)`` of distinct values: adds ``cum_before``
    (rows with a smaller value) and ``n``."""
    by = list(by)
    dealt = ranged(hist.select(*by, value, F.col(cnt).alias("cnt")), [*by, value], "histogram")
    local = Window.partitionBy(*by, "_chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("_lcum", F.coalesce(F.sum("cnt").over(local), F.lit(0)))
    out = chunk_offsets(dealt, by, "cnt")
    return out.select(*by, value, "cnt", (F.col("_lcum") + F.col("_off")).alias("cum_before"),
                      F.col("_total").cast("long").alias("n"))


def value_ranks(long: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Per distinct value: ``cnt``, ``cum_before`` (rows with smaller value) and ``n``."""
    by = list(by)
    return histogram_ranks(long.groupBy(*by, value).agg(F.count(F.lit(1)).alias("cnt")), by, value)


def _probs_literal(probs: Sequence[float]):
    return F.array(*[F.lit(float(p)) for p in probs])


def quantiles_long(long: DataFrame, by: Sequence[str], probs: Sequence[float],
                   value: str = "value", prob_name: str = "prob", out: str = "quantile") -> DataFrame:
    """Exact linear-interpolated quantiles per group: ``(by..., prob, quantile)``."""
    return read_quantiles(value_ranks(long, by, value), by, probs, value, prob_name, out)


def read_quantiles(r: DataFrame, by: Sequence[str], probs: Sequence[float],
                   value: str = "value", prob_name: str = "prob", out: str = "quantile") -> DataFrame:
    """Quantiles from a rank table (see ``histogram_ranks``)."""
    return _interpolated(_quantile_parts(r, by, probs, value, prob_name), by, prob_name, out)


def _quantile_parts(r: DataFrame, by: Sequence[str], probs: Sequence[float], value: str = "value", prob_name: str = "prob") -> DataFrame:
    """The values next to each quantile's position: ``(by..., prob, _vlo, _vhi, _pos)``."""
    by = list(by)
    hits = F.filter(
        F.transform(_probs_literal(probs), lambda p: F.struct(
            p.alias("p"), (p * (F.col("n") - 1)).alias("pos"))),
        lambda s: (F.col("cum_before") <= F.ceil(s["pos"]))
        & (F.col("cum_before") + F.col("cnt") > F.floor(s["pos"])))
    r = r.select(*by, value, "cnt", "cum_before", F.explode(hits).alias("_h"))
    lo, hi = F.floor(F.col("_h.pos")), F.ceil(F.col("_h.pos"))
    covers = lambda k: (F.col("cum_before") <= k) & (k < F.col("cum_before") + F.col("cnt"))
    return r.groupBy(*by, F.col("_h.p").alias(prob_name)).agg(
        F.max(F.when(covers(lo), F.col(value))).alias("_vlo"),
        F.max(F.when(covers(hi), F.col(value))).alias("_vhi"),
        F.first(F.col("_h.pos")).alias("_pos"))


def _interpolated(parts: DataFrame, by: Sequence[str], prob_name: str = "prob", out: str = "quantile") -> DataFrame:
    frac = F.col("_pos") - F.floor(F.col("_pos"))
    return parts.select(*by, prob_name,
                      (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias(out))


def _collapsed(c: str, brackets: Sequence[tuple[float, float]]):
    """A column whose values outside the brackets (ascending, apart) are replaced by one value
    per gap, that lies in the gap before all values of the column in it."""
    e = F.when(F.col(c) < brackets[0][0], float("-inf"))
    for k, (lo, hi) in enumerate(brackets):
        if k:
            e = e.when(F.col(c) < lo, _after(brackets[k - 1][1]))
        e = e.when(F.col(c) <= hi, F.col(c))
    return e.when(F.col(c).isNotNull(), _after(brackets[-1][1]))


def _after(v: float) -> float:
    return math.nextafter(v, math.inf)


def _brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int, least_rows: int) -> dict[str, list[tuple[float, float]]]:
    """Ranges of values that should hold the quantiles, from a sketch of each column; columns
    of up to ``least_rows`` values have none."""
    around = [(p - 2.0 / accuracy, p + 2.0 / accuracy) for p in sorted(set(probs))]
    at = [min(max(q, 0.0), 1.0) for pair in around for q in pair]
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)], *[F.percentile_approx(c, at, accuracy).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        if row[f"n{i}"] > least_rows:
            merged: list[tuple[float, float]] = []
            for k, (p, q) in enumerate(around):
                lo, hi = float("-inf") if p <= 0 else row[f"s{i}"][2 * k], float("inf") if q >= 1 else row[f"s{i}"][2 * k + 1]
                if merged and lo <= _after(merged[-1][1]):
                    lo, hi = merged[-1][0], max(hi, merged.pop()[1])
                merged.append((lo, hi))
            out[c] = merged
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), accuracy: int = 10_000, least_rows: int = 1 << 20) -> DataFrame:
    """``(by..., column, prob, quantile)`` for every numeric column in ``cols``.

    Without groups, a sketch first tells between which values the quantiles of a column of
    more than ``least_rows`` values lie; the exact histogram then holds those values, and of the
    others only how many there are in each gap, so what is shuffled and ranked is a small
    share of the rows.  Where a rank falls in a gap after all, the column is done again in full."""
    if by:
        return quantiles_long(to_long(df, cols, by), [*by, "column"], probs)
    names = [f"c{i}" for i in range(len(cols))]
    # By number: the columns' own names may hold dots or stars.
    src = nan_to_null(df.select(*[F.col(c).cast("double").alias(n) for n, c in zip(names, cols)]), names)
    brackets = _brackets(src, names, probs, accuracy, least_rows)
    found, todo = {}, names
    while todo:
        some = src.select(*[_collapsed(c, brackets[c]).alias(c) if c in brackets else F.col(c) for c in todo])
        parts = _quantile_parts(value_ranks(to_long(some, todo), ["column"]), ["column"], probs).collect()
        gaps = {c: {float("-inf"), *[_after(hi) for _, hi in b]} for c, b in brackets.items()}
        missed = {r["column"] for r in parts if {r["_vlo"], r["_vhi"]} & gaps.get(r["column"], set())}
        found |= {c: [r for r in parts if r["column"] == c] for c in todo if c not in missed}
        brackets, todo = {}, [c for c in todo if c in missed]
    rows = [(col, r["prob"], r["_vlo"], r["_vhi"], r["_pos"]) for n, col in zip(names, cols) for r in found[n]]
    parts = df.sparkSession.createDataFrame(rows, "column string, prob double, _vlo double, _vhi double, _pos double")
    return _interpolated(parts, ["column"])


def quantile_wide(df: DataFrame, cols: Sequence[str], probs: dict[str, float],
                  by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, <name per prob>...)`` -- one row per column (and group)."""
    q = quantiles(df, cols, list(probs.values()), by)
    return q.groupBy(*by, "column").agg(*[
        F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(name)
        for name, p in probs.items()])


def trimmed_mean_long(long: DataFrame, by: Sequence[str], proportion: float,
                      value: str = "value", out: str = "trimmed_mean") -> DataFrame:
    """Mean after cutting ``int(proportion * n)`` sorted values from each end
    (the scipy ``trim_mean`` rule), from the distributed rank table."""
    by = list(by)
    r = value_ranks(long, by, value)
    k = F.floor(F.col("n") * F.lit(float(proportion)))
    keep_lo, keep_hi = k, F.col("n") - k
    overlap = F.greatest(F.lit(0), F.least(F.col("cum_before") + F.col("cnt"), keep_hi)
                         - F.greatest(F.col("cum_before"), keep_lo))
    return r.groupBy(*by).agg(
        F.try_divide(F.sum(F.col(value) * overlap), F.sum(overlap)).alias(out))
