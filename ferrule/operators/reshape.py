"""Reshaping, set operations and small-result sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable", value: str = "value",
         strip_suffix: str | None = None) -> DataFrame:
    """Wide -> long; optionally strip a suffix (regex) from the variable names."""
    long = df.unpivot(list(ids), list(cols), var, value)
    if strip_suffix:
        long = long.withColumn(var, F.regexp_replace(var, strip_suffix, ""))
    return long


def pivot_first(df: DataFrame, keys: Sequence[str], pivot: str, values: Sequence, value: str) -> DataFrame:
    """(keys) x pivot values, first value per cell (explicit value list, no extra job)."""
    return df.groupBy(*keys).pivot(pivot, list(values)).agg(F.first(value))


def pivot_split_name(df: DataFrame, name: str, sep: str, left: str, right: str, value: str,
                     right_values: Sequence) -> DataFrame:
    """R7 + C20: split ``name`` at ``sep`` into two keys, pivot the second, mean of ``value``."""
    parts = F.split(F.col(name), sep, 2)
    t = df.withColumns({left: parts[0], right: parts[1]})
    return t.groupBy(left).pivot(right, list(right_values)).agg(F.avg(value))


def expand_json(df: DataFrame, col: str, keys: Sequence[str], prefix: str = "", value_type: str = "double",
                keep: Sequence[str] = ()) -> DataFrame:
    """JSON object column -> one column per key (declared key list), prefix stripped."""
    m = F.from_json(F.col(col), T.MapType(T.StringType(), T.StringType()))
    return df.select(*keep, *[m.getItem(k).cast(value_type).alias(k[len(prefix):] if k.startswith(prefix) else k)
                              for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """R2: the first row per key in an explicit order, as a min_by aggregate (map-side
    combined, so a hot key never lands whole in one task)."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r"))
    return best.select(*keys, "_r.*")


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows ordered by the given columns."""
    return df.select(*cols).distinct().orderBy(*cols)


def hold_out(df: DataFrame, col: str, groups: Sequence) -> tuple[DataFrame, DataFrame]:
    """(train, test) = rows not in / in the named groups (filters pushed to the scan)."""
    return df.where(~F.col(col).isin(list(groups))), df.where(F.col(col).isin(list(groups)))


def semi(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with a partner."""
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def anti(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner (set difference of ids)."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def bar_table(df: DataFrame, x: str, label: str, facet: str, value: str) -> DataFrame:
    """Bar-plot data contract -- (x, label, facet) must be unique (raises
    otherwise), NULL categories read 'None', missing (x, label) cells per facet are 0."""
    t = df.select(F.coalesce(F.col(x).cast("string"), F.lit("None")).alias(x),
                  F.coalesce(F.col(label).cast("string"), F.lit("None")).alias(label),
                  F.coalesce(F.col(facet).cast("string"), F.lit("None")).alias(facet), value)
    cells = t.groupBy(x, label, facet).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias(value))
    cells = cells.withColumn(value, F.when(F.col("_n") == 1, F.col(value)).otherwise(
        F.raise_error(F.lit("duplicate bar for (x, label, facet)")))).drop("_n")
    xs = t.select(x, facet).distinct()
    labels = t.select(label, facet).distinct()
    grid = xs.join(labels, facet)
    return grid.join(cells, [x, label, facet], "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def param_group_key(params: str | Column, prefix: str) -> Column:
    """JSON of the (sorted) hyper-parameters whose name starts with ``prefix``."""
    m = F.col(params) if isinstance(params, str) else params
    kept = F.map_filter(m, lambda k, v: k.startswith(prefix))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


def smallest_abs(df: DataFrame, col: str, k: int) -> DataFrame:
    """K rows with the smallest |col| (global top-k: per-task partial limit)."""
    return df.orderBy(F.abs(col), *[c for c in df.columns if c != col]).limit(k)


def rename_models(df: DataFrame, col: str, pattern: str, replacement: str) -> DataFrame:
    """C20: regex replace in a name column."""
    return df.withColumn(col, F.regexp_replace(col, pattern, replacement))


def crosstab(df: DataFrame, group: str, cls: str, classes: Sequence, total: bool = False) -> DataFrame:
    """A2/A3: rows per (group x class) as columns (explicit class list); empty cells
    stay NULL; ``total`` adds the row sum (A3)."""
    piv = df.groupBy(group).pivot(cls, list(classes)).agg(F.count(F.lit(1)))
    if total:
        piv = piv.withColumn("total", sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in classes), F.lit(0)))
    return piv


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """A4: count per label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def abs_differences(df: DataFrame, pairs: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """C17: generated |a - b| columns for the given column pairs."""
    return df.select(*keep, *[F.abs(F.col(a) - F.col(b)).alias(f"absdiff_{a}_{b}") for a, b in pairs])
