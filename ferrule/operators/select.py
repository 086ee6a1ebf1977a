"""Correlation tables and feature selection (FS1-FS9, FS12, J4-J6, T10, T11).

Correlation tables come from centred Gram matrices added up per task (one matrix
product per batch, no row is copied); covariances from one aggregate.  The pair table
has p(p-1)/2 rows for p columns and never grows with the data.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null
from ..storage import save
from .quantile import quantiles


NATIVE_PAIRS = 66  # pairs of columns that one aggregate takes
MI_CELLS = 20_000  # cells of bins that a task counts at once


def _stack(row: DataFrame, structs) -> DataFrame:
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def _gram_rows(n_by: int, p: int, centre: list[float]):
    """Arrow batches (by..., columns) to rows (by..., i, j, n, sx, sy, sxx, syy, sxy):
    pairwise-complete sums of the values less ``centre``, one matrix product per batch
    and group, added up over the whole task."""
    def run(batches):
        total: dict = {}
        for b in batches:
            x = np.stack([c.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in b.columns[n_by:]], axis=1) - centre
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            keys = list(zip(*[c.to_pylist() for c in b.columns[:n_by]])) if n_by else [()] * b.num_rows
            names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            code = np.fromiter((names[k] for k in keys), np.int64, len(keys))
            for k, i in names.items():
                v, m = x[code == i], there[code == i].astype(float)
                got = np.stack([m.T @ m, v.T @ m, m.T @ v, (v * v).T @ m, m.T @ (v * v), v.T @ v])
                total[k] = total[k] + got if k in total else got
        for k, g in total.items():
            i, j = np.triu_indices(p, 1)
            cols = [pa.array([key] * len(i)) for key in k] + [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))] + [pa.array(g[q][i, j]) for q in range(6)]
            yield pa.RecordBatch.from_arrays(cols, names=[*[f"_b{q}" for q in range(len(k))], "i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    return run


def corr_pairs(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Upper-triangle Pearson correlation table ``(by..., i, j, a, b, corr, abs_corr)``
    (pairwise-complete rows, like pandas ``corr``; NaN is missing).  J6 + FS12 (with
    ``by``).  No row is copied.  Up to ``NATIVE_PAIRS`` pairs are one aggregate of ``corr``;
    of more columns a first aggregate gives the means, then every task adds up one p x p
    Gram matrix of the centred values per group and ships one row per pair."""
    by, p = list(by), len(cols)
    names = [c.strip("`") for c in cols]
    src = df.select(*[F.col(b) for b in by], *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = list(itertools.combinations(range(p), 2))
    if 0 < len(pairs) <= NATIVE_PAIRS:
        one = nan_to_null(src, [f"_c{i}" for i in range(p)]).groupBy(*by).agg(*[F.corr(f"_c{i}", f"_c{j}").alias(f"_r{i}_{j}") for i, j in pairs])
        rows = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b"),
                                            F.nanvl(F.col(f"_r{i}_{j}"), F.lit(None).cast("double")).alias("corr")) for i, j in pairs])).alias("_p")
        return one.select(*by, rows).select(*by, "_p.*").withColumn("abs_corr", F.abs("corr"))
    row = nan_to_null(src, [f"_c{i}" for i in range(p)]).agg(*[F.avg(f"_c{i}").alias(f"_c{i}") for i in range(p)]).first()
    centre = [float(row[f"_c{i}"] or 0.0) for i in range(p)]
    fields = ", ".join([*[f"_b{q} {src.schema[b].dataType.simpleString()}" for q, b in enumerate(by)], "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"])
    sums = src.mapInArrow(_gram_rows(len(by), p, centre), fields)
    g = sums.groupBy(*[f"_b{q}" for q in range(len(by))], "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    vx, vy = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n"), F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    corr = F.when((F.col("n") > 0) & (vx > 0) & (vy > 0), cov / F.sqrt(vx) / F.sqrt(vy))
    lookup = F.array(*[F.lit(n) for n in names])
    return g.select(*[F.col(f"_b{q}").alias(b) for q, b in enumerate(by)], "i", "j", lookup[F.col("i")].alias("a"), lookup[F.col("j")].alias("b"), corr.alias("corr"),
                    F.abs(corr).alias("abs_corr"))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``(column, corr, abs_corr)`` of every feature with the target."""
    row = df.agg(*[F.corr(c, target).alias(f"_t{k}") for k, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"_t{k}").alias("corr")) for k, c in enumerate(cols)]
    return _stack(row, structs).withColumn("abs_corr", F.abs("corr"))


def drop_highly_correlated(pairs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """FS1: columns whose |corr| with any earlier column exceeds the threshold."""
    return pairs.where(F.col("abs_corr") > threshold).select(F.col("b").alias("column"), F.col("j").alias("position")) \
                .distinct()


def keep_target_correlated(target_corr: DataFrame, threshold: float = 0.05) -> DataFrame:
    """FS2: columns with |corr(target)| strictly above the threshold."""
    return target_corr.where(F.col("abs_corr") > threshold).select("column")


# Thresholds of the correlation count reports, in order.
PAIR_THRESHOLDS = [0.99, 0.95, 0.9, 0.5, 0.0]
TARGET_THRESHOLDS = [0.01, 0.05, 0.1, 1.0]


def pair_threshold_counts(pairs: DataFrame, thresholds: Sequence[float] = tuple(PAIR_THRESHOLDS)) -> DataFrame:
    """FS8: number of pairs with |corr| above each threshold."""
    row = pairs.agg(*[F.count_if(F.col("abs_corr") > t).alias(f"_n{k}") for k, t in enumerate(thresholds)])
    return _stack(row, [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_n{k}").alias("n_pairs"))
                        for k, t in enumerate(thresholds)])


def weak_pairs(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """FS8 dictionary: the pairs whose |corr| is *below* the threshold (kept literal)."""
    return pairs.where(F.col("abs_corr") < threshold).select("a", "b", "abs_corr")


def target_threshold_counts(target_corr: DataFrame,
                            thresholds: Sequence[float] = tuple(TARGET_THRESHOLDS)) -> DataFrame:
    """FS7: number of features with |corr(target)| below each threshold."""
    row = target_corr.agg(*[F.count_if(F.col("abs_corr") < t).alias(f"_n{k}") for k, t in enumerate(thresholds)])
    return _stack(row, [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_n{k}").alias("n_features"))
                        for k, t in enumerate(thresholds)])


def dominant_sets(items: DataFrame, name: str = "name", score: str = "score", sep: str = " ") -> DataFrame:
    """J4 / FS9: keep the items for which no *proper-or-equal* subset item (by token
    set) has a strictly higher score.  Instead of comparing all pairs, every item
    enumerates the subsets of its own token set (2^|tokens|, bounded by the
    polynomial degree) and is equi-joined with the items keyed by canonical set."""
    toks = items.select(name, F.col(score).cast("double").alias("_s"),
                        F.array_sort(F.array_distinct(F.split(F.col(name), sep))).alias("_set"))
    masks = F.expr("sequence(1, shiftleft(1, size(_set)) - 1)")
    subsets = toks.select(name, "_s", F.explode(masks).alias("_m"), "_set").select(
        name, "_s", F.array_join(F.expr("filter(_set, (t, k) -> shiftright(_m, k) % 2 = 1)"), "\u0001")
        .alias("_key"))
    keyed = toks.select(F.array_join("_set", "\u0001").alias("_key"), F.col("_s").alias("_os"),
                        F.col(name).alias("_other"))
    beaten = subsets.join(keyed, "_key").where((F.col("_os") > F.col("_s")) & (F.col("_other") != F.col(name)))
    return items.join(beaten.select(name).distinct(), name, "left_anti")


def covariance_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample covariance for every pair i <= j (diagonal = variance)."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.covar_samp(cols[i], cols[j]).alias(f"_v{i}_{j}") for i, j in pairs])
    return _stack(row, [F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"),
                                 F.col(f"_v{i}_{j}").alias("cov")) for i, j in pairs])


def standardized_covariance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``np.cov`` (ddof 1) of columns z-scored with ddof 0, i.e. r * n / (n - 1);
    diagonal n / (n - 1).  Rows with any NULL are dropped first (numpy semantics)."""
    full = df.select(*cols).dropna()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = full.agg(F.count(F.lit(1)).alias("_n"),
                   *[(F.corr(cols[i], cols[j]) if i != j else F.lit(1.0)).alias(f"_r{i}_{j}") for i, j in pairs])
    scale = F.col("_n") / (F.col("_n") - 1)
    return _stack(row, [F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"),
                                 (F.col(f"_r{i}_{j}") * scale).alias("cov")) for i, j in pairs])


def greedy_correlated_groups(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> list[dict]:
    """FS3: features sorted by variance (desc); each feature not yet grouped opens a
    group holding the not-yet-grouped features correlated above ``threshold``;
    the first (highest variance) member is kept.  Works on the p x p pair table
    (bounded by the column count), not on rows."""
    var_row = df.agg(*[F.var_samp(c).alias(c) for c in cols]).first().asDict()
    pair_rows = corr_pairs(df, cols).select("a", "b", "abs_corr").collect()
    corr = {}
    for r in pair_rows:
        corr[(r["a"], r["b"])] = corr[(r["b"], r["a"])] = r["abs_corr"] or 0.0
    order = sorted(cols, key=lambda c: (-(var_row[c] or 0.0), cols.index(c)))
    used, groups = set(), []
    for c in order:
        if c in used:
            continue
        members = [c] + [o for o in order if o not in used and o != c and corr.get((c, o), 0.0) > threshold]
        used.update(members)
        groups.append({"keep": c, "drop": members[1:]})
    return groups


def binned_mutual_information(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10,
                              target_is_class: bool = False) -> DataFrame:
    """FS5 (re-aimed): mutual information (nats) between each feature, cut into
    ``bins`` equal-frequency bins by exact quantiles, and the target (its own class
    or its binned value).  One contingency aggregate per feature set."""
    probs = [k / bins for k in range(1, bins)]
    feats = list(cols) + ([] if target_is_class else [target])
    edges = {c: [] for c in feats}
    for r in quantiles(df, feats, probs).collect():
        edges[r["column"]].append(r["quantile"])

    def binned(c):
        """Edges below the value; NULL for a column without values."""
        below = F.lit(0) if edges[c] else F.lit(None).cast("int")
        for e in edges[c]:
            below = below + F.when(F.lit(e) < F.col(c), 1).otherwise(0)
        return below

    # Cells of a few columns at once: rows are copied once per set of columns, not per column.
    per = max(1, int(math.log(MI_CELLS, max(bins, 2))) - 1)
    sets = [list(range(a, min(a + per, len(cols)))) for a in range(0, len(cols), per)]
    t = df.select((F.col(target).cast("string") if target_is_class else binned(target)).alias("_y"), *[binned(c).alias(f"_x{k}") for k, c in enumerate(cols)])
    packed = t.select("_y", F.inline(F.array(*[F.struct(F.lit(i).alias("_s"), *[(F.col(f"_x{s[j]}") if j < len(s) else F.lit(None).cast("int")).alias(f"_v{j}")
                                                                              for j in range(per)]) for i, s in enumerate(sets)])))
    cells = packed.groupBy("_y", "_s", *[f"_v{j}" for j in range(per)]).agg(F.count(F.lit(1)).alias("_c"))
    names = F.array(*[F.lit(c) for c in cols])
    long = cells.select("_y", "_c", F.inline(F.array(*[F.struct(F.get(names, F.col("_s") * per + j).alias("column"), F.col(f"_v{j}").alias("_x")) for j in range(per)])))
    joint = save(long.where(F.col("column").isNotNull()).groupBy("column", "_x", "_y").agg(F.sum("_c").alias("_nxy")), "mi-cells")
    mx = joint.groupBy("column", "_x").agg(F.sum("_nxy").alias("_nx"))
    my = joint.groupBy("column", "_y").agg(F.sum("_nxy").alias("_ny"))
    n = joint.groupBy("column").agg(F.sum("_nxy").alias("_n"))
    j = joint.join(mx, ["column", "_x"]).join(my, ["column", "_y"]).join(n, "column")
    term = (F.col("_nxy") / F.col("_n")) * F.log((F.col("_nxy") * F.col("_n")) / (F.col("_nx") * F.col("_ny")))
    return j.groupBy("column").agg(F.sum(term).alias("mutual_information"))


def polynomial_terms(cols: Sequence[str], degree: int) -> list[tuple[str, list[str]]]:
    """T5 term list without bias, degree-major, combinations with replacement --
    names like ``a^2 b``."""
    out = []
    for d in range(1, degree + 1):
        for combo in itertools.combinations_with_replacement(cols, d):
            counts = {c: combo.count(c) for c in dict.fromkeys(combo)}
            name = " ".join(c if k == 1 else f"{c}^{k}" for c, k in counts.items())
            out.append((name, list(combo)))
    return out


def polynomial_features(df: DataFrame, cols: Sequence[str], degree: int, keep: Sequence[str] = ()) -> DataFrame:
    """T5: every monomial up to ``degree`` as a column (one projection)."""
    exprs = []
    for name, combo in polynomial_terms(cols, degree):
        e = F.lit(1.0)
        for c in combo:
            e = e * F.col(c)
        exprs.append(e.alias(name))
    return df.select(*keep, *exprs)


def mi_gain_of_products(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """FS6: MI(a*b) - MI(b) for every ordered pair (a, b) of distinct features."""
    prods = {f"{a}*{b}": F.col(a) * F.col(b) for a, b in itertools.combinations(cols, 2)}
    wide = df.select(*cols, target, *[e.alias(k) for k, e in prods.items()])
    mi = binned_mutual_information(wide, list(cols) + list(prods), target, bins)
    rows = []
    for a, b in itertools.permutations(cols, 2):
        key = f"{a}*{b}" if f"{a}*{b}" in prods else f"{b}*{a}"
        rows.append((a, b, key))
    spec = df.sparkSession.createDataFrame(rows, "a string, b string, product string")
    return spec.join(mi.withColumnRenamed("column", "product").withColumnRenamed("mutual_information", "_mab"),
                     "product").join(mi.withColumnRenamed("column", "b").withColumnRenamed("mutual_information", "_mb"),
                                     "b").select("a", "b", (F.col("_mab") - F.col("_mb")).alias("mi_gain"))


def parameter_grid(options: dict[str, Sequence]) -> list[dict]:
    """Cartesian product of option lists; the FIRST key varies fastest."""
    keys = list(options)
    out = []
    for combo in itertools.product(*[options[k] for k in reversed(keys)]):
        out.append(dict(zip(reversed(keys), combo)))
    return [{k: d[k] for k in keys} for d in out]


def parameter_grid_df(spark, options: dict[str, Sequence]) -> DataFrame:
    """J5 as a DataFrame: one generator per option list (no join); ``ordinal`` is the
    position in first-key-fastest order."""
    keys = list(options)
    df = spark.range(1).select()
    sizes = [len(options[k]) for k in keys]
    for k in reversed(keys):
        df = df.select("*", F.posexplode(F.array(*[F.lit(str(v)) for v in options[k]])).alias(f"_{k}_i", k))
    ordinal = F.lit(0)
    stride = 1
    for k, n in zip(keys, sizes):
        ordinal = ordinal + F.col(f"_{k}_i") * stride
        stride *= n
    return df.select(ordinal.alias("ordinal"), *keys)


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma)."""
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        for _ in range(500):
            k += 1
            term *= z / k
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    b = z + 1 - a
    c, d = 1.0 / 1e-300, 1.0 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h

