"""Isolation filter.

A forest of random splits is grown level by level on hash-chosen rows: one grouped
min/max per (tree, node) gives all splits of a level, the rows then move to the children.
Nodes are a table of at most ``trees * 2^(depth + 1)`` rows; every row of the input is
scored by its path lengths in the tasks.  No row reaches the driver, and the forest is a
function of the ids and the seed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import portable_hash
from ..storage import save
from .models import complete

#: Euler's constant, for the mean depth of an unsuccessful search.
EULER = 0.5772156649015329
RANGE = 1 << 32  # of the portable hash


def mean_depth(n: float) -> float:
    """Mean path length of a search tree over ``n`` rows that is not followed further."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (math.log(n - 1) + EULER) - 2 * (n - 1) / n


def _unit(tree: str, node: str, what: str, seed):
    return portable_hash(F.concat_ws(":", F.col(tree), F.col(node)), f"{what}{seed}") / F.lit(float(RANGE))


def grow_forest(df: DataFrame, id_col: str, cols: Sequence[str], trees: int = 50, sample: int = 256, depth: int = 8, seed=42) -> DataFrame:
    """``(tree, node, feature, threshold, n)``: the root is node 0, the children of node i are 2i + 1
    (value <= threshold) and 2i + 2; leaves have no feature.

    A row is in tree t when its hash lies in the t-th of ``trees`` windows, evenly spaced and
    each as wide as ``sample`` rows of the table (all of it where it has fewer).  A node splits
    on one of its columns that vary, at a place between their least and largest value; both are
    drawn by hash of (tree, node).  Rows without one of the columns are in no tree.
    """
    p = len(cols)
    src = df.where(complete(cols))
    n = src.count()
    step = RANGE // trees
    wide = RANGE if n <= sample else int(RANGE * sample / n)
    h = portable_hash(id_col, f"iso{seed}")
    inside = F.filter(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: t.cast("long")),
                      lambda t: F.pmod(F.col("_h") - t * step, F.lit(RANGE)) < wide)
    rows = src.select(h.alias("_h"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    rows = save(rows.select(F.explode(inside).alias("tree"), F.lit(0).cast("long").alias("node"), *[f"x{i}" for i in range(p)]), "iso-rows")
    out = None
    for level in range(depth + 1):
        stat = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), *[f(f"x{i}").alias(f"{k}{i}") for i in range(p) for k, f in (("lo", F.min), ("hi", F.max))])
        vary = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi")) for i in range(p)]), lambda s: s["hi"] > s["lo"])
        stat = stat.withColumn("_v", vary if level < depth else F.slice(vary, 1, 0))
        at = F.floor(_unit("tree", "node", "col", seed) * F.size("_v")).cast("int")
        stat = stat.withColumn("_s", F.get("_v", at))
        nodes = save(stat.select("tree", "node", F.col("_s.i").alias("feature"), (F.col("_s.lo") + _unit("tree", "node", "at", seed) * (F.col("_s.hi") - F.col("_s.lo"))).alias("threshold"), "n"), "iso-nodes")
        out = nodes if out is None else out.unionByName(nodes)
        if level < depth:
            split = nodes.where("feature IS NOT NULL").select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "feature", "threshold")
            x = F.get(F.array(*[F.col(f"x{i}") for i in range(p)]), F.col("feature"))
            rows = save(rows.join(split, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
                        .select("tree", (F.col("node") * 2 + F.when(x <= F.col("threshold"), 1).otherwise(2)).alias("node"), *[f"x{i}" for i in range(p)]), "iso-rows")
    return save(out, "iso-forest")


def score_forest(df: DataFrame, forest: DataFrame, cols: Sequence[str], trees: int, sample: int, depth: int, name: str = "score") -> DataFrame:
    """Add ``name``: 2 ^ -(mean path length / mean depth of the sample), near 1 for rows that few
    splits isolate; NULL where a column is missing.  The nodes that the tasks get are bounded
    by ``trees * 2^(depth + 1)``."""
    size = (1 << (depth + 1)) - 1
    feature, limit, length = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size))
    root = 0.0
    for r in forest.toLocalIterator():
        t, i = r["tree"], r["node"]
        if r["feature"] is not None:
            feature[t, i], limit[t, i] = r["feature"], r["threshold"]
        length[t, i] = int(math.log2(i + 1)) + mean_depth(r["n"])
        root += r["n"] / trees if i == 0 else 0.0
    scale = mean_depth(min(float(sample), max(root, 2.0)))

    def run(batches):
        for b in batches:
            x = np.stack([b.column(b.num_columns - len(cols) + i).fill_null(float("nan")).to_numpy(zero_copy_only=False) for i in range(len(cols))], axis=1)
            total = np.zeros(len(x))
            for t in range(trees):
                at = np.zeros(len(x), np.int64)
                for _ in range(depth):
                    f = feature[t, at]
                    go = f >= 0
                    at = np.where(go, 2 * at + np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= limit[t, at], 1, 2), at)
                total += length[t, at]
            s = np.exp2(-total / trees / scale)
            yield pa.RecordBatch.from_arrays([*b.columns[:-len(cols)], pa.array(s, mask=np.isnan(x).any(axis=1))], names=[*b.schema.names[:-len(cols)], name])

    numbers = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]
    from pyspark.sql import types as T
    return df.select("*", *numbers).mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def isolation_scores(df: DataFrame, id_col: str, cols: Sequence[str], trees: int = 50, sample: int = 256, depth: int = 8, seed=42, name: str = "score") -> DataFrame:
    return score_forest(df, grow_forest(df, id_col, cols, trees, sample, depth, seed), cols, trees, sample, depth, name)


def isolation_filter(scored: DataFrame, limit: float = 0.5, name: str = "score") -> DataFrame:
    """Rows whose score is at most ``limit`` (one half: no sharper isolated than the average);
    rows without a score stay."""
    return scored.where(F.col(name).isNull() | (F.col(name) <= limit)).drop(name)


def filter_counts(scored: DataFrame, limit: float = 0.5, name: str = "score") -> DataFrame:
    """``(before, after, dropped, unscored)`` in one pass."""
    dropped = F.coalesce(F.col(name) > limit, F.lit(False))
    return scored.agg(F.count(F.lit(1)).alias("before"), F.count_if(~dropped).alias("after"), F.count_if(dropped).alias("dropped"), F.count_if(F.col(name).isNull()).alias("unscored"))
