"""Skew-tolerant ordered numbering and bounded look-back windows.

A plain ``row_number().over(Window.partitionBy(g).orderBy(o))`` sends every row
of a group to one task; when one group holds a third of the data that task
holds a third of the data.  The helpers here never do that:

``number_rows``
    deals the rows out by ranges of ``(group, order)`` (Spark's range partitioning,
    so a hot group, an outlier key or a heavy tail spreads evenly, and keys may be of
    any ordered type), writes them with the number of their range, numbers every
    ``(group, range)`` piece locally and adds the piece's offset, taken from a count
    table of about ``#groups + #ranges`` rows.  The ranges are fixed by the written
    table, so all plan branches agree, and the numbers do not depend on them.

``with_lookback`` / ``block_window`` / ``own_rows``
    once rows carry a dense frame number, a look-back of ``h`` rows only needs
    ``h`` predecessors: rows are grouped in fixed blocks of ``block_rows``
    frames, and the last ``h`` frames of every block are copied into the next
    block as halo rows.  Windows run per ``(group, block)`` (bounded size),
    halo rows are dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import save

DEFAULT_BLOCK_ROWS = 1 << 20


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str, how: str = "inner") -> DataFrame:
    """Join ``right`` (columns renamed ``prefix+key``) on null-safe key equality."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[prefix + k])
    return left.join(right, cond, how).drop(*[prefix + k for k in keys])


def ranged(df: DataFrame, keys: Sequence[str], tag: str = "ranged") -> DataFrame:
    """``df`` dealt out by ranges of ``keys`` and saved, with the range number ``_chunk``
    (ascending with the keys).  Rows that agree in all keys share a range."""
    return save(df.repartitionByRange(*keys).withColumn("_chunk", F.spark_partition_id().cast("long")), tag)


def chunk_offsets(local: DataFrame, by: Sequence[str], measure: str, chunk: str = "_chunk") -> DataFrame:
    """Attach ``_off`` (sum of ``measure`` over earlier chunks of the group) and
    ``_total`` (whole group).  The per-chunk table has a row per group and range it
    touches; without groups its window runs in one task over the ranges."""
    by = list(by)
    per = local.groupBy(*by, chunk).agg(F.sum(measure).alias("_cs"))
    prev = Window.partitionBy(*by).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(b).alias("_o_" + b) for b in by], F.col(chunk).alias("_o_" + chunk),
                     F.coalesce(F.sum("_cs").over(prev), F.lit(0)).alias("_off"),
                     F.sum("_cs").over(Window.partitionBy(*by)).alias("_total"))
    return _key_join(local, per, [*by, chunk], "_o_")


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rn",
                start: int = 0, total: str | None = None) -> DataFrame:
    """Dense row number within ``by`` following ``order`` (ascending, NULL first).

    ``order`` must be unique within a group (append a key column to break ties).
    """
    by, order = list(by), list(order)
    dealt = ranged(df, [*by, *order], "numbered")
    w = Window.partitionBy(*by, "_chunk").orderBy(*order)
    local = dealt.withColumn("_lrn", F.row_number().over(w) - 1).withColumn("_one", F.lit(1))
    out = chunk_offsets(local, by, "_one")
    out = out.withColumn(name, (F.col("_lrn") + F.col("_off") + F.lit(start)).cast("long"))
    if total:
        out = out.withColumn(total, F.col("_total").cast("long"))
    return out.drop("_chunk", "_lrn", "_one", "_off", "_total")


def attach_group(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group columns to the rows; a NULL key is a group like any other, so
    every row whose group is there stays (all rows with ``how`` "left")."""
    renamed = groups.select(*[F.col(c).alias("_g_" + c) if c in keys else F.col(c) for c in groups.columns])
    return _key_join(df, renamed, list(keys), "_g_", how)


def with_lookback(df: DataFrame, frame: str, halo: int,
                  block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Tag rows with ``_blk``; the last ``halo`` frames of a block also go to the next block."""
    if halo >= block_rows:
        raise ValueError("halo must be smaller than block_rows")
    blk = F.expr(f"`{frame}` div {block_rows}")
    tail = (F.col(frame) % block_rows) >= (block_rows - halo)
    return (df.withColumn("_home", blk)
              .withColumn("_blk", F.explode(F.when(tail, F.array(blk, blk + 1)).otherwise(F.array(blk))))
              .withColumn("_own", F.col("_blk") == F.col("_home"))
              .drop("_home"))


def block_window(by: Sequence[str], frame: str) -> Window:
    return Window.partitionBy(*by, "_blk").orderBy(frame)


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("_own")).drop("_blk", "_own")


def first_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int,
                      name: str = "rank") -> DataFrame:
    """Top-n per group (``row_number() <= n``).  Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so each task ships at most n rows per
    group and a hot group never lands whole in one task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def side_by_side(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """The columns of two tables next to each other, row by row of their own orders (unique
    keys, NULL first), with the position ``pos``.  Where one table is shorter its columns are
    NULL.  Both are numbered without a single-task sort and joined on the position."""
    a = number_rows(left, [], left_order, "pos")
    b = number_rows(right, [], right_order, "_pos")
    out = a.join(b, a["pos"] == b["_pos"], "full_outer")
    return out.withColumn("pos", F.coalesce("pos", "_pos")).drop("_pos")
