"""Connected components of an edge table, by saved rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` of every id in ``edges``; the component is its least id.

    Each round hangs every id under its least neighbour (or itself), follows the parents
    to their roots by pointer jumping on the id table, and contracts the edges to pairs of
    different roots; it ends when no edge is left.  The edges are joined once per
    round and shrink with it.  Tables go to the shared folder; only whether something is
    left reaches the driver.
    """
    e = common.save(_pairs(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "cc-edges")
    loops = edges.select(F.col(a).alias("id")).union(edges.select(F.col(b))).distinct()
    names = None
    while e.limit(1).count():
        both = e.select(F.col("u").alias("id"), F.col("v").alias("n")).union(e.select("v", "u"))
        parent = common.save(both.groupBy("id").agg(F.least(F.min("n"), F.col("id")).alias("p")), "cc-parents")
        while True:
            up = parent.select(F.col("id").alias("q"), F.col("p").alias("r"))
            jumped = common.save(parent.join(up, parent["p"] == up["q"]).select("id", F.col("r").alias("p"), (F.col("r") != F.col("p")).alias("moved")), "cc-parents")
            parent = jumped.select("id", "p")
            if not jumped.where("moved").limit(1).count():
                break
        if names is None:
            names = parent.select("id", F.col("p").alias("component"))
        else:
            up = parent.select(F.col("id").alias("q"), F.col("p").alias("r"))
            names = common.save(names.join(up, names["component"] == up["q"], "left").select("id", F.coalesce("r", "component").alias("component")), "cc-names")
        pu, pv = parent.select(F.col("id").alias("iu"), F.col("p").alias("ru")), parent.select(F.col("id").alias("iv"), F.col("p").alias("rv"))
        e = common.save(_pairs(e.join(pu, e["u"] == pu["iu"]).join(pv, F.col("v") == F.col("iv")).select(F.col("ru").alias("u"), F.col("rv").alias("v"))), "cc-edges")
    if names is None:
        return loops.select("id", F.col("id").alias("component"))
    return loops.join(names.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left").select("id", F.coalesce("component", "id").alias("component"))


def _pairs(e: DataFrame) -> DataFrame:
    """Distinct pairs of different ids, larger first."""
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
