"""Operator 8 [native]: mixing sources to target weights by Pareto order sampling.

DataFrame functions only.  Every source gets a target number of words: ``budget``
times all words, shared by weight, no source above ``cap`` times its own words, the
excess reshared (water filling, solved in closed form over the source table).  A
document's expected copies are the source's target over its words, times its own
relative ``weight`` if one is given, at most ``cap``.  The whole copies are certain;
the fraction ``p`` left is an inclusion probability, and documents are ranked by
Pareto's odds ratio ``(u / (1 - u)) / (p / (1 - p))``, ``u`` a hash of id and seed.
The sample has a fixed size in words: the prefix of that order whose words come
nearest to what the certain copies leave of the target.

The prefix is found without sorting a source in one task: the rank key is cut into
2^12 cells per source, the cell that holds the border into 2^12 again, and only the
documents of that last cell are ordered.  Each step is an aggregate with map-side
sums, so a source that holds most rows is no hot task.  The border of each source (one
small row) is joined back to the rows; no document is ever joined by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Weights of the sources by rank, repeating; share of all words; limit.
WEIGHTS, BUDGET, CAP = (3, 1, 2), 1.5, 2.0
SEED = "mix-1"
_CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def uniform(key: Column, seed: str) -> Column:
    """Uniform in (0, 1) from 52 bits of md5(key:seed); the same in any engine."""
    s = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """``(src, source_size, weight, target)`` from rows ``(src, size)``."""
    s = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("src").asc_nulls_last())  # the source table: one row per source
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = s.withColumn("weight", F.element_at(w, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    order = Window.orderBy((F.col("source_size") * cap / F.col("weight")).asc(), F.col("src").asc_nulls_last())
    before = F.coalesce(F.sum(F.col("source_size") * cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * budget - before) / left)
    s = s.withColumn("level", F.max("level").over(everything))
    return s.select("src", "source_size", "weight", F.least(F.col("source_size") * cap, F.col("level") * F.col("weight")).alias("target"))


def _ranked(docs: DataFrame, id_col: str, text_col: str, source_col: str, weight_col: str | None, seed: str) -> DataFrame:
    """``(row, id, src, size, w, u)``: the input row and what the method needs of it."""
    w = F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)) if weight_col else F.lit(1.0)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("src"),
                       word_count(F.col(text_col)).alias("size"), F.greatest(w, F.lit(0.0)).alias("w"), uniform(F.col(id_col), seed).alias("u"))


def _with_odds(rows: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Add certain copies ``whole`` and rank key ``q`` (null: no further copy)."""
    t = targets.withColumnRenamed("src", "t_src")
    x = rows.join(t, rows["src"].eqNullSafe(t["t_src"]))
    e = F.least(F.lit(cap), F.coalesce(F.try_divide(F.col("target") * F.col("w"), F.col("weighted_size")), F.lit(0.0)))
    x = x.withColumn("e", e).withColumn("whole", F.floor("e"))
    p = F.col("e") - F.col("whole")
    odds = F.try_divide(F.col("u") / (1 - F.col("u")), p / (1 - p))
    return x.withColumn("q", F.when((p > 0) & (F.col("size") > 0), odds))


def _border(x: DataFrame) -> DataFrame:
    """Per source the last ``(q, id, size)`` of the sample, from rows with ``q``."""
    key = F.col("q") / (1 + F.col("q"))
    x = x.where("q IS NOT NULL").select("src", "q", "id", "size", F.floor(F.least(key * _CELLS * _CELLS, F.lit(_CELLS * _CELLS - 1.0))).alias("cell"), "rest")
    x = x.select("*", F.floor(F.col("cell") / _CELLS).alias("c1"), (F.col("cell") % _CELLS).alias("c2"))

    def crossing(rows: DataFrame, cell: str) -> DataFrame:
        g = rows.groupBy("src", cell).agg(F.sum("size").alias("s"), F.min("rest").alias("rest"))
        run = Window.partitionBy("src").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)  # at most _CELLS rows
        g = g.withColumn("before", F.coalesce(F.sum("s").over(run), F.lit(0).cast("long"))).where("before <= rest")
        return g.groupBy("src").agg(F.max(cell).alias("at"), F.max_by("before", cell).alias("b"))

    c1 = common.save(crossing(x, "c1"), "mix-cell").withColumnRenamed("src", "k")
    y = x.join(c1, x["src"].eqNullSafe(c1["k"]) & (F.col("c1") == F.col("at"))).select("src", "q", "id", "size", "c2", (F.col("rest") - F.col("b")).alias("rest"))
    c2 = common.save(crossing(y, "c2"), "mix-cell").withColumnRenamed("src", "k")
    z = y.join(c2, y["src"].eqNullSafe(c2["k"]) & (F.col("c2") == F.col("at"))).select("src", "q", "id", "size", (F.col("rest") - F.col("b")).alias("rest"))
    order = Window.partitionBy("src").orderBy("q", F.col("id").asc_nulls_first(), "size")  # the documents of one of 2^24 cells
    run = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    z = z.withColumn("mid", run - F.col("size") / 2)
    last = z.groupBy("src").agg(F.max(F.when(F.col("mid") <= F.col("rest"), F.struct("q", F.col("id").alias("i"), "size"))).alias("last"),
                                F.min("q").alias("first_q"))
    return last.select(F.col("src").alias("b_src"), "last", "first_q")


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
               budget: float = BUDGET, cap: float = CAP, weight_col: str | None = None, seed: str = SEED) -> DataFrame:
    """``(row, id, size, source_size, target, copies)`` for every input row; ``row`` is the
    input row as a struct, so clashing names don't matter.

    A null text has size 0; a document of size 0 gets its certain copies only.  The null
    source is a source, ranked last.  Rows with the same id and size share their rank and
    are taken together; null ids count as one id.  An empty table gives an empty result.
    """
    rows = _ranked(docs, id_col, text_col, source_col, weight_col, seed)
    small = common.save(rows.drop("row"), "mix-sizes")
    targets = source_targets(small, weights, budget, cap)
    rel = small.groupBy(F.col("src").alias("w_src")).agg(F.sum(F.col("size") * F.col("w")).alias("weighted_size"))
    targets = common.save(targets.join(rel, targets["src"].eqNullSafe(rel["w_src"])).drop("w_src"), "mix-targets")
    sure = _with_odds(small, targets, cap).groupBy("src").agg(F.sum(F.col("size") * F.col("whole")).alias("sure")).withColumnRenamed("src", "s_src")
    targets = common.save(targets.join(sure, targets["src"].eqNullSafe(sure["s_src"]), "left").drop("s_src")
                          .withColumn("rest", F.col("target") - F.coalesce("sure", F.lit(0))), "mix-targets")
    border = common.save(_border(_with_odds(small, targets, cap)), "mix-border")
    full = common.save(targets.join(border, targets["src"].eqNullSafe(border["b_src"]), "left").drop("b_src"), "mix-plan")
    out = _with_odds(rows, full, cap)
    last = F.col("last")
    # Strictly inside an earlier cell, or up to the border's row in its own cell.
    own = F.struct("q", F.col("id").alias("i"), "size")
    inside = F.when(last.isNotNull(), own <= last).otherwise(F.col("q") < F.col("first_q"))
    return out.select("row", "id", "size", "source_size", "target", (F.col("whole") + F.when(F.col("q").isNotNull() & inside, 1).otherwise(0)).cast("long").alias("copies"))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``; ``taken`` = size times copies."""
    x = pareto_mix(common.table(spark, sf_dir, "documents"))
    return x.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    x = pareto_mix(docs, **options).where("copies > 0")
    return x.select("row", F.explode(F.expr("sequence(1, int(copies))")).alias("copy")).select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix-1'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST)),
t AS (SELECT source, source_size, least(source_size * 2.0::DOUBLE, max(level) OVER () * weight) AS target FROM l),
e AS (SELECT d.doc_id, d.size, d.u, t.*, floor(CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size) ELSE 0 END) AS whole,
  CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size) ELSE 0 END - floor(CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size) ELSE 0 END) AS p
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q, target - sum(size * whole) OVER (PARTITION BY source) AS rest FROM e),
r AS (SELECT *, sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id NULLS FIRST, size) - size / 2.0::DOUBLE AS mid FROM q)
SELECT doc_id, size, source_size, target::DOUBLE AS target, (size * (whole + CASE WHEN q IS NOT NULL AND mid <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
