"""Readers and writers for result artifacts.

* candidate results CSV (grid-search style): explicit schema, quoted ``params``
* fixed-width classification-report text: parsed with regular expressions
* trial documents (JSON, one per file): leaderboard of finished trials
* metric-per-iteration traces (TSV): PERMISSIVE read, corrupt lines counted
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def candidate_schema(n_splits: int = 5, params: tuple[str, ...] = ()) -> T.StructType:
    fields = [T.StructField(c, T.DoubleType()) for c in
              ("mean_fit_time", "std_fit_time", "mean_score_time", "std_score_time")]
    fields += [T.StructField(f"param_{p}", T.StringType()) for p in params]
    fields.append(T.StructField("params", T.StringType()))
    fields += [T.StructField(f"split{i}_test_score", T.DoubleType()) for i in range(n_splits)]
    fields += [T.StructField("mean_test_score", T.DoubleType()), T.StructField("std_test_score", T.DoubleType()),
               T.StructField("rank_test_score", T.IntegerType())]
    return T.StructType(fields)


def read_candidates(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Candidate results with an explicit schema (no inference pass)."""
    reader = spark.read.option("header", True).option("escape", '"').option("quote", '"')
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def write_candidates(df: DataFrame, path: str, sep: str = ",", score: str = "mean_test_score") -> None:
    """Sorted by score (descending, distributed range sort), ``,`` or ``;`` separated."""
    df.orderBy(F.desc(score)).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


REPORT_FOLD = r"^fold_(\d+)\s*\|"
REPORT_CLASS = r"^\s*([0-9A-Za-z_.]+|macro avg|weighted avg)\s+([0-9.]+)\s+([0-9.]+)\s+([0-9.]+)\s+(\d+)\s*$"
REPORT_ACCURACY = r"^\s*accuracy\s+([0-9.]+)\s+(\d+)\s*$"


def parse_reports(spark: SparkSession, path: str) -> DataFrame:
    """Fixed-width report text -> ``(file, fold, row, precision, recall, f1, support)``.
    Each file is one row (whole text), split into numbered lines; a line belongs to
    the last ``fold_k |`` header above it (window per file)."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = raw.select("file", F.posexplode(F.split("value", "\n")).alias("ln", "line"))
    lines = lines.withColumn("_fold", F.regexp_extract("line", REPORT_FOLD, 1))
    lines = lines.withColumn("_fold", F.when(F.col("_fold") != "", F.col("_fold").cast("int")))
    w = Window.partitionBy("file").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("fold", F.last("_fold", ignorenulls=True).over(w))
    cls = lines.where(F.col("line").rlike(REPORT_CLASS)).select(
        "file", "fold", F.regexp_extract("line", REPORT_CLASS, 1).alias("row"),
        *[F.regexp_extract("line", REPORT_CLASS, k).cast("double").alias(n)
          for k, n in ((2, "precision"), (3, "recall"), (4, "f1"))],
        F.regexp_extract("line", REPORT_CLASS, 5).cast("double").alias("support"))
    acc = lines.where(F.col("line").rlike(REPORT_ACCURACY)).select(
        "file", "fold", F.lit("accuracy").alias("row"),
        *[F.regexp_extract("line", REPORT_ACCURACY, 1).cast("double").alias(n) for n in ("precision", "recall", "f1")],
        F.regexp_extract("line", REPORT_ACCURACY, 2).cast("double").alias("support"))
    return cls.unionByName(acc).where(F.col("fold").isNotNull())


def report_text(report: DataFrame, keys: tuple[str, ...] = ("fold",)) -> DataFrame:
    """One fixed-width text line per report row (write with ``.write.text``)."""
    return report.select(*keys, "row", F.format_string("%12s %9.3f %9.3f %9.3f %9d", F.col("row"),
                                                       F.col("precision"), F.col("recall"), F.col("f1"),
                                                       F.col("support").cast("int")).alias("line"))


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial documents -> ``(trial_id, status, score, best_step, values)``; FAILED
    and RUNNING trials keep a NULL score."""
    raw = spark.read.option("multiLine", True).json(path)
    vals = F.to_json(F.col("hyperparameters.values"))
    return raw.select("trial_id", "status", F.col("score").cast("double").alias("score"),
                      F.col("best_step").cast("long").alias("best_step"),
                      F.from_json(vals, T.MapType(T.StringType(), T.StringType())).alias("values"))


def trial_leaderboard(trials: DataFrame, k: int = 10) -> DataFrame:
    """Completed trials ranked by score (descending), top k."""
    done = trials.where(F.col("score").isNotNull())
    return done.withColumn("rank", F.rank().over(Window.orderBy(F.desc("score")))).where(F.col("rank") <= k)


NUMBER = r"^-?[0-9]+(\.[0-9]*)?([eE][-+]?[0-9]+)?$"


def read_trace(spark: SparkSession, path: str, metrics: tuple[str, ...]) -> DataFrame:
    """TSV trace ``iter, metric...``.  A line is kept only when it has exactly
    1 + len(metrics) tab-separated numeric fields; other lines (e.g. two writers'
    lines run together) keep their text in ``_corrupt_record`` with NULL values.
    (The CSV reader's PERMISSIVE mode silently drops extra fields, so the check is
    done on the text.)"""
    raw = spark.read.text(path).where(~F.col("value").startswith("iter") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    width = 1 + len(metrics)
    good = (F.size(f) == width) & F.forall(f, lambda x: x.rlike(NUMBER))
    return raw.select(F.when(good, f[0].cast("int")).alias("iter"),
                      *[F.when(good, f[k + 1].cast("double")).alias(m) for k, m in enumerate(metrics)],
                      F.when(~good, F.col("value")).alias("_corrupt_record"))


def best_iteration(trace: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """Best iteration of a metric over the clean lines (earliest on ties) and the
    number of rejected lines, in one aggregate."""
    clean = F.col("_corrupt_record").isNull() & F.col(metric).isNotNull()
    key = F.struct(F.col(metric), -F.col("iter")) if maximize else F.struct(-F.col(metric), -F.col("iter"))
    return trace.agg(F.max_by("iter", F.when(clean, key)).alias("best_iter"),
                     (F.max if maximize else F.min)(F.when(clean, F.col(metric))).alias("best_value"),
                     F.count_if(F.col("_corrupt_record").isNotNull()).alias("n_rejected"))
