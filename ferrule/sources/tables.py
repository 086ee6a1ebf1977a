"""Driver tables and the role each one plays.

The reference works on in-memory arrays that do not ship with it; the driver's
parquet tables stand in for them (see FIXTURES.md):

* ``lineitem``   numeric feature matrix + target (order-free aggregates)
* ``orders``     keyed rows (``o_orderkey`` unique) for folds, masks, samples
* ``embeddings`` flat pose-summary array, 16 joints x (x, y) x (mean, std)
* ``events``     ordered sequences: recording = (user, event type), frame =
                 order of ``ts``, x = ``value``, y = number in ``props``
* ``labels``     truth vs. second rater for classification metrics
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import number_rows

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Exercise codes of the sequence data, in order (E1..E5) and the
# event types standing in for them.
EXERCISE_CODES = ["E1", "E2", "E3", "E4", "E5"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# feature / target roles in lineitem

PROPS_NUMBER = r'"k": (-?[0-9.]+)'


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def missing_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem numeric columns with deterministic holes: discount missing when
    orderkey % 7 == 0, tax missing when orderkey % 11 == 0."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_quantity", "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_orderkey") % 11 == 0, None).otherwise(F.col("l_tax")).alias("l_tax"))


def exercise_code(c: str = "event_type"):
    expr = F.lit(None).cast("string")
    for t, e in zip(EVENT_TYPES, EXERCISE_CODES):
        expr = F.when(F.col(c) == t, F.lit(e)).otherwise(expr)
    return expr


def sequence_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long frame table ``(patient_id, exercise_id, joint, frame, x, y)`` (S3)."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("patient_id"), exercise_code().alias("exercise_id"),
        "ts", "event_id", F.col("value").alias("x"),
        F.regexp_extract("props", PROPS_NUMBER, 1).cast("double").alias("y"))
    framed = number_rows(ev, ["patient_id", "exercise_id"], ["ts", "event_id"], "frame")
    return framed.select("patient_id", "exercise_id", F.lit(0).alias("joint"), "frame", "x", "y")


def group_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-patient label dimension (``user_id % 2``), derived from events."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("patient_id")).distinct().select(
        "patient_id", (F.col("patient_id") % 2).cast("int").alias("label"))


def pose_frame(spark: SparkSession, sf_dir: str, n_groups: int = 14) -> DataFrame:
    """Pose-summary rows (S2): ``row_id, patient_id (1..n_groups), features ARRAY<DOUBLE>, target``."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("row_id"),
                      ((F.col("vec_id") % n_groups) + 1).cast("int").alias("patient_id"),
                      F.col("embedding").cast("array<double>").alias("features"),
                      F.col("label").cast("double").alias("target"))


def pose33_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of 33 joints (132 slots) for the full layout: slot i holds embedding[i mod 64]
    times 1 + i div 64."""
    wide = F.transform(F.sequence(F.lit(0), F.lit(131)), lambda i: F.element_at("features", (i % 64 + 1).cast("int")) * (1 + F.floor(i / 64)))
    return pose_frame(spark, sf_dir).select("row_id", "patient_id", wide.alias("features"), "target")


def exercise_sequence_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multi-joint frame table with a patient and an exercise per recording:
    exercise E1..E5 by recording mod 5, patient = recording div 5."""
    return joint_sequence_frame(spark, sf_dir).withColumns({
        "patient_id": F.floor(F.col("recording") / 5).cast("int"),
        "exercise_id": F.concat(F.lit("E"), (F.col("recording") % 5 + 1).cast("string"))})


# Closed-form regression "models" used to build prediction tables
# (y_pred = l_quantity * factor).
REGRESSION_MODELS = [("qty_x_1500", 1500.0), ("qty_x_2000", 2000.0)]
CANDIDATE_FACTORS = [1000.0, 1250.0, 1500.0, 1750.0, 2000.0]


def regression_predictions(spark: SparkSession, sf_dir: str, models=None) -> DataFrame:
    """Long prediction store ``(model, fold, set, y_true, y_pred)`` over all of lineitem:
    fold = l_linenumber % 5, set = 'val' when l_orderkey % 4 == 0 else 'train'."""
    li = read_table(spark, sf_dir, "lineitem")
    ms = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(a).alias("a")) for m, a in (models or REGRESSION_MODELS)])
    return li.select(F.explode(ms).alias("m"), "l_quantity", "l_extendedprice", "l_linenumber", "l_orderkey").select(
        F.col("m.model").alias("model"), (F.col("l_linenumber") % 5).cast("int").alias("fold"),
        F.when(F.col("l_orderkey") % 4 == 0, "val").otherwise("train").alias("set"),
        F.col("l_extendedprice").alias("y_true"), (F.col("l_quantity") * F.col("m.a")).alias("y_pred"))


def classification_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, fold, row_id, y_true, y_pred)``: quality vs. toxic rater and its inverse."""
    lb = read_table(spark, sf_dir, "labels")
    ms = F.array(F.struct(F.lit("rater").alias("model"), F.col("toxic").alias("p")),
                 F.struct(F.lit("inverse_rater").alias("model"), (1 - F.col("toxic")).alias("p")))
    return lb.select(F.explode(ms).alias("m"), "doc_id", "quality").select(
        F.col("m.model").alias("model"), (F.col("doc_id") % 5).cast("int").alias("fold"),
        F.col("doc_id").alias("row_id"), F.col("quality").alias("y_true"), F.col("m.p").cast("int").alias("y_pred"))


def joint_sequence_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-joint frame table from ``embeddings``: recording = label, frame = order
    of vec_id within the label, joint j = 0..31 with (x, y) = (e[2j], e[2j+1])."""
    emb = read_table(spark, sf_dir, "embeddings").select(
        F.col("label").alias("recording"), "vec_id", F.col("embedding").cast("array<double>").alias("e"))
    framed = number_rows(emb, ["recording"], ["vec_id"], "frame")
    return framed.select("recording", "frame", F.posexplode(F.expr(
        "transform(sequence(0, 31), j -> named_struct('x', e[2 * j], 'y', e[2 * j + 1]))")).alias("joint", "p")) \
        .select("recording", "frame", F.col("joint").cast("int").alias("joint"), F.col("p.x").alias("x"),
                F.col("p.y").alias("y"))


def joint_parts(spark: SparkSession, n_joints: int = 32) -> DataFrame:
    """Body-part dimension built from a rule: part = p<joint div 8>, side = l for even
    joints, r for odd joints (an argument to the part operators)."""
    return spark.range(n_joints).select(F.col("id").cast("int").alias("joint"),
                                        F.concat(F.lit("p"), (F.col("id") / 8).cast("int").cast("string")).alias("part"),
                                        F.when(F.col("id") % 2 == 0, "l").otherwise("r").alias("side"))
