"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables of ``sf_dir`` whole; results are rounded
(6 decimals unless noted) on both sides so engine summation order does not
change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_all
from ..operators import sequence as seq
from ..operators.ordering import attach_group
from ..sources import tables
from . import sql_fragments as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEYS = ["patient_id", "exercise_id", "joint"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- sequences

@register("seq_path_length", f"""WITH {S.STEPS_CTE}
SELECT patient_id, exercise_id, joint, count(*) AS n_frames, round(sum(step), 6) AS path_length
FROM steps GROUP BY ALL""")
def q_seq_path_length(spark, d):
    s = seq.motion_steps(tables.sequence_frame(spark, d), KEYS)
    return round_all(s.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_frames"),
                                          F.sum("step").alias("path_length")))


MOTION_SQL = f"""WITH {S.STEPS_CTE}
SELECT patient_id, exercise_id, joint, n_frames, round(path_length, 6) AS path_length,
       round(path_length / n_frames, 6) AS speed_per_frame,
       round(coalesce(mstep, 0), 6) AS speed_mean,
       round(amp_x, 6) AS amp_x, round(amp_y, 6) AS amp_y, round(amp_x + amp_y, 6) AS amplitude,
       direction_changes, orientation_changes, round(jitter_mean, 6) AS jitter_mean,
       round(coalesce(path_length / nullif(2 * amp_y, 0), 0), 6) AS path_norm_2amp,
       round(path_length / CASE WHEN amp_y = 0 THEN 1 ELSE amp_y END, 6) AS path_norm_amp,
       round(coalesce(2 * amp_y / nullif(path_length, 0), 0), 6) AS amp_norm_path
FROM (SELECT patient_id, exercise_id, joint, count(*) AS n_frames, sum(step) AS path_length,
             avg(step) FILTER (WHERE has_prev) AS mstep,
             max(x) - min(x) AS amp_x, max(y) - min(y) AS amp_y,
             count(*) FILTER (WHERE least(dangle, 2 * pi() - dangle) > 0.5) AS direction_changes,
             count(*) FILTER (WHERE dangle > pi() / 4) AS orientation_changes,
             avg(jitter) AS jitter_mean
      FROM steps GROUP BY ALL) t"""


@register("seq_motion_features", MOTION_SQL)
def q_seq_motion_features(spark, d):
    return round_all(seq.motion_features(tables.sequence_frame(spark, d), KEYS))


@register("seq_step_table", f"""WITH {S.STEPS_CTE}
SELECT patient_id, exercise_id, joint, frame, round(dx, 6) AS dx, round(dy, 6) AS dy,
       round(step, 6) AS step FROM steps""")
def q_seq_step_table(spark, d):
    return round_all(seq.step_table(tables.sequence_frame(spark, d), KEYS))


@register("seq_steps_without_first", f"""WITH {S.STEPS_CTE}
SELECT patient_id, exercise_id, joint, frame, round(dx, 6) AS dx, round(dy, 6) AS dy,
       round(step, 6) AS step FROM steps WHERE has_prev""")
def q_seq_steps_without_first(spark, d):
    return round_all(seq.step_table(tables.sequence_frame(spark, d), KEYS, include_first=False))


@register("seq_moving_average", f"""WITH {S.STEPS_CTE}
SELECT patient_id, exercise_id, joint, frame, round(sx, 6) AS x_ma4, round(jitter, 6) AS jitter
FROM steps""")
def q_seq_moving_average(spark, d):
    s = seq.motion_steps(tables.sequence_frame(spark, d), KEYS)
    return round_all(s.select(*KEYS, "frame", F.col("sx").alias("x_ma4"), "jitter"))


@register("seq_sign_flips_1d", f"""WITH {S.SEQ_CTE},
d AS (SELECT patient_id, exercise_id, joint, frame,
             sign(x - lag(x) OVER (PARTITION BY patient_id, exercise_id, joint ORDER BY frame)) AS sg
      FROM seq),
nz AS (SELECT *, lag(sg) OVER (PARTITION BY patient_id, exercise_id, joint ORDER BY frame) AS prev
       FROM d WHERE sg IS NOT NULL AND sg <> 0),
f AS (SELECT patient_id, exercise_id, joint, count(*) FILTER (WHERE prev IS NOT NULL AND prev <> sg) AS c
      FROM nz GROUP BY ALL)
SELECT k.patient_id, k.exercise_id, k.joint, coalesce(f.c, 0) AS sign_flips
FROM (SELECT DISTINCT patient_id, exercise_id, joint FROM seq) k
LEFT JOIN f USING (patient_id, exercise_id, joint)""")
def q_seq_sign_flips_1d(spark, d):
    return seq.sign_flips_1d(tables.sequence_frame(spark, d), KEYS)


@register("seq_frame_position", f"""WITH {S.SEQ_CTE}
SELECT patient_id, exercise_id, joint, frame,
       round(coalesce(frame / nullif(max(frame) OVER (PARTITION BY patient_id, exercise_id, joint), 0), 0), 6)
         AS t_norm
FROM seq""")
def q_seq_frame_position(spark, d):
    f = seq.frame_position(tables.sequence_frame(spark, d), KEYS)
    return round_all(f.select(*KEYS, "frame", "t_norm"))


@register("seq_patient_exercise_matrix", f"""WITH {S.STEPS_CTE},
f AS (SELECT patient_id, exercise_id, sum(step) AS path_length, max(x) - min(x) AS amp_x
      FROM steps GROUP BY ALL)
SELECT p.patient_id,
  {", ".join(f"coalesce(c{i}.n, 0) AS E{i}_count, CAST(coalesce(c{i}.n, 0) > 0 AS INTEGER) AS E{i}_present, "
             f"round(coalesce(c{i}.path_length, 0), 6) AS E{i}_path_length, round(coalesce(c{i}.amp_x, 0), 6) AS E{i}_amp_x"
             for i in range(1, 6))}
FROM (SELECT DISTINCT patient_id FROM f) p
{" ".join(f"LEFT JOIN (SELECT patient_id, count(*) AS n, avg(path_length) AS path_length, avg(amp_x) AS amp_x "
          f"FROM f WHERE exercise_id = 'E{i}' GROUP BY ALL) c{i} ON c{i}.patient_id = p.patient_id"
          for i in range(1, 6))}""")
def q_seq_patient_exercise_matrix(spark, d):
    f = seq.motion_features(tables.sequence_frame(spark, d), KEYS)
    m = seq.patient_exercise_matrix(f, "patient_id", "exercise_id", tables.EXERCISE_CODES,
                                    ["path_length", "amp_x"])
    return round_all(m)


FLAGSHIP_SQL = f"""WITH {S.STEPS_CTE},
feat AS (SELECT patient_id, exercise_id, coalesce(avg(step) FILTER (WHERE has_prev), 0) AS speed_mean
         FROM steps GROUP BY ALL),
thr AS (SELECT quantile_cont(speed_mean, 0.5) AS m FROM feat),
pred AS (SELECT patient_id, CAST(speed_mean > m AS INTEGER) AS pred FROM feat, thr),
pc AS (SELECT patient_id, pred, count(*) AS c FROM pred GROUP BY ALL),
vote AS (SELECT patient_id, pred AS vote FROM (
           SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY c DESC, pred) AS r FROM pc) WHERE r = 1),
nrec AS (SELECT patient_id, count(*) AS n_recordings FROM feat GROUP BY ALL),
lab AS (SELECT DISTINCT user_id AS patient_id, CAST(user_id % 2 AS INTEGER) AS label FROM events),
g AS (SELECT patient_id, label, row_number() OVER (PARTITION BY label
           ORDER BY {S.portable_hash_sql('patient_id')}, patient_id) - 1 AS rn FROM lab)
SELECT g.patient_id, g.label, CAST(g.rn % 5 AS INTEGER) AS fold, v.vote, nrec.n_recordings,
       v.vote = g.label AS correct
FROM g JOIN vote v USING (patient_id) JOIN nrec USING (patient_id)"""


@register("flagship_group_vote", FLAGSHIP_SQL)
def q_flagship_group_vote(spark, d):
    from ..operators import folds, quantile
    from ..operators.profile import attach_row
    from ..storage import save
    # The features are needed for the median and for the votes: computed once.
    feats = save(seq.motion_features(tables.sequence_frame(spark, d), KEYS).select("patient_id", "exercise_id", "speed_mean"), "flagship")
    med = quantile.quantiles_long(feats.select(F.col("speed_mean").alias("value")), [], [0.5])
    preds = attach_row(feats, med.select(F.col("quantile").alias("_m"))).select(
        "patient_id", (F.col("speed_mean") > F.col("_m")).cast("int").alias("pred"))
    counts = preds.groupBy("patient_id", "pred").agg(F.count(F.lit(1)).alias("c"))
    votes = counts.groupBy("patient_id").agg(F.min_by("pred", F.struct(-F.col("c"), F.col("pred"))).alias("vote"),
                                             F.sum("c").alias("n_recordings"))
    fold = folds.strict_group_folds(tables.group_labels(spark, d), "patient_id", "label", k=5)
    return attach_group(fold, votes, ["patient_id"]).select("patient_id", "label", "fold", "vote", "n_recordings",
                                                            (F.col("vote") == F.col("label")).alias("correct"))


# --------------------------------------------------------------------------- folds

def _orders(spark, d):
    return tables.read_table(spark, d, "orders")


H_ORDER = S.portable_hash_sql("o_orderkey")


@register("fold_kfold", f"""WITH r AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY {H_ORDER}, o_orderkey) - 1 AS rn, count(*) OVER () AS n
  FROM orders)
SELECT o_orderkey, CAST(CASE WHEN rn < (n % 5) * (n // 5 + 1) THEN rn // (n // 5 + 1)
                        ELSE (n % 5) + (rn - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold
FROM r""")
def q_fold_kfold(spark, d):
    from ..operators import folds
    return folds.kfold(_orders(spark, d).select("o_orderkey"), "o_orderkey", 5)


@register("fold_train_test_stratified", f"""WITH r AS (
  SELECT o_orderkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY {H_ORDER}, o_orderkey) - 1 AS rn,
         count(*) OVER (PARTITION BY o_orderpriority) AS n
  FROM orders)
SELECT o_orderkey, o_orderpriority, CASE WHEN rn < ceil(n * 0.2) THEN 'test' ELSE 'train' END AS set FROM r""")
def q_fold_train_test_stratified(spark, d):
    from ..operators import folds
    return folds.train_test_split(_orders(spark, d).select("o_orderkey", "o_orderpriority"),
                                  "o_orderkey", 0.2, stratify="o_orderpriority")


@register("fold_stratified_kfold", f"""SELECT o_orderkey, o_orderpriority,
  CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {H_ORDER}, o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def q_fold_stratified_kfold(spark, d):
    from ..operators import folds
    return folds.stratified_kfold(_orders(spark, d).select("o_orderkey", "o_orderpriority"),
                                  "o_orderkey", "o_orderpriority", 5)


GROUP_LABEL_SQL = """gl AS (
  SELECT o_custkey, o_orderpriority AS gl FROM (
    SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY c DESC, o_orderpriority) AS r
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS c FROM orders GROUP BY ALL) x) y WHERE r = 1)"""


@register("fold_strict_group", f"""WITH {GROUP_LABEL_SQL},
g AS (SELECT o_custkey, CAST((row_number() OVER (PARTITION BY gl ORDER BY {S.portable_hash_sql('o_custkey')}, o_custkey) - 1) % 5 AS INTEGER) AS fold FROM gl)
SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, g.fold FROM orders o JOIN g USING (o_custkey)""")
def q_fold_strict_group(spark, d):
    from ..operators import folds
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_orderpriority")
    return folds.strict_group_folds(o, "o_custkey", "o_orderpriority", 5)


@register("fold_group_majority_label", f"""WITH {GROUP_LABEL_SQL} SELECT o_custkey, gl AS group_label FROM gl""")
def q_fold_group_majority_label(spark, d):
    from ..operators import folds
    return folds.majority_label(_orders(spark, d), "o_custkey", "o_orderpriority")


@register("fold_stratified_group_kfold", f"""WITH {GROUP_LABEL_SQL},
sz AS (SELECT o_custkey, count(*) AS size FROM orders GROUP BY ALL),
g AS (SELECT o_custkey, CAST((row_number() OVER (PARTITION BY gl ORDER BY size DESC,
        {S.portable_hash_sql('o_custkey')}, o_custkey) - 1) % 5 AS INTEGER) AS fold FROM gl JOIN sz USING (o_custkey))
SELECT o.o_orderkey, o.o_custkey, g.fold FROM orders o JOIN g USING (o_custkey)""")
def q_fold_stratified_group_kfold(spark, d):
    from ..operators import folds
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_orderpriority")
    return folds.stratified_group_kfold(o, "o_custkey", "o_orderpriority", 5).drop("o_orderpriority")


@register("fold_leave_one_group_out", """SELECT o_orderkey, c_nationkey,
  CAST(dense_rank() OVER (ORDER BY c_nationkey) - 1 AS INTEGER) AS fold
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_fold_leave_one_group_out(spark, d):
    from ..operators import folds
    o = _orders(spark, d).join(tables.read_table(spark, d, "customer"),
                               F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    return folds.leave_one_group_out(o, "c_nationkey")


@register("fold_nested_group", f"""WITH {GROUP_LABEL_SQL},
h AS (SELECT o_custkey, gl, {S.portable_hash_sql('o_custkey')} AS h,
        (row_number() OVER (PARTITION BY gl ORDER BY {S.portable_hash_sql('o_custkey')}, o_custkey) - 1) % 3 AS outer_fold
      FROM gl),
x AS (SELECT o.o, h.* FROM h, (SELECT unnest(range(3)) AS o) o WHERE o.o <> h.outer_fold)
SELECT CAST(o AS INTEGER) AS outer_fold, o_custkey,
       CAST((row_number() OVER (PARTITION BY o, gl ORDER BY h, o_custkey) - 1) % 4 AS INTEGER) AS inner_fold
FROM x""")
def q_fold_nested_group(spark, d):
    from ..operators import folds
    return folds.nested_group_folds(_orders(spark, d), "o_custkey", "o_orderpriority", 3, 4)


@register("fold_audit", f"""WITH {GROUP_LABEL_SQL},
g AS (SELECT o_custkey, (row_number() OVER (PARTITION BY gl ORDER BY {S.portable_hash_sql('o_custkey')}, o_custkey) - 1) % 5 AS fold FROM gl),
r AS (SELECT o.o_custkey, o.o_orderpriority, g.fold FROM orders o JOIN g USING (o_custkey)),
s AS (SELECT f.f, r.*, CASE WHEN r.fold = f.f THEN 'test' ELSE 'train' END AS side
      FROM r, (SELECT unnest(range(5)) AS f) f)
SELECT CAST(f AS INTEGER) AS fold, side, o_orderpriority, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_groups
FROM s GROUP BY ALL""")
def q_fold_audit(spark, d):
    from ..operators import folds
    o = folds.strict_group_folds(_orders(spark, d), "o_custkey", "o_orderpriority", 5)
    return folds.fold_audit(o, "fold", "o_custkey", "o_orderpriority", 5)


@register("fold_class_weights", """SELECT o_orderpriority, count(*) AS n_c,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS class_weight
FROM orders GROUP BY ALL""")
def q_fold_class_weights(spark, d):
    from ..operators import folds
    return round_all(folds.balanced_class_weights(_orders(spark, d), "o_orderpriority"))


# --------------------------------------------------------------------------- profiling

LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MISS_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li(spark, d):
    return tables.read_table(spark, d, "lineitem")


def _union_cols(cols, template):
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


def _q(c, p, src="lineitem"):
    return f"(SELECT quantile_cont({c}, {p}) FROM {src})"


@register("prof_iqr_bounds", _union_cols(LI_COLS, """SELECT '{c}' AS column, round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q3 - q1, 6) AS iqr, round(q1 - 3 * (q3 - q1), 6) AS lower, round(q3 + 3 * (q3 - q1), 6) AS upper
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""))
def q_prof_iqr_bounds(spark, d):
    from ..operators import profile
    return round_all(profile.iqr_bounds(_li(spark, d), LI_COLS, 3.0))


def _fence_sql(cols, m, src):
    parts = []
    for c in cols:
        q1, q3 = _q(c, 0.25, src), _q(c, 0.75, src)
        parts.append(f"coalesce({c} >= {q1} - {m} * ({q3} - {q1}) AND {c} <= {q3} + {m} * ({q3} - {q1}), false)")
    return " AND ".join(parts)


@register("prof_iqr_outlier_rows", f"""WITH {S.MISSING_CTE}
SELECT * FROM miss WHERE NOT ({_fence_sql(MISS_COLS, 3.0, 'miss')})""")
def q_prof_iqr_outlier_rows(spark, d):
    from ..operators import profile
    _, out = profile.iqr_split(tables.missing_frame(spark, d), MISS_COLS, 3.0)
    return out


@register("prof_iqr_inlier_count", f"""WITH {S.MISSING_CTE}
SELECT ({_fence_sql(MISS_COLS, 1.5, 'miss')}) AS inlier, count(*) AS n_rows FROM miss GROUP BY ALL""")
def q_prof_iqr_inlier_count(spark, d):
    from ..operators import profile
    f = profile.iqr_flag(tables.missing_frame(spark, d), MISS_COLS, 1.5)
    return f.groupBy("inlier").agg(F.count(F.lit(1)).alias("n_rows"))


def _sweep_sql():
    from ..operators.profile import IQR_MULTIPLIERS
    rows = []
    for m in IQR_MULTIPLIERS:
        rows.append(f"""SELECT CAST({float(m)} AS DOUBLE) AS multiplier, count(*) FILTER (WHERE NOT ({_fence_sql(LI_COLS, float(m), 'lineitem')})) AS n_outliers,
  round(count(*) FILTER (WHERE NOT ({_fence_sql(LI_COLS, float(m), 'lineitem')})) / count(*), 6) AS share FROM lineitem""")
    return "\nUNION ALL\n".join(rows)


@register("prof_iqr_sweep", _sweep_sql())
def q_prof_iqr_sweep(spark, d):
    from ..operators import profile
    return round_all(profile.iqr_sweep(_li(spark, d), LI_COLS))


@register("prof_spread_ratio", _union_cols(LI_COLS, """SELECT '{c}' AS column,
  round(stddev_samp({c}) / nullif(quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05), 0), 6) AS spread_ratio FROM lineitem"""))
def q_prof_spread_ratio(spark, d):
    from ..operators import profile
    return round_all(profile.spread_ratio(_li(spark, d), LI_COLS))


@register("prof_coefficient_of_variation", _union_cols(LI_COLS, """SELECT '{c}' AS column,
  round(stddev_samp({c}) / nullif(abs(avg({c})), 0), 6) AS cv FROM lineitem"""))
def q_prof_cv(spark, d):
    from ..operators import profile
    return round_all(profile.coefficient_of_variation(_li(spark, d), LI_COLS))


@register("prof_describe", f"""WITH {S.MISSING_CTE}
""" + _union_cols(MISS_COLS, """SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75 FROM miss"""))
def q_prof_describe(spark, d):
    from ..operators import profile
    return round_all(profile.describe(tables.missing_frame(spark, d), MISS_COLS))


@register("prof_missing_rates", f"""WITH {S.MISSING_CTE}
""" + _union_cols(MISS_COLS, """SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
  round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS missing_rate FROM miss"""))
def q_prof_missing_rates(spark, d):
    from ..operators import profile
    return round_all(profile.missing_rates(tables.missing_frame(spark, d), MISS_COLS))


@register("prof_missing_patterns", f"""WITH {S.MISSING_CTE}
SELECT {" || ".join(f"CAST(CAST({c} IS NULL AS INTEGER) AS VARCHAR)" for c in MISS_COLS)} AS pattern,
       count(*) AS n_rows FROM miss GROUP BY ALL""")
def q_prof_missing_patterns(spark, d):
    from ..operators import profile
    return profile.missing_patterns(tables.missing_frame(spark, d), MISS_COLS)


HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("prof_shared_histogram", f"""WITH long AS (
  {_union_cols(HIST_COLS, "SELECT '{c}' AS column, {c} AS value FROM lineitem WHERE {c} IS NOT NULL")}),
rng AS (SELECT min(value) AS lo, max(value) AS hi, CAST(floor(max(value) - min(value)) + 1 AS INTEGER) AS nb FROM long),
cnt AS (SELECT "column", CAST(least(coalesce(floor((value - lo) / nullif((hi - lo) / nb, 0)), 0), nb - 1) AS INTEGER) AS bin,
               count(*) AS c FROM long, rng GROUP BY ALL),
grid AS (SELECT c."column", CAST(b.bin AS INTEGER) AS bin FROM (SELECT DISTINCT "column" FROM long) c,
         (SELECT unnest(range(nb)) AS bin FROM rng) b)
SELECT g."column", g.bin, round(lo + g.bin * (hi - lo) / nb, 6) AS bin_lo, round(lo + (g.bin + 1) * (hi - lo) / nb, 6) AS bin_hi,
       coalesce(cnt.c, 0) AS count
FROM grid g CROSS JOIN rng LEFT JOIN cnt ON cnt."column" = g."column" AND cnt.bin = g.bin""")
def q_prof_shared_histogram(spark, d):
    from ..operators import profile
    return round_all(profile.shared_histogram(_li(spark, d), HIST_COLS))


@register("prof_class_quantiles", _union_cols(LI_COLS, """SELECT l_returnflag, '{c}' AS column,
  round(quantile_cont({c}, 0.0), 6) AS q0, round(quantile_cont({c}, 0.25), 6) AS q25,
  round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
  round(quantile_cont({c}, 1.0), 6) AS q100 FROM lineitem GROUP BY l_returnflag"""))
def q_prof_class_quantiles(spark, d):
    from ..operators import profile
    return round_all(profile.class_quantile_summary(_li(spark, d), LI_COLS, ["l_returnflag"]))


@register("prof_trimmed_mean", _union_cols(LI_COLS, """SELECT '{c}' AS column, round(avg(v), 6) AS trimmed_mean FROM (
  SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS r, count(*) OVER () AS n FROM lineitem WHERE {c} IS NOT NULL)
WHERE r >= floor(n * 0.1) AND r < n - floor(n * 0.1)"""))
def q_prof_trimmed_mean(spark, d):
    from ..operators import profile
    return round_all(profile.trimmed_mean(_li(spark, d), LI_COLS, 0.1))


@register("prof_bounding_box", f"""WITH {S.JSEQ_CTE}
SELECT round(least(min(x), min(y)) * 1.1, 6) AS box_min, round(greatest(max(x), max(y)) * 1.1, 6) AS box_max FROM jseq""")
def q_prof_bounding_box(spark, d):
    from ..operators import profile
    return round_all(profile.bounding_box(tables.joint_sequence_frame(spark, d), ["x"], ["y"], 0.1))


NC_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@register("prof_near_constant", _union_cols(NC_COLS, """SELECT "column", round(range, 6) AS range, round(zero_share, 6) AS zero_share,
  round(median, 6) AS median, round(mad, 6) AS mad, round(dominant_share, 6) AS dominant_share,
  (range = 0 OR zero_share >= 0.95 OR mad <= 1e-12 OR mad / (abs(median) + 1e-12) <= 0.001 OR dominant_share >= 0.95) AS drop
FROM (SELECT '{c}' AS column, max({c}) - min({c}) AS range,
        count(*) FILTER (WHERE {c} = 0) / count(*) AS zero_share,
        quantile_cont({c}, 0.5) AS median,
        (SELECT quantile_cont(abs({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)), 0.5) FROM lineitem) AS mad,
        (SELECT max(c) FROM (SELECT count(*) AS c FROM lineitem GROUP BY {c})) / count(*) AS dominant_share
      FROM lineitem)"""))
def q_prof_near_constant(spark, d):
    from ..operators import profile
    st = profile.near_constant_stats(_li(spark, d), NC_COLS)
    dec = profile.near_constant_filter(st, exact_dominant=True)
    return round_all(st.join(dec, "column"))


# --------------------------------------------------------------------------- selection & scaling

SEL_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs_sql(cols, src="lineitem", by=None, digits=6):
    import itertools
    parts = []
    rnd = (lambda e: f"round({e}, {digits})") if digits else (lambda e: e)
    for i, j in itertools.combinations(range(len(cols)), 2):
        g = f"{by}, " if by else ""
        parts.append(f"SELECT {g}{i} AS i, {j} AS j, '{cols[i]}' AS a, '{cols[j]}' AS b, "
                     f"""{rnd(f'corr("{cols[i]}", "{cols[j]}")')} AS corr, {rnd(f'abs(corr("{cols[i]}", "{cols[j]}"))')} AS abs_corr """
                     f"FROM {src}" + (f" GROUP BY {by}" if by else ""))
    return "\nUNION ALL\n".join(parts)


@register("sel_corr_pairs", _pairs_sql(SEL_COLS))
def q_sel_corr_pairs(spark, d):
    from ..operators import select
    return round_all(select.corr_pairs(_li(spark, d), SEL_COLS))


@register("sel_corr_pairs_by_class", _pairs_sql(SEL_COLS, by="l_returnflag"))
def q_sel_corr_pairs_by_class(spark, d):
    from ..operators import select
    return round_all(select.corr_pairs(_li(spark, d), SEL_COLS, by=["l_returnflag"]))


POLY_COLS = ["l_quantity", "l_discount", "l_tax"]


def _poly_sql(degree=2):
    from ..operators.select import polynomial_terms
    return ", ".join(f'{" * ".join(combo)} AS "{name}"' for name, combo in polynomial_terms(POLY_COLS, degree))


@register("sel_drop_correlated", f"""WITH p AS (SELECT {_poly_sql()}, l_extendedprice FROM lineitem),
pairs AS ({_pairs_sql([n for n, _ in __import__('ferrule.operators.select', fromlist=['x']).polynomial_terms(POLY_COLS, 2)], 'p', digits=None)})
SELECT DISTINCT b AS "column", j AS position FROM pairs WHERE abs_corr > 0.9""")
def q_sel_drop_correlated(spark, d):
    from ..operators import select
    poly = select.polynomial_features(_li(spark, d), POLY_COLS, 2)
    names = [n for n, _ in select.polynomial_terms(POLY_COLS, 2)]
    return select.drop_highly_correlated(select.corr_pairs(poly, [f"`{n}`" for n in names]), 0.9)


def _target_corr_sql(cols, target, src, digits=6):
    rnd = (lambda e: f"round({e}, {digits})") if digits else (lambda e: e)
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column, {rnd(f'corr({c}, {target})')} AS corr, "
                                f"{rnd(f'abs(corr({c}, {target}))')} AS abs_corr FROM {src}" for c in cols)


@register("sel_target_corr", _target_corr_sql(["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "lineitem"))
def q_sel_target_corr(spark, d):
    from ..operators import select
    return round_all(select.corr_with_target(_li(spark, d), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"))


@register("sel_keep_target_correlated", f"""WITH t AS ({_target_corr_sql(["l_quantity", "l_discount", "l_tax"], "l_extendedprice * (1 + l_tax)", "lineitem", None)})
SELECT "column" FROM t WHERE abs_corr > 0.01""")
def q_sel_keep_target_correlated(spark, d):
    from ..operators import select
    li = _li(spark, d).withColumn("charge", F.col("l_extendedprice") * (1 + F.col("l_tax")))
    return select.keep_target_correlated(select.corr_with_target(li, ["l_quantity", "l_discount", "l_tax"], "charge"), 0.01)


@register("sel_target_threshold_counts", f"""WITH t AS ({_target_corr_sql(["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "lineitem", None)})
""" + "\nUNION ALL\n".join(f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE abs_corr < {t}) AS n_features FROM t"
                           for t in [0.01, 0.05, 0.1, 1.0]))
def q_sel_target_threshold_counts(spark, d):
    from ..operators import select
    tc = select.corr_with_target(_li(spark, d), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return select.target_threshold_counts(tc)


@register("sel_pair_threshold_counts", f"""WITH t AS ({_pairs_sql(SEL_COLS, digits=None)})
""" + "\nUNION ALL\n".join(f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE abs_corr > {t}) AS n_pairs FROM t"
                           for t in [0.99, 0.95, 0.9, 0.5, 0.0]))
def q_sel_pair_threshold_counts(spark, d):
    from ..operators import select
    return select.pair_threshold_counts(select.corr_pairs(_li(spark, d), SEL_COLS))


@register("sel_weak_pairs", f"""WITH t AS ({_pairs_sql(SEL_COLS, digits=None)}) SELECT a, b, round(abs_corr, 6) AS abs_corr FROM t WHERE abs_corr < 0.5""")
def q_sel_weak_pairs(spark, d):
    from ..operators import select
    return round_all(select.weak_pairs(select.corr_pairs(_li(spark, d), SEL_COLS), 0.5))


def _poly3_target_sql():
    from ..operators.select import polynomial_terms
    terms = polynomial_terms(POLY_COLS, 3)
    body = ", ".join(f'{" * ".join(c)} AS "{n}"' for n, c in terms)
    corr = "\nUNION ALL\n".join(f"""SELECT '{n}' AS name, abs(corr("{n}", l_extendedprice)) AS score FROM p"""
                                for n, _ in terms)
    return f"WITH p AS (SELECT {body}, l_extendedprice FROM lineitem), items AS ({corr})"


@register("sel_dominant_sets", _poly3_target_sql() + """
SELECT i.name, round(i.score, 6) AS score FROM items i WHERE NOT EXISTS (
  SELECT 1 FROM items j WHERE j.name <> i.name AND j.score > i.score
    AND list_has_all(string_split(i.name, ' '), string_split(j.name, ' ')))""")
def q_sel_dominant_sets(spark, d):
    from ..operators import select
    terms = select.polynomial_terms(POLY_COLS, 3)
    poly = select.polynomial_features(_li(spark, d), POLY_COLS, 3, keep=["l_extendedprice"])
    tc = select.corr_with_target(poly, [f"`{n}`" for n, _ in terms], "l_extendedprice")
    items = tc.select(F.regexp_replace("column", "`", "").alias("name"), F.col("abs_corr").alias("score"))
    return round_all(select.dominant_sets(items, "name", "score"))


@register("sel_covariance", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 4) AS cov FROM lineitem"
    for i, a in enumerate(SEL_COLS) for b in SEL_COLS[i:]))
def q_sel_covariance(spark, d):
    from ..operators import select
    return round_all(select.covariance_pairs(_li(spark, d), SEL_COLS), 4)


@register("sel_standardized_covariance", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round({('corr(' + a + ', ' + b + ')') if a != b else '1.0'} * count(*) / (count(*) - 1), 6) AS cov "
    f"FROM lineitem" for i, a in enumerate(SEL_COLS) for b in SEL_COLS[i:]))
def q_sel_standardized_covariance(spark, d):
    from ..operators import select
    return round_all(select.standardized_covariance(_li(spark, d), SEL_COLS))


def _mi_sql(cols, target, bins=10):
    feats = cols + [target]
    edges = ", ".join(f"list_sort([{', '.join(f'quantile_cont({c}, {k / bins})' for k in range(1, bins))}]) AS e_{c}"
                      for c in feats)
    binned = lambda c: f"len(list_filter(e_{c}, lambda e: e < {c}))"
    longs = "\nUNION ALL\n".join(f"SELECT '{c}' AS column, {binned(c)} AS bx, {binned(target)} AS bb FROM lineitem, edges"
                                 for c in cols)
    return f"""WITH edges AS (SELECT {edges} FROM lineitem),
long AS ({longs}),
j AS (SELECT "column", bx, bb, count(*) AS nxy FROM long GROUP BY ALL),
mx AS (SELECT "column", bx, sum(nxy) AS nx FROM j GROUP BY ALL),
my AS (SELECT "column", bb, sum(nxy) AS ny FROM j GROUP BY ALL),
n AS (SELECT "column", sum(nxy) AS n FROM j GROUP BY ALL)
SELECT j."column", round(sum((nxy / n) * ln((nxy * n) / (nx * ny))), 6) AS mutual_information
FROM j JOIN mx USING ("column", bx) JOIN my USING ("column", bb) JOIN n USING ("column") GROUP BY ALL"""


@register("sel_mutual_information", _mi_sql(["l_quantity", "l_discount", "l_tax"], "l_extendedprice"))
def q_sel_mutual_information(spark, d):
    from ..operators import select
    return round_all(select.binned_mutual_information(_li(spark, d), ["l_quantity", "l_discount", "l_tax"],
                                                      "l_extendedprice", 10))


@register("scale_standardize", """SELECT round((l_quantity - avg(l_quantity) OVER ()) / nullif(stddev_pop(l_quantity) OVER (), 0), 6) AS l_quantity,
  round((l_discount - avg(l_discount) OVER ()) / nullif(stddev_pop(l_discount) OVER (), 0), 6) AS l_discount,
  round((l_tax - avg(l_tax) OVER ()) / nullif(stddev_pop(l_tax) OVER (), 0), 6) AS l_tax FROM lineitem""")
def q_scale_standardize(spark, d):
    from ..operators import scale
    return round_all(scale.standardize(_li(spark, d).select("l_quantity", "l_discount", "l_tax"),
                                       ["l_quantity", "l_discount", "l_tax"]))


@register("scale_robust", "SELECT " + ", ".join(
    f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / (SELECT CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1 "
    f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM lineitem), 6) AS {c}"
    for c in ["l_quantity", "l_extendedprice", "l_tax"]) + " FROM lineitem")
def q_scale_robust(spark, d):
    from ..operators import scale
    cols = ["l_quantity", "l_extendedprice", "l_tax"]
    return round_all(scale.robust_scale(_li(spark, d).select(*cols), cols))


@register("scale_min_max", "SELECT " + ", ".join(
    f"round(coalesce(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 0), 6) AS {c}"
    for c in ["l_quantity", "l_discount", "l_tax"]) + " FROM lineitem")
def q_scale_min_max(spark, d):
    from ..operators import scale
    cols = ["l_quantity", "l_discount", "l_tax"]
    return round_all(scale.min_max_scale(_li(spark, d).select(*cols), cols))


@register("scale_fold_standardize", f"""WITH f AS (SELECT o_orderkey, o_totalprice,
  CAST((row_number() OVER (ORDER BY {H_ORDER}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders),
st AS (SELECT k.fold, avg(f.o_totalprice) AS mu, stddev_pop(f.o_totalprice) AS sd
       FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold)
SELECT f.o_orderkey, f.fold, round((f.o_totalprice - st.mu) / CASE WHEN st.sd = 0 THEN 1 ELSE st.sd END, 6) AS o_totalprice
FROM f JOIN st USING (fold)""")
def q_scale_fold_standardize(spark, d):
    from ..operators import folds, ordering, scale
    o = _orders(spark, d).select("o_orderkey", "o_totalprice")
    o = ordering.number_rows(o.withColumn("_h", folds.portable_hash("o_orderkey")), [], ["_h", "o_orderkey"], "_rn")
    o = o.select("o_orderkey", "o_totalprice", (F.col("_rn") % 5).cast("int").alias("fold"))
    return round_all(scale.fold_standardize(o, ["o_totalprice"]))


RBF_CENTROIDS = [[10.0, 0.02, 0.01], [25.0, 0.05, 0.04], [40.0, 0.08, 0.07]]


@register("scale_rbf_features", "SELECT " + ", ".join(
    "round(exp(-(" + " + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(POLY_COLS, cen)) +
    f") / (2 * {__import__('ferrule.operators.scale', fromlist=['x']).rbf_sigma(__import__('numpy').array(RBF_CENTROIDS))} ^ 2)), 6) AS rbf{m}"
    for m, cen in enumerate(RBF_CENTROIDS)) + " FROM lineitem")
def q_scale_rbf_features(spark, d):
    from ..operators import scale
    return round_all(scale.rbf_features(_li(spark, d), POLY_COLS, RBF_CENTROIDS))


@register("scale_polynomial", f"SELECT {_poly_sql(2)} FROM lineitem")
def q_scale_polynomial(spark, d):
    from ..operators import select
    return select.polynomial_features(_li(spark, d), POLY_COLS, 2)


# --------------------------------------------------------------------------- metrics

def reg_score_sql(keys: str, digits: bool = True) -> str:
    """Scores per group from rows and the group's mean (two passes, written apart from
    the running variance that the operator uses)."""
    rnd = (lambda e, n: f"round({e}, {n})") if digits else (lambda e, n: e)
    return f"""SELECT {keys}, count(*) AS n, {rnd("avg(e * e)", 1)} AS mse, {rnd("sqrt(avg(e * e))", 6)} AS rmse,
  {rnd("avg(abs(e) / greatest(abs(y_true), 2.220446049250313e-16))", 6)} AS mape,
  {rnd("1 - sum(e * e) / nullif(sum((y_true - y_mean) * (y_true - y_mean)), 0)", 6)} AS r2,
  {rnd("avg(coalesce(2 * abs(e) / nullif(abs(y_true) + abs(y_pred), 0), 0)) * 100", 6)} AS smape,
  {rnd("sum(e) / nullif(sum(abs(y_true) + abs(y_pred)), 0)", 6)} AS signed_smape
FROM (SELECT *, y_pred - y_true AS e, avg(y_true) OVER (PARTITION BY {keys}) AS y_mean FROM preds) GROUP BY {keys}"""


def _reg_scores_rounded(df):
    return round_all(round_all(df, 6), 1, ["mse"])


@register("metric_regression_scores", f"WITH {S.REG_PRED_CTE} " + reg_score_sql("model, fold, set"))
def q_metric_regression_scores(spark, d):
    from ..operators import metrics
    return _reg_scores_rounded(metrics.regression_scores(tables.regression_predictions(spark, d),
                                                         ["model", "fold", "set"]))


@register("metric_winsorized_mape", f"""WITH {S.REG_PRED_CTE},
e AS (SELECT model, set, abs(y_pred - y_true) / greatest(abs(y_true), 2.220446049250313e-16) AS err FROM preds),
t AS (SELECT model, set, quantile_cont(err, 0.95) AS thr FROM e GROUP BY ALL)
SELECT model, set, round(avg(least(err, thr)), 6) AS wmape FROM e JOIN t USING (model, set) GROUP BY ALL""")
def q_metric_winsorized_mape(spark, d):
    from ..operators import metrics
    return round_all(metrics.winsorized_mape(tables.regression_predictions(spark, d), ["model", "set"]))


# Folds by id; a third, rare class is missing in some of them.
THREE_CLASS_CTE = """preds AS (
  SELECT CAST(doc_id % 11 AS INTEGER) AS fold, doc_id AS row_id,
         CAST(CASE WHEN doc_id % 97 = 3 THEN 2 ELSE quality END AS INTEGER) AS y_true,
         CAST(CASE WHEN doc_id % 89 = 5 THEN 2 ELSE toxic END AS INTEGER) AS y_pred,
         CAST(1 + doc_id % 3 AS DOUBLE) AS w FROM labels)"""


def _three_class(spark, d):
    i = F.col("doc_id")
    return tables.read_table(spark, d, "labels").select(
        (i % 11).cast("int").alias("fold"), i.alias("row_id"), F.when(i % 97 == 3, 2).otherwise(F.col("quality")).cast("int").alias("y_true"),
        F.when(i % 89 == 5, 2).otherwise(F.col("toxic")).cast("int").alias("y_pred"), (1 + i % 3).cast("double").alias("w"))


@register("metric_confusion", f"""WITH {THREE_CLASS_CTE},
lab AS (SELECT fold, y_true AS l FROM preds UNION SELECT fold, y_pred FROM preds),
c AS (SELECT fold, y_true, y_pred, count(*) AS n FROM preds GROUP BY ALL)
SELECT t.fold, t.l AS "true", p.l AS pred, coalesce(c.n, 0) AS n FROM lab t JOIN lab p USING (fold)
LEFT JOIN c ON c.fold = t.fold AND c.y_true = t.l AND c.y_pred = p.l""")
def q_metric_confusion(spark, d):
    from ..operators import metrics
    return metrics.confusion(_three_class(spark, d), ["fold"])


def report_sql(cte: str, keys: str, weight: str = "1") -> str:
    """Per label that occurs in the group itself, from the rows."""
    same = " AND ".join(f"p.{k.strip()} = lab.{k.strip()}" for k in keys.split(","))
    lab_keys = ", ".join(f"lab.{k.strip()}" for k in keys.split(","))
    return f"""WITH {cte},
lab AS (SELECT {keys}, y_true AS label FROM preds UNION SELECT {keys}, y_pred FROM preds),
pc AS (SELECT {lab_keys}, lab.label,
         sum({weight}) FILTER (WHERE p.y_true = lab.label AND p.y_pred = lab.label) AS tp0,
         sum({weight}) FILTER (WHERE p.y_true = lab.label) AS support0, sum({weight}) FILTER (WHERE p.y_pred = lab.label) AS predicted0
       FROM lab JOIN preds p ON {same} GROUP BY ALL),
m AS (SELECT *, coalesce(support0, 0) AS support, coalesce(tp0 / nullif(predicted0, 0), 0) AS precision, coalesce(tp0 / nullif(support0, 0), 0) AS recall FROM pc),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m),
acc AS (SELECT {keys}, sum(CASE WHEN y_true = y_pred THEN {weight} ELSE 0 END) / sum({weight}) AS acc, sum({weight}) AS s FROM preds GROUP BY ALL),
rep AS (
  SELECT {keys}, CAST(label AS VARCHAR) AS row, precision, recall, f1, CAST(support AS DOUBLE) AS support FROM f
  UNION ALL SELECT {keys}, 'accuracy', acc, acc, acc, CAST(s AS DOUBLE) FROM acc
  UNION ALL SELECT {keys}, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS DOUBLE) FROM f GROUP BY ALL
  UNION ALL SELECT {keys}, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS DOUBLE) FROM f GROUP BY ALL)"""


CLS_REPORT_SQL = report_sql(S.CLS_PRED_CTE, "model, fold")


@register("metric_report_rare_class", report_sql(THREE_CLASS_CTE, "fold", "w") + """
SELECT fold, row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""")
def q_metric_report_rare_class(spark, d):
    from ..operators import metrics
    return round_all(metrics.classification_report(_three_class(spark, d), ["fold"], weight="w"))


@register("metric_scores_rare_class", report_sql(THREE_CLASS_CTE, "fold") + """
SELECT fold, round(acc.acc, 6) AS accuracy, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
  round(avg(f1), 6) AS macro_f1, round(avg(recall) FILTER (WHERE support > 0), 6) AS balanced_accuracy, round(1 - avg(f1), 6) AS f1_loss
FROM f JOIN acc USING (fold) GROUP BY fold, acc.acc""")
def q_metric_scores_rare_class(spark, d):
    from ..operators import metrics
    return round_all(metrics.classification_scores(_three_class(spark, d), ["fold"]))


@register("metric_classification_report", CLS_REPORT_SQL + """
SELECT model, fold, row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""")
def q_metric_classification_report(spark, d):
    from ..operators import metrics
    return round_all(metrics.classification_report(tables.classification_predictions(spark, d), ["model", "fold"]))


@register("metric_classification_scores", CLS_REPORT_SQL + """
SELECT model, fold, round(acc.acc, 6) AS accuracy, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
  round(avg(f1), 6) AS macro_f1, round(avg(recall) FILTER (WHERE support > 0), 6) AS balanced_accuracy, round(1 - avg(f1), 6) AS f1_loss
FROM f JOIN acc USING (model, fold) GROUP BY model, fold, acc.acc""")
def q_metric_classification_scores(spark, d):
    from ..operators import metrics
    return round_all(metrics.classification_scores(tables.classification_predictions(spark, d), ["model", "fold"]))


@register("metric_fold_average_report", CLS_REPORT_SQL + """
SELECT model, row, round(avg(precision), 6) AS precision_mean, round(stddev_pop(precision), 6) AS precision_std,
  round(avg(recall), 6) AS recall_mean, round(stddev_pop(recall), 6) AS recall_std,
  round(avg(f1), 6) AS f1_mean, round(stddev_pop(f1), 6) AS f1_std FROM rep GROUP BY ALL""")
def q_metric_fold_average_report(spark, d):
    from ..operators import metrics
    rep = metrics.classification_report(tables.classification_predictions(spark, d), ["model", "fold"])
    return round_all(metrics.fold_average_report(rep, ["model", "row"]))


@register("metric_roc_auc", """WITH r AS (
  SELECT l_returnflag = 'R' AS pos, rank() OVER (ORDER BY l_discount) AS r0,
         count(*) OVER (PARTITION BY l_discount) AS c FROM lineitem),
a AS (SELECT pos, r0 + (c - 1) / 2.0 AS avg_rank FROM r)
SELECT round((sum(avg_rank) FILTER (WHERE pos) - count(*) FILTER (WHERE pos) * (count(*) FILTER (WHERE pos) + 1) / 2.0)
             / (count(*) FILTER (WHERE pos) * count(*) FILTER (WHERE NOT pos)), 6) AS roc_auc FROM a""")
def q_metric_roc_auc(spark, d):
    from ..operators import metrics
    li = _li(spark, d).select((F.col("l_returnflag") == "R").cast("int").alias("y_true"),
                              F.col("l_discount").alias("score"))
    return round_all(metrics.roc_auc(li))


@register("metric_fold_summary", f"WITH {S.REG_PRED_CTE}, sc AS (" + reg_score_sql("model, fold, set", False) + """)
SELECT model, set, round(avg(r2), 6) AS mean, round(stddev_pop(r2), 6) AS std, round(max(r2), 6) AS max,
       round(min(r2), 6) AS min, count(DISTINCT fold) AS n_folds FROM sc GROUP BY ALL""")
def q_metric_fold_summary(spark, d):
    from ..operators import metrics
    sc = metrics.regression_scores(tables.regression_predictions(spark, d), ["model", "fold", "set"])
    return round_all(metrics.fold_summary(sc, ["model", "set"], "r2"))


@register("metric_group_scores", f"""WITH {S.CLS_PRED_CTE}, k AS (SELECT *, model || '/' || fold AS mf FROM preds),
acc AS (SELECT mf, avg(CAST(y_true = y_pred AS DOUBLE)) AS a FROM k GROUP BY ALL)
SELECT DISTINCT k.mf, k.row_id % 14 AS grp, round(acc.a, 6) AS fold_accuracy FROM k JOIN acc USING (mf)""")
def q_metric_group_scores(spark, d):
    from ..operators import metrics
    p = tables.classification_predictions(spark, d).withColumn("grp", F.col("row_id") % 14) \
        .withColumn("mf", F.concat_ws("/", "model", "fold"))
    return round_all(metrics.group_scores(p, "mf", "grp"))


@register("metric_overfit_table", f"WITH {S.REG_PRED_CTE}, sc AS (" + reg_score_sql("model, fold, set", False) + """),
lng AS (SELECT model, 'r2' AS metric, set, r2 AS score FROM sc UNION ALL SELECT model, 'mape', set, mape FROM sc),
gap AS (SELECT metric, model, avg(score) FILTER (WHERE set = 'train') - avg(score) FILTER (WHERE set = 'val') AS v
        FROM lng GROUP BY ALL),
r AS (SELECT metric, v, row_number() OVER (PARTITION BY metric ORDER BY v) - 1 AS k, count(*) OVER (PARTITION BY metric) AS n FROM gap)
SELECT metric, round(avg(v), 6) AS trimmed_gap FROM r WHERE k >= floor(n * 0.1) AND k < n - floor(n * 0.1) GROUP BY ALL""")
def q_metric_overfit_table(spark, d):
    from ..operators import metrics
    sc = metrics.regression_scores(tables.regression_predictions(spark, d), ["model", "fold", "set"])
    lng = sc.select("model", F.lit("r2").alias("metric"), "set", F.col("r2").alias("score")).unionByName(
        sc.select("model", F.lit("mape").alias("metric"), "set", F.col("mape").alias("score")))
    return round_all(metrics.overfit_table(lng, []))


def _candidate_scores(spark, d):
    from ..operators import metrics
    preds = tables.regression_predictions(spark, d, [(f"a{int(a)}", a) for a in tables.CANDIDATE_FACTORS])
    sc = metrics.regression_scores(preds, ["model", "fold", "set"])
    piv = sc.groupBy("model").pivot("set", ["train", "val"]).agg(*[
        F.max(F.when(F.col("fold") == f, F.col("r2"))).alias(f"split{f}") for f in range(5)])
    return piv.select(F.col("model").alias("candidate"),
                      *[F.col(f"val_split{f}").alias(f"split{f}_test_score") for f in range(5)],
                      *[F.col(f"train_split{f}").alias(f"split{f}_train_score") for f in range(5)])


CAND_SQL = f"""WITH preds AS (
  SELECT 'a' || CAST(CAST(m.a AS INTEGER) AS VARCHAR) AS model, CAST(l_linenumber % 5 AS INTEGER) AS fold,
         CASE WHEN l_orderkey % 4 = 0 THEN 'val' ELSE 'train' END AS set,
         l_extendedprice AS y_true, l_quantity * m.a AS y_pred
  FROM lineitem, (SELECT unnest([1000.0, 1250.0, 1500.0, 1750.0, 2000.0])::DOUBLE AS a) m),
sc AS (SELECT model, fold, set, 1 - sum((y_pred - y_true) ^ 2) / sum((y_true - m) ^ 2) AS r2
       FROM (SELECT *, avg(y_true) OVER (PARTITION BY model, fold, set) AS m FROM preds) GROUP BY ALL),
c AS (SELECT model AS candidate,
  {", ".join(f"max(r2) FILTER (WHERE fold = {f} AND set = 'val') AS split{f}_test_score" for f in range(5))},
  {", ".join(f"max(r2) FILTER (WHERE fold = {f} AND set = 'train') AS split{f}_train_score" for f in range(5))}
  FROM sc GROUP BY ALL)"""


@register("board_candidate_leaderboard", CAND_SQL + f"""
SELECT candidate, {", ".join(f"round(split{f}_test_score, 6) AS split{f}_test_score" for f in range(5))},
  round(({" + ".join(f"split{f}_test_score" for f in range(5))}) / 5, 6) AS mean_test_score,
  round(sqrt(({" + ".join(f"(split{f}_test_score - ({' + '.join(f'split{g}_test_score' for g in range(5))}) / 5) ^ 2" for f in range(5))}) / 5), 6) AS std_test_score,
  CAST(rank() OVER (ORDER BY ({" + ".join(f"split{f}_test_score" for f in range(5))}) / 5 DESC) AS INTEGER) AS rank_test_score
FROM c""")
def q_board_candidate_leaderboard(spark, d):
    from ..operators import metrics
    c = _candidate_scores(spark, d)
    lb = metrics.candidate_leaderboard(c, [f"split{f}_test_score" for f in range(5)], ["candidate"])
    return round_all(lb)


@register("board_train_cv_gap", CAND_SQL + f"""
SELECT candidate, round(({" + ".join(f"split{f}_train_score" for f in range(5))}) / 5, 6) AS mean_train,
  round(({" + ".join(f"split{f}_test_score" for f in range(5))}) / 5, 6) AS mean_test,
  round(({" + ".join(f"split{f}_train_score" for f in range(5))}) / 5 - ({" + ".join(f"split{f}_test_score" for f in range(5))}) / 5, 6) AS gap
FROM c""")
def q_board_train_cv_gap(spark, d):
    from ..operators import metrics
    c = _candidate_scores(spark, d)
    return round_all(metrics.train_cv_gap(c, [f"split{f}_train_score" for f in range(5)],
                                          [f"split{f}_test_score" for f in range(5)], ["candidate"]))


# --------------------------------------------------------------------------- pose arrays

def _pose(spark, d):
    return tables.pose_frame(spark, d)


def _sk():
    from ..operators.pose import POSE16
    return POSE16


def _pc(c, j, n=16, arr="features"):
    off = {"xmean": 2 * j, "ymean": 2 * j + 1, "xstd": 2 * n + 2 * j, "ystd": 2 * n + 2 * j + 1}[c]
    return f"{arr}[{off + 1}]"


@register("pose_unpack", f"WITH {S.POSE_CTE} SELECT row_id, " + ", ".join(
    (f"-{_pc(c, j)}" if c == "ymean" else _pc(c, j)) + f" AS {c}{j}"
    for c in ("xmean", "ymean", "xstd", "ystd") for j in range(16)) + " FROM pose")
def q_pose_unpack(spark, d):
    from ..operators import pose
    return pose.unpack(_pose(spark, d), "features", 16, keep=["row_id"], negate_y=True)


@register("pose_interleaved", f"""WITH {S.POSE_CTE},
il AS (SELECT row_id, flatten(list_transform(range(16), lambda i: [features[2 * i + 1], features[2 * i + 2],
        features[32 + 2 * i + 1], features[32 + 2 * i + 2]])) AS il FROM pose)
SELECT row_id, CAST(k - 1 AS INTEGER) AS pos, il[k] AS value FROM il, range(1, 65) t(k)""")
def q_pose_interleaved(spark, d):
    from ..operators import pose
    p = pose.check_width(_pose(spark, d), "features", 16)
    return p.select("row_id", F.posexplode(pose.to_interleaved("features", 16)).alias("pos", "value"))


def _feature_row_sql(digits=6):
    return _feature_exprs(_sk(), 16, digits)


def _feature_exprs(sk, n, digits):
    pc = lambda c, j: _pc(c, j, n)
    rnd = (lambda e: f"round({e}, {digits})") if digits else (lambda e: e)
    hand, out = {}, []
    for side, joints in sk.hands.items():
        for c in ("xmean", "ymean", "xstd", "ystd"):
            hand[(c, side)] = "((" + " + ".join(pc(c, j) for j in joints) + f") / {float(len(joints))})"
            out.append(f"{rnd(hand[(c, side)])} AS {c}{side}_hand")
    ls, lh, rs, rh = sk.torso
    dist = lambda a, b: f"sqrt(({pc('xmean', a)} - {pc('xmean', b)}) ^ 2 + ({pc('ymean', a)} - {pc('ymean', b)}) ^ 2)"
    torso = f"({dist(ls, lh)} / 2.0 + {dist(rs, rh)} / 2.0)"
    pt = lambda c, a: hand[(c, a.split('_')[0])] if isinstance(a, str) else pc(c, a)
    for a, b in sk.diff_pairs:
        for c in ("xmean", "ymean"):
            out.append(rnd(f"({pt(c, a)} - {pt(c, b)}) / nullif({torso}, 0)") + f' AS "{c}diff{a}-{b}"')
    for j in sk.knees:
        for c in ("xstd", "ystd"):
            out.append(f"{rnd(pc(c, j))} AS {c}{j}")
    for side, joints in sk.sides.items():
        out.append(rnd(" + ".join(f"{pc('xstd', j)} + {pc('ystd', j)}" for j in joints)) + f" AS {side}_std")
    out.append(f"{rnd(torso)} AS torso_length")
    return ", ".join(out)


@register("pose_feature_row", f"WITH {S.POSE_CTE} SELECT row_id, patient_id, {_feature_row_sql()} FROM pose")
def q_pose_feature_row(spark, d):
    from ..operators import pose
    return round_all(pose.feature_row(_pose(spark, d), "features", _sk(), keep=["row_id", "patient_id"]))


@register("pose_impairment_side", f"""WITH {S.POSE_CTE}, fr AS (SELECT row_id, patient_id, {_feature_row_sql(None)} FROM pose),
t AS (SELECT patient_id, sum(left_std) AS left_total, sum(right_std) AS right_total FROM fr GROUP BY ALL)
SELECT fr.row_id, fr.patient_id, round(t.left_total, 4) AS left_total, round(t.right_total, 4) AS right_total,
       CAST(t.left_total > t.right_total AS INTEGER) AS impairment_side FROM fr JOIN t USING (patient_id)""")
def q_pose_impairment_side(spark, d):
    from ..operators import pose
    fr = pose.feature_row(_pose(spark, d), "features", _sk(), keep=["row_id", "patient_id"])
    out = pose.impairment_side(fr, None, "patient_id")
    return round_all(out.select("row_id", "patient_id", "left_total", "right_total", "impairment_side"), 4,
                     ["left_total", "right_total"])


W_COLS = ["xstdleft_hand", "ystdleft_hand", "xstdright_hand", "ystdright_hand", "xstd13", "ystd13", "xstd14", "ystd14"]


@register("pose_sample_weights", f"""WITH {S.POSE_CTE}, fr AS (SELECT row_id, patient_id, {_feature_row_sql(None)} FROM pose),
w AS (SELECT row_id, ({" + ".join(f"coalesce(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 0)" for c in W_COLS)}) ^ 2 AS w2 FROM fr)
SELECT row_id, round(w2 / max(w2) OVER (), 6) AS weight FROM w""")
def q_pose_sample_weights(spark, d):
    from ..operators import pose
    fr = pose.feature_row(_pose(spark, d), "features", _sk(), keep=["row_id", "patient_id"])
    return round_all(pose.sample_weights(fr, W_COLS).select("row_id", "weight"))


@register("pose_weighted_class_means", f"""WITH {S.POSE_CTE}, fr AS (SELECT row_id, target, {_feature_row_sql(None)} FROM pose)
SELECT target, {", ".join(f"round(sum({c} * torso_length) / nullif(sum(torso_length), 0), 6) AS {c}" for c in ["left_std", "right_std", "xmean13", "ymean13"] if True).replace("xmean13", "xstd13").replace("ymean13", "ystd13")}
FROM fr GROUP BY ALL""")
def q_pose_weighted_class_means(spark, d):
    from ..operators import pose
    fr = pose.feature_row(_pose(spark, d), "features", _sk(), keep=["row_id", "target"])
    return round_all(pose.weighted_class_means(fr, ["left_std", "right_std", "xstd13", "ystd13"], "torso_length",
                                               ["target"]))


@register("pose_mean_by_patient_class", f"""WITH {S.POSE_CTE}
SELECT patient_id, target, {", ".join(f"round(avg({_pc(c, j)}), 6) AS {c}{j}" for j in (7, 8, 9, 10) for c in ("xmean", "ymean"))}
FROM pose GROUP BY ALL""")
def q_pose_mean_by_patient_class(spark, d):
    from ..operators import pose
    u = pose.unpack(_pose(spark, d), "features", 16, keep=["patient_id", "target"])
    cols = [f"{c}{j}" for j in (7, 8, 9, 10) for c in ("xmean", "ymean")]
    return round_all(u.groupBy("patient_id", "target").agg(*[F.avg(c).alias(c) for c in cols]))


def _activity_sql(joints):
    return "(" + " + ".join(f"{_pc('xstd', j)} + {_pc('ystd', j)}" for j in joints) + ")"


@register("pose_top_activity", f"""WITH {S.POSE_CTE},
s AS (SELECT row_id, target, round(CASE WHEN target < 5 THEN {_activity_sql([7, 8, 9, 10])} ELSE {_activity_sql([13, 14, 15])} END, 6) AS score FROM pose)
SELECT row_id, target, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, row_id) AS rank FROM s) WHERE rank <= 5""")
def q_pose_top_activity(spark, d):
    from ..operators import ordering, pose
    sk = _sk()
    p = _pose(spark, d)
    score = F.when(F.col("target") < 5, pose.activity_score("features", sk, [7, 8, 9, 10])).otherwise(
        pose.activity_score("features", sk, [13, 14, 15]))
    s = p.select("row_id", "target", F.round(score, 6).alias("score"))
    return ordering.first_n_per_group(s, ["target"], [F.desc("score"), "row_id"], 5).withColumn(
        "rank", F.col("rank").cast("int"))


CENTRE_MODES = [("centroid", None), ("root", None), ("root", 3)]
SCALE_MODES = ["none", "bbox", "std", "torso", "pair"]


def _centre_sql(k, centre, root, scale):
    xs, ys = "list_transform(range(16), lambda i: features[2 * i + 1])", "list_transform(range(16), lambda i: features[2 * i + 2])"
    cx, cy = {"centroid": (f"list_avg({xs})", f"list_avg({ys})"), "root": (f"list_median({xs})", f"list_median({ys})")}[centre] if root is None else (
        f"features[{2 * root + 1}]", f"features[{2 * root + 2}]")
    px, py = "list_transform(range(16), lambda i: features[2 * i + 1] - cx)", "list_transform(range(16), lambda i: features[2 * i + 2] - cy)"
    s0 = {"none": "1.0", "bbox": f"greatest(list_max({px}) - list_min({px}), list_max({py}) - list_min({py}))", "std": f"list_stddev_pop(list_concat({px}, {py}))",
          "torso": "list_avg(list_transform(range(16), lambda i: sqrt((features[2 * i + 1] - cx) ^ 2 + (features[2 * i + 2] - cy) ^ 2)))",
          "pair": f"sqrt(({_pc('xmean', 1)} - {_pc('xmean', 11)}) ^ 2 + ({_pc('ymean', 1)} - {_pc('ymean', 11)}) ^ 2)"}[scale]
    return (f"SELECT {k} AS mode, row_id, features, cx, cy, CASE WHEN abs(s0) < 1e-9 THEN 1 ELSE s0 END AS scale "
            f"FROM (SELECT *, {s0} AS s0 FROM (SELECT row_id, features, {cx} AS cx, {cy} AS cy FROM pose))")


@register("pose_centre_scale", f"WITH {S.POSE_CTE}, n AS (" + "\nUNION ALL\n".join(
    _centre_sql(k * 10 + m, c, r, sc) for k, (c, r) in enumerate(CENTRE_MODES) for m, sc in enumerate(SCALE_MODES)) + """)
SELECT CAST(mode AS INTEGER) AS mode, row_id, CAST(k - 1 AS INTEGER) AS pos, round(CASE WHEN k <= 32 AND k % 2 = 1 THEN features[k] - cx WHEN k <= 32 THEN features[k] - cy ELSE features[k] END / scale, 6) AS value,
  round(scale, 6) AS scale, round(cx, 6) AS cx, round(cy, 6) AS cy FROM n, range(1, 65) t(k)""")
def q_pose_centre_scale(spark, d):
    from ..operators import pose
    modes = [F.struct(F.lit(k * 10 + m).alias("mode"), pose.centre_and_scale(
        "features", 16, c, r, "torso" if sc == "pair" else sc, (1, 11) if sc == "pair" else None).alias("n"))
        for k, (c, r) in enumerate(CENTRE_MODES) for m, sc in enumerate(SCALE_MODES)]
    x = _pose(spark, d).select("row_id", F.explode(F.array(*modes)).alias("m"))
    x = round_all(x.select("m.mode", "row_id", F.col("m.n.features").alias("features"), F.col("m.n.scale").alias("scale"), F.col("m.n.cx").alias("cx"), F.col("m.n.cy").alias("cy")))
    return round_all(x.select("mode", "row_id", F.posexplode("features").alias("pos", "value"), "scale", "cx", "cy"), cols=["value"])


# Slot numbers of the geometry set, written apart from the operator (1-based, 33 joints).
def _geometry_sql(variant, flip, std):
    n = 33
    raw = lambda i: f"-features[{i + 1}]" if flip and i < 2 * n and i % 2 == 1 else f"features[{i + 1}]"
    x, y = (lambda j: f"({raw(2 * j)})"), (lambda j: f"({raw(2 * j + 1)})")
    base = (lambda j: 66 + 2 * j) if std == "blocked" else (lambda j: 4 * j)
    sx, sy = (lambda j: f"({raw(base(j))})"), (lambda j: f"({raw(base(j) + 1)})")
    avg = lambda f, js: "((" + " + ".join(f(j) for j in js) + f") / {float(len(js))})"
    d = lambda p, q: f"sqrt(({x(p)} - {x(q)}) ^ 2 + ({y(p)} - {y(q)}) ^ 2)"
    h, w = f"greatest({y(3)} - {y(29)}, {y(6)} - {y(30)})", f"({x(23)} - {x(24)})"
    ph, pw = (lambda e: f"({e}) / nullif({h}, 0)"), (lambda e: f"({e}) / nullif({w}, 0)")
    rf, lf, rh, lh = (28, 30, 32), (27, 29, 31), (16, 18, 20, 22), (15, 17, 19, 21)
    groups = {
        "limbs": {"l_arm": ph(d(19, 11)), "r_arm": ph(d(20, 12)), "l_leg": ph(d(23, 29)), "r_leg": ph(d(24, 30))},
        "hand_spread": {"l_hand_spread": pw(sy(19)), "r_hand_spread": pw(sy(20))},
        "nose": {"l_nose_hand": f"{y(0)} - {y(19)}", "r_nose_hand": f"{y(0)} - {y(20)}"},
        "bend_spread": {**{f"x_spread{j}": pw(sx(j)) for j in (13, 14, 25, 26)}, **{f"y_spread{j}": ph(sy(j)) for j in (13, 14, 25, 26)}},
        "end_spread": {k: v for nme, js in (("r_foot", rf), ("l_foot", lf), ("r_hand", rh), ("l_hand", lh)) for k, v in ((f"{nme}_sx", pw(avg(sx, js))), (f"{nme}_sy", ph(avg(sy, js))))},
        "size": {"height": h, "width": w},
        "end_position": {k: v for nme, js in (("r_foot", rf), ("l_foot", lf), ("r_hand", rh), ("l_hand", lh)) for k, v in ((f"{nme}_x", pw(avg(x, js))), (f"{nme}_y", ph(avg(y, js))))},
        "end_difference": {k: v for nme, a, b in (("r", rf, rh), ("l", lf, lh)) for k, v in ((f"{nme}_foot_hand_x", pw(f"{avg(x, a)} - {avg(x, b)}")), (f"{nme}_foot_hand_y", ph(f"{avg(y, a)} - {avg(y, b)}")))},
    }
    lead, use = {"base": ([], ["limbs", "hand_spread", "nose", "bend_spread", "size", "end_position", "end_difference"]),
                 "kept": ([i for m, o in ((2, 0), (2, 1), (4, 0), (4, 1)) for i in (m * j + o for j in (15, 16, 17, 18, 19, 20, 21, 22, 27, 28))], ["limbs", "hand_spread", "nose", "bend_spread", "end_spread", "end_position"]),
                 "full": (list(range(132)), ["limbs", "hand_spread", "nose", "bend_spread", "end_spread", "end_position"]),
                 "final": (list(range(132)), ["nose", "bend_spread", "end_spread", "end_position"])}[variant]
    cols = [f"round({raw(i)}, 6) AS g_raw{k}" for k, i in enumerate(lead)] + [f"round({e}, 6) AS {k}" for g in use for k, e in groups[g].items()]
    return f"WITH {S.POSE33_CTE} SELECT row_id, {', '.join(cols)} FROM pose33"


def _geometry_query(variant, flip, std):
    def run(spark, d):
        from ..operators import pose
        return round_all(pose.body_geometry(tables.pose33_frame(spark, d), "features", pose.BODY33, variant, flip, std, keep=["row_id"]))
    return run


for _name, _args in {"pose_geometry_base": ("base", False, "blocked"), "pose_geometry_kept": ("kept", False, "stride"),
                     "pose_geometry_full": ("full", True, "blocked"), "pose_geometry_final": ("final", True, "stride")}.items():
    register(_name, _geometry_sql(*_args))(_geometry_query(*_args))


@register("pose_feature_row_33", f"WITH {S.POSE33_CTE} SELECT row_id, {_feature_exprs(__import__('ferrule.operators.pose', fromlist=['x']).POSE33, 33, 6)} FROM pose33")
def q_pose_feature_row_33(spark, d):
    from ..operators import pose
    return round_all(pose.feature_row(tables.pose33_frame(spark, d), "features", pose.POSE33, keep=["row_id"]))


SIDES33 = {"l": [0, 4, 5, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24, 26, 28, 30, 32], "r": [1, 2, 3, 7, 9, 11, 13, 15, 17, 19, 21, 23, 25, 27, 29, 31]}
SIDES33_FRAME = {"r": [4, 5, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24, 26, 28, 30, 32], "l": [0, 1, 2, 3, 7, 9, 11, 13, 15, 17, 19, 21, 23, 25, 27, 29, 31]}


def _std_sum(arr, joints):
    return "(" + " + ".join(f"{arr}[{66 + 2 * j + 1}] + {arr}[{66 + 2 * j + 2}]" for j in joints) + ")"


@register("pose_side_normalised", f"""WITH {S.POSE33_CTE},
l AS (SELECT row_id, list_transform(features, lambda v, k: CASE WHEN list_contains({SIDES33['l']}, ((k - 1) % 66) // 2)
        THEN v / nullif(abs(features[CASE WHEN k % 2 = 1 THEN 23 ELSE 24 END]), 0) ELSE v END) AS f FROM pose33),
r AS (SELECT row_id, list_transform(f, lambda v, k: CASE WHEN list_contains({SIDES33['r']}, ((k - 1) % 66) // 2)
        THEN v / nullif(abs(f[CASE WHEN k % 2 = 1 THEN 25 ELSE 26 END]), 0) ELSE v END) AS f FROM l)
SELECT row_id, CAST(k - 1 AS INTEGER) AS pos, round(f[k], 4) AS value, round({_std_sum('f', SIDES33['l'])}, 4) AS lstd, round({_std_sum('f', SIDES33['r'])}, 4) AS rstd
FROM r, range(1, 133) t(k)""")
def q_pose_side_normalised(spark, d):
    from ..operators import pose
    t = pose.side_normalised(tables.pose33_frame(spark, d), "features", 33, SIDES33, {"l": 11, "r": 12}, keep=["row_id"])
    return round_all(t.select("row_id", F.posexplode("features").alias("pos", "value"), "lstd", "rstd"), 4)


@register("pose_shoulder_frame", f"""WITH {S.POSE33_CTE},
s AS (SELECT row_id, features AS f, nullif(abs(features[23] - features[25]), 0) AS w, nullif((abs(features[24] - features[48]) + abs(features[26] - features[50])) / 2, 0) AS h FROM pose33),
n AS (SELECT row_id, list_transform(f, lambda v, k: CASE WHEN k % 2 = 1 THEN v / w WHEN k <= 66 THEN -v / h ELSE v / h END) AS f FROM s),
q AS (SELECT *, {_std_sum('f', SIDES33_FRAME['l'])} AS ls, {_std_sum('f', SIDES33_FRAME['r'])} AS rs FROM n),
m AS (SELECT row_id, ls, rs, ls > rs AS flip, list_transform(f, lambda v, k: CASE WHEN ls > rs AND k <= 66 AND k % 2 = 1 THEN -v ELSE v END) AS f FROM q)
SELECT row_id, CAST(k - 1 AS INTEGER) AS pos, round(f[k], 4) AS value, round(CASE WHEN flip THEN rs ELSE ls END, 4) AS lstd, round(CASE WHEN flip THEN ls ELSE rs END, 4) AS rstd,
  CAST(flip AS INTEGER) AS mirrored, round(sqrt((f[31] - f[1]) ^ 2 + (f[32] - f[2]) ^ 2), 4) AS lhand_dist, round(sqrt((f[33] - f[1]) ^ 2 + (f[34] - f[2]) ^ 2), 4) AS rhand_dist,
  round(f[51] - f[47], 4) AS lhip_diff, round(f[53] - f[49], 4) AS rhip_diff FROM m, range(1, 133) t(k)""")
def q_pose_shoulder_frame(spark, d):
    from ..operators import pose
    t = pose.shoulder_frame(tables.pose33_frame(spark, d), "features", 33, SIDES33_FRAME, (11, 12), (23, 24), (15, 16), (25, 26), 0, keep=["row_id"])
    return round_all(t.select("row_id", F.posexplode("features").alias("pos", "value"), "lstd", "rstd", "mirrored", "lhand_dist", "rhand_dist", "lhip_diff", "rhip_diff"), 4)


@register("pose_arm_over_patient_max", f"""WITH {S.POSE33_CTE}, a AS (SELECT row_id, patient_id, sqrt((features[39] - features[23]) ^ 2 + (features[40] - features[24]) ^ 2)
  / nullif(greatest(features[8] - features[60], features[14] - features[62]), 0) AS arm, features[2] - features[40] AS dy FROM pose33)
SELECT row_id, patient_id, round(arm / nullif(max(arm) OVER (PARTITION BY patient_id), 0), 6) AS arm_rel, round(dy, 6) AS l_nose_hand FROM a""")
def q_pose_arm_over_patient_max(spark, d):
    from ..operators import pose
    g = pose.body_geometry(tables.pose33_frame(spark, d), "features", pose.BODY33, "base", keep=["row_id", "patient_id"])
    return round_all(pose.arm_over_patient_max(g, "l_arm", "patient_id").select("row_id", "patient_id", "arm_rel", "l_nose_hand"))


@register("pose_mirror", f"""WITH {S.POSE_CTE}, fr AS (SELECT row_id, features, {_feature_row_sql(None)} FROM pose),
m AS (SELECT *, left_std > right_std AS flip FROM fr)
SELECT m.row_id, CAST(k - 1 AS INTEGER) AS pos, CASE WHEN flip AND k <= 32 AND k % 2 = 1 THEN -features[k] ELSE features[k] END AS value,
  CAST(flip AS INTEGER) AS mirrored, round(least(left_std, right_std), 6) AS left_std, round(greatest(left_std, right_std), 6) AS right_std
FROM m, range(1, 65) t(k)""")
def q_pose_mirror(spark, d):
    from ..operators import pose
    fr = pose.feature_row(_pose(spark, d), "features", _sk(), keep=["row_id", "features"])
    m = pose.mirror_rows(fr, "features", 16)
    return round_all(m.select("row_id", F.posexplode("features").alias("pos", "value"), "mirrored", "left_std", "right_std"), 6, ["left_std", "right_std"])


@register("pose_argmax_threshold", f"""WITH {S.POSE_CTE}
SELECT row_id, CAST(list_position(features, list_max(features)) - 1 AS INTEGER) AS argmax,
       CAST(features[1] >= 0.0 AS INTEGER) AS above FROM pose""")
def q_pose_argmax_threshold(spark, d):
    from ..operators import pose
    p = _pose(spark, d)
    return p.select("row_id", pose.argmax_class("features").alias("argmax"),
                    pose.threshold_class(F.col("features")[0], 0.0).alias("above"))


@register("pose_one_hot_exercise", f"""WITH {S.SEQ_CTE}
SELECT DISTINCT patient_id, exercise_id, {", ".join(f"CAST(exercise_id = 'E{i}' AS INTEGER) AS exercise_id_E{i}" for i in range(1, 6))}
FROM seq""")
def q_pose_one_hot_exercise(spark, d):
    from ..operators import pose
    s = tables.sequence_frame(spark, d).select("patient_id", "exercise_id").distinct()
    return pose.one_hot_closed(s, "exercise_id", tables.EXERCISE_CODES)


# --------------------------------------------------------------------------- quality

@register("quality_fill_constant", f"""WITH {S.MISSING_CTE}
SELECT l_quantity, l_extendedprice, coalesce(l_discount, 0) AS l_discount, coalesce(l_tax, 0) AS l_tax FROM miss""")
def q_quality_fill_constant(spark, d):
    from ..operators import quality
    return quality.fill_constant(tables.missing_frame(spark, d), 0.0)


@register("quality_stage_sizes", f"""WITH {S.MISSING_CTE}
SELECT 'raw' AS stage, count(*) AS n_rows, 4 AS n_features FROM miss
UNION ALL SELECT 'complete', count(*), 4 FROM miss WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL
UNION ALL SELECT 'numeric_pair', count(*), 2 FROM miss""")
def q_quality_stage_sizes(spark, d):
    from ..operators import quality
    m = tables.missing_frame(spark, d)
    return quality.stage_sizes([("raw", m), ("complete", m.dropna()), ("numeric_pair", m.select("l_quantity", "l_tax"))])


@register("quality_stage_probe", f"""WITH {S.MISSING_CTE}, c AS (SELECT * FROM miss WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL)
SELECT 'raw' AS stage, count(*) AS n_rows, 4 AS n_features FROM miss
UNION ALL SELECT 'complete', count(*), 4 FROM c
UNION ALL SELECT 'terms', count(*), 14 FROM c
UNION ALL SELECT 'cheap', count(*), 14 FROM c WHERE l_quantity * l_extendedprice < 500000""")
def q_quality_stage_probe(spark, d):
    """Rows counted while the pipeline is written, not stage by stage."""
    from ..operators import quality, select
    from ..storage import save
    probe = quality.StageProbe()
    m = probe.watch("complete", probe.watch("raw", tables.missing_frame(spark, d)).dropna())
    terms = probe.watch("terms", select.polynomial_features(m, MISS_COLS, 2))
    save(probe.watch("cheap", terms.where("`l_quantity l_extendedprice` < 500000")), "stages")
    return probe.sizes(spark)


@register("quality_impute_eval", f"""WITH v AS (
  SELECT p_partkey, 'p_retailprice' AS "column", p_retailprice AS value FROM part
  UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS DOUBLE) FROM part),
r AS (SELECT s.seed, v.*, row_number() OVER (PARTITION BY s.seed, "column"
        ORDER BY CAST(('0x' || substr(md5(CAST(p_partkey AS VARCHAR) || 'imp' || s.seed), 1, 8)) AS BIGINT), p_partkey) - 1 AS rn,
        count(*) OVER (PARTITION BY s.seed, "column") AS n
      FROM v, (SELECT unnest([0, 1, 2]) AS seed) s),
f AS (SELECT seed, "column", avg(value) AS fill FROM r WHERE rn >= floor(n * 0.1) GROUP BY ALL),
e AS (SELECT r.seed, r."column", sqrt(avg((value - fill) ^ 2)) AS score, count(*) AS nm
      FROM r JOIN f USING (seed, "column") WHERE rn < floor(n * 0.1) GROUP BY ALL)
SELECT "column", round(avg(score), 6) AS score, round(avg(nm), 6) AS n_masked FROM e GROUP BY ALL""")
def q_quality_impute_eval(spark, d):
    from ..operators import quality
    p = tables.read_table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    return round_all(quality.evaluate_imputer(p, "p_partkey", ["p_retailprice", "p_size"], "mean", 0.1))


def _mcar_sql(cols):
    """Statistic n_miss d' S^-1 d for one tested column; the test columns' others are solved
    by Cramer's rule over the three other columns."""
    parts = []
    for c in cols:
        o = [x for x in cols if x != c]
        keep = " AND ".join(f"{x} IS NOT NULL" for x in o)
        m = {(i, j): f"covar_samp({o[i]}, {o[j]})" for i in range(3) for j in range(3)}
        names = ", ".join(f"{m[min(i, j), max(i, j)]} AS s{i}{j}" for i in range(3) for j in range(3))
        d = ", ".join(f"avg({x}) FILTER (WHERE {c} IS NULL) - avg({x}) FILTER (WHERE {c} IS NOT NULL) AS d{i}" for i, x in enumerate(o))
        det = "(s00 * (s11 * s22 - s12 * s21) - s01 * (s10 * s22 - s12 * s20) + s02 * (s10 * s21 - s11 * s20))"
        inv = {(i, j): f"((s{(j + 1) % 3}{(i + 1) % 3} * s{(j + 2) % 3}{(i + 2) % 3} - s{(j + 1) % 3}{(i + 2) % 3} * s{(j + 2) % 3}{(i + 1) % 3}) / {det})" for i in range(3) for j in range(3)}
        stat = "nm * (" + " + ".join(f"d{i} * {inv[i, j]} * d{j}" for i in range(3) for j in range(3)) + ")"
        parts.append(f"SELECT '{c}' AS \"column\", nm AS n_missing, CASE WHEN nm > 0 THEN {stat} END AS s "
                     f"FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) AS nm, {names}, {d} FROM miss WHERE {keep})")
    # Chi-square tail with 3 degrees of freedom: one less the series of the lower incomplete gamma function.
    tail = ("1 - exp(1.5 * ln(s / 2) - s / 2 - lgamma(2.5)) * list_sum(list_transform(range(400), "
            "lambda k: exp(k * ln(s / 2) + lgamma(2.5) - lgamma(2.5 + k))))")
    return (f"WITH {S.MISSING_CTE}, t AS (\n" + "\nUNION ALL\n".join(parts) + f"), p AS (SELECT *, CASE WHEN s IS NOT NULL THEN {tail} END AS p FROM t)\n"
            "SELECT \"column\", n_missing, round(s, 4) AS statistic, round(p, 6) AS p_value, p >= 0.05 AS mcar FROM p")


@register("quality_little_mcar", _mcar_sql(MISS_COLS))
def q_quality_little_mcar(spark, d):
    from ..operators import quality
    out = quality.little_mcar(tables.missing_frame(spark, d), MISS_COLS)
    return round_all(out.withColumn("statistic", F.round("statistic", 4)))


# --------------------------------------------------------------------------- reshaping

@register("reshape_melt", f"""WITH {S.POSE_CTE}, u AS (SELECT row_id, features[1] AS xmean0_l, features[2] AS ymean0_l,
  features[33] AS xstd0_l, features[34] AS ystd0_l FROM pose)
SELECT row_id, regexp_replace(variable, '_l$', '') AS variable, value FROM (
  SELECT row_id, 'xmean0_l' AS variable, xmean0_l AS value FROM u UNION ALL SELECT row_id, 'ymean0_l', ymean0_l FROM u
  UNION ALL SELECT row_id, 'xstd0_l', xstd0_l FROM u UNION ALL SELECT row_id, 'ystd0_l', ystd0_l FROM u)""")
def q_reshape_melt(spark, d):
    from ..operators import reshape
    p = _pose(spark, d).select("row_id", *[F.col("features")[i].alias(n) for i, n in
                                           ((0, "xmean0_l"), (1, "ymean0_l"), (32, "xstd0_l"), (33, "ystd0_l"))])
    return reshape.melt(p, ["row_id"], ["xmean0_l", "ymean0_l", "xstd0_l", "ystd0_l"], strip_suffix="_l$")


@register("reshape_pivot_sets", f"WITH {S.REG_PRED_CTE}, sc AS (" + reg_score_sql("model, set") + """)
SELECT model, 'r2' AS metric, max(r2) FILTER (WHERE set = 'train') AS train, max(r2) FILTER (WHERE set = 'val') AS val
FROM sc GROUP BY ALL""")
def q_reshape_pivot_sets(spark, d):
    from ..operators import metrics, reshape
    sc = _reg_scores_rounded(metrics.regression_scores(tables.regression_predictions(spark, d), ["model", "set"]))
    lng = sc.select("model", F.lit("r2").alias("metric"), "set", "r2")
    return reshape.pivot_first(lng, ["model", "metric"], "set", ["train", "val"], "r2")


@register("reshape_pivot_split_name", f"WITH {S.REG_PRED_CTE}, sc AS (" + reg_score_sql("model, set") + """)
SELECT split_part(model, '_x_', 1) AS family, round(avg(r2) FILTER (WHERE split_part(model, '_x_', 2) = '1500'), 6) AS "1500",
       round(avg(r2) FILTER (WHERE split_part(model, '_x_', 2) = '2000'), 6) AS "2000" FROM sc GROUP BY ALL""")
def q_reshape_pivot_split_name(spark, d):
    from ..operators import metrics, reshape
    sc = _reg_scores_rounded(metrics.regression_scores(tables.regression_predictions(spark, d), ["model", "set"]))
    return round_all(reshape.pivot_split_name(sc, "model", "_x_", "family", "factor", "r2", ["1500", "2000"]))


@register("reshape_expand_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def q_reshape_expand_json(spark, d):
    from ..operators import reshape
    return reshape.expand_json(tables.read_table(spark, d, "events"), "props", ["k"], keep=["event_id"])


@register("reshape_first_per_key", """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""")
def q_reshape_first_per_key(spark, d):
    from ..operators import reshape
    o = _orders(spark, d).select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return reshape.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register("reshape_holdout_groups", """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey IN (1, 2, 3, 4) THEN 'test' ELSE 'train' END AS side
FROM orders""")
def q_reshape_holdout_groups(spark, d):
    from ..operators import reshape
    o = _orders(spark, d).select("o_orderkey", "o_custkey")
    tr, te = reshape.hold_out(o, "o_custkey", [1, 2, 3, 4])
    return tr.withColumn("side", F.lit("train")).unionByName(te.withColumn("side", F.lit("test")))


@register("reshape_semi_anti", """SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders
FROM customer""")
def q_reshape_semi_anti(spark, d):
    from ..operators import reshape
    c = tables.read_table(spark, d, "customer").select("c_custkey")
    o = _orders(spark, d).select(F.col("o_custkey").alias("c_custkey"))
    return reshape.semi(c, o, ["c_custkey"]).withColumn("has_orders", F.lit(True)).unionByName(
        reshape.anti(c, o, ["c_custkey"]).withColumn("has_orders", F.lit(False)))


@register("reshape_bar_table", """WITH t AS (SELECT l_returnflag AS x, l_linestatus AS label, CAST(l_linenumber AS VARCHAR) AS facet,
  count(*) AS value FROM lineitem GROUP BY ALL),
grid AS (SELECT a.x, b.label, a.facet FROM (SELECT DISTINCT x, facet FROM t) a JOIN (SELECT DISTINCT label, facet FROM t) b USING (facet))
SELECT grid.x, grid.label, grid.facet, coalesce(t.value, 0) AS value FROM grid LEFT JOIN t USING (x, label, facet)""")
def q_reshape_bar_table(spark, d):
    from ..operators import reshape
    c = _li(spark, d).groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("value"))
    c = c.select(F.col("l_returnflag").alias("x"), F.col("l_linestatus").alias("label"),
                 F.col("l_linenumber").alias("facet"), "value")
    return reshape.bar_table(c, "x", "label", "facet", "value")


@register("reshape_smallest_abs", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY abs(l_extendedprice), l_orderkey, l_linenumber LIMIT 10""")
def q_reshape_smallest_abs(spark, d):
    from ..operators import reshape
    return reshape.smallest_abs(_li(spark, d).select("l_orderkey", "l_linenumber", "l_extendedprice"),
                                "l_extendedprice", 10)


@register("reshape_first_rows_per_class", """SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders) WHERE r <= 5""")
def q_reshape_first_rows_per_class(spark, d):
    from ..operators.ordering import first_n_per_group
    o = _orders(spark, d).select("o_orderpriority", "o_orderkey", "o_totalprice")
    return first_n_per_group(o, ["o_orderpriority"], ["o_orderkey"], 5).drop("rank")


@register("reshape_side_by_side", """WITH a AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer),
b AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders)
SELECT coalesce(a.pos, b.pos) AS pos, c_custkey, c_acctbal, o_orderkey, o_totalprice FROM a FULL JOIN b ON a.pos = b.pos""")
def q_reshape_side_by_side(spark, d):
    from ..operators.ordering import side_by_side
    c = tables.read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return side_by_side(c, _orders(spark, d).select("o_orderkey", "o_totalprice"), ["c_custkey"], ["o_totalprice", "o_orderkey"])


@register("seq_flatten_frames", f"""WITH {S.SEQ_CTE}, p AS (SELECT patient_id, exercise_id, frame // 8 AS piece, frame % 8 AS i, x, y FROM seq)
SELECT patient_id, exercise_id, piece, count(*) AS n_frames, {", ".join(f"coalesce(max({v}) FILTER (WHERE i = {i}), 0) AS f{2 * i + j}" for i in range(8) for j, v in enumerate("xy"))}
FROM p GROUP BY ALL""")
def q_seq_flatten_frames(spark, d):
    return seq.flatten_frames(tables.sequence_frame(spark, d), ["patient_id", "exercise_id"], ["x", "y"], 8)


# --------------------------------------------------------------------------- models

@register("ml_ols_single", """SELECT '_1' AS term, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coef FROM lineitem
UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""")
def q_ml_ols_single(spark, d):
    from ..operators import models
    return round_all(models.ols_normal_equations(_li(spark, d), ["l_quantity"], "l_extendedprice"), 4)


def _rfe_sql():
    """Two of three features left after the weakest standardised slope goes (least squares on
    three, then two centred features by Cramer's rule), per training part."""
    x = POLY_COLS
    mom = ", ".join(f"covar_pop({x[i]}, {x[j]}) AS s{i}{j}" for i in range(3) for j in range(3)) + ", " + ", ".join(f"covar_pop({x[i]}, l_extendedprice) AS c{i}" for i in range(3))
    det = "(s00 * (s11 * s22 - s12 * s21) - s01 * (s10 * s22 - s12 * s20) + s02 * (s10 * s21 - s11 * s20))"

    def beta(k):
        m = {(i, j): (f"c{i}" if j == k else f"s{i}{j}") for i in range(3) for j in range(3)}
        a = lambda i, j: m[i, j]
        return (f"(({a(0, 0)} * ({a(1, 1)} * {a(2, 2)} - {a(1, 2)} * {a(2, 1)}) - {a(0, 1)} * ({a(1, 0)} * {a(2, 2)} - {a(1, 2)} * {a(2, 0)}) "
                f"+ {a(0, 2)} * ({a(1, 0)} * {a(2, 1)} - {a(1, 1)} * {a(2, 0)})) / {det})")

    two = lambda i, j: f"abs((c{i} * s{j}{j} - c{j} * s{i}{j}) / (s{i}{i} * s{j}{j} - s{i}{j} * s{i}{j})) * sqrt(s{i}{i})"
    third = " ".join(f"WHEN w = {k} THEN CASE WHEN {two(*[q for q in range(3) if q != k])} <= {two(*[q for q in range(3) if q != k][::-1])} THEN {[q for q in range(3) if q != k][0]} ELSE {[q for q in range(3) if q != k][1]} END" for k in range(3))
    return f"""WITH t AS (SELECT k.fold, {mom} FROM (SELECT unnest(range(5)) AS fold) k JOIN lineitem ON l_linenumber % 5 <> k.fold GROUP BY k.fold),
b AS (SELECT *, abs({beta(0)}) * sqrt(s00) AS b0, abs({beta(1)}) * sqrt(s11) AS b1, abs({beta(2)}) * sqrt(s22) AS b2 FROM t),
w AS (SELECT *, CASE WHEN b0 <= b1 AND b0 <= b2 THEN 0 WHEN b1 <= b2 THEN 1 ELSE 2 END AS w FROM b),
v AS (SELECT *, CASE {third} END AS v FROM w)
SELECT fold, feature, CAST(CASE WHEN i = w THEN 3 WHEN i = v THEN 2 ELSE 1 END AS INTEGER) AS ranking
FROM v, (VALUES (0, '{x[0]}'), (1, '{x[1]}'), (2, '{x[2]}')) f(i, feature)"""


@register("ml_rfe_ranking", _rfe_sql())
def q_ml_rfe_ranking(spark, d):
    from ..operators import models
    li = _li(spark, d).withColumn("fold", (F.col("l_linenumber") % 5).cast("long"))
    return models.rfe_ranking(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 1, fold="fold")


@register("quality_mar_test", None)
def q_quality_mar_test(spark, d):
    from ..operators import models
    m = tables.read_table(spark, d, "lineitem").select(
        (F.col("l_linenumber") % 2).alias("fold"), "l_quantity", "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_discount")).alias("l_discount"))
    return models.mar_test(m, ["l_quantity", "l_extendedprice", "l_discount"], "fold")


# --------------------------------------------------------------------------- multi-joint sequences & remaining tables

JKEYS = ["recording", "joint"]


def _part_stats(spark, d, include_first, ddof):
    js = tables.joint_sequence_frame(spark, d)
    st = seq.step_table(js, JKEYS, include_first=include_first).select("recording", "joint", "frame", "step")
    return seq.part_stats(st, tables.joint_parts(spark), ["recording"], "step", ddof=ddof)


@register("seq_part_stats", f"""WITH {S.JSEQ_CTE},
pf AS (SELECT recording, frame, part, side, sum(step) AS v FROM jsteps JOIN parts USING (joint) WHERE has_prev GROUP BY ALL)
SELECT recording, part, side, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(quantile_cont(v, 0.5), 6) AS median
FROM pf GROUP BY ALL""")
def q_seq_part_stats(spark, d):
    return round_all(_part_stats(spark, d, include_first=False, ddof=0))


@register("seq_part_stats_with_first", f"""WITH {S.JSEQ_CTE},
pf AS (SELECT recording, frame, part, side, sum(step) AS v FROM jsteps JOIN parts USING (joint) GROUP BY ALL)
SELECT recording, part, side, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(quantile_cont(v, 0.5), 6) AS median
FROM pf GROUP BY ALL""")
def q_seq_part_stats_with_first(spark, d):
    return round_all(_part_stats(spark, d, include_first=True, ddof=1))


@register("seq_side_totals", f"""WITH {S.JSEQ_CTE},
pf AS (SELECT recording, frame, part, side, sum(step) AS v FROM jsteps JOIN parts USING (joint) WHERE has_prev GROUP BY ALL),
ps AS (SELECT recording, part, side, avg(v) AS mean, stddev_pop(v) AS std, quantile_cont(v, 0.5) AS median FROM pf GROUP BY ALL)
SELECT recording, side, round(sum(mean), 6) AS total_mean, round(sum(std), 6) AS total_std, round(sum(median), 6) AS total_median
FROM ps GROUP BY ALL""")
def q_seq_side_totals(spark, d):
    return round_all(seq.side_totals(_part_stats(spark, d, include_first=False, ddof=0), ["recording"]))


@register("seq_pair_distance", f"""WITH {S.JSEQ_CTE},
a AS (SELECT recording, frame, x, y FROM jseq WHERE joint = 0), b AS (SELECT recording, frame, x, y FROM jseq WHERE joint = 1)
SELECT recording, round(avg(sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2)), 6) AS mean_distance,
       round(sqrt(sum((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2)), 6) AS frobenius
FROM a JOIN b USING (recording, frame) GROUP BY ALL""")
def q_seq_pair_distance(spark, d):
    return round_all(seq.pair_distance(tables.joint_sequence_frame(spark, d), ["recording"], 0, 1))


@register("seq_per_frame_totals", f"""WITH {S.JSEQ_CTE}
SELECT recording, side, round(sum(step) / count(DISTINCT frame), 6) AS per_frame FROM jsteps JOIN parts USING (joint) GROUP BY ALL""")
def q_seq_per_frame_totals(spark, d):
    js = seq.step_table(tables.joint_sequence_frame(spark, d), JKEYS).join(tables.joint_parts(spark), "joint")
    return round_all(seq.per_frame_totals(js, ["recording", "side"]))


@register("seq_side_asymmetry", f"""WITH {S.JSEQ_CTE},
f AS (SELECT recording, joint, sum(step) AS path_length, max(x) - min(x) AS amp_x FROM jsteps GROUP BY ALL),
s AS (SELECT f.*, p.side FROM f JOIN parts p USING (joint))
SELECT recording, round(avg(path_length) FILTER (WHERE side = 'l') - avg(path_length) FILTER (WHERE side = 'r'), 6) AS path_length_diff,
       round(avg(amp_x) FILTER (WHERE side = 'l') - avg(amp_x) FILTER (WHERE side = 'r'), 6) AS amp_x_diff FROM s GROUP BY ALL""")
def q_seq_side_asymmetry(spark, d):
    f = seq.motion_features(tables.joint_sequence_frame(spark, d), JKEYS).join(tables.joint_parts(spark), "joint")
    return round_all(seq.side_asymmetry(f, "recording", "side", ["path_length", "amp_x"]))


@register("agg_crosstab_total", """SELECT o_custkey, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS F,
  nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS O, nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS P, count(*) AS total
FROM orders GROUP BY ALL""")
def q_agg_crosstab_total(spark, d):
    from ..operators import reshape
    ct = reshape.crosstab(_orders(spark, d), "o_custkey", "o_orderstatus", ["F", "O", "P"], total=True)
    return ct.select("o_custkey", "F", "O", "P", "total")


@register("agg_label_counts", "SELECT label, count(*) AS count FROM embeddings GROUP BY ALL")
def q_agg_label_counts(spark, d):
    from ..operators import reshape
    return reshape.label_counts(tables.read_table(spark, d, "embeddings"), "label")


@register("pose_abs_differences", f"""WITH {S.POSE_CTE} SELECT row_id,
  abs(features[23] - features[25]) AS absdiff_xmean11_xmean12, abs(features[2] - features[16]) AS absdiff_ymean0_ymean7 FROM pose""")
def q_pose_abs_differences(spark, d):
    from ..operators import pose, reshape
    u = pose.unpack(_pose(spark, d), "features", 16, keep=["row_id"])
    return reshape.abs_differences(u, [("xmean11", "xmean12"), ("ymean0", "ymean7")], keep=["row_id"])


@register("board_param_key_groups", """WITH p AS (
  SELECT o_orderkey, o_orderpriority, CAST(o_orderkey % 3 AS VARCHAR) AS a FROM orders)
SELECT '{"reg__a":"' || a || '","reg__prio":"' || o_orderpriority || '"}' AS param_key, count(*) AS n_candidates
FROM p GROUP BY ALL""")
def q_board_param_key_groups(spark, d):
    from ..operators import reshape
    o = _orders(spark, d).select(F.create_map(F.lit("reg__prio"), F.col("o_orderpriority"), F.lit("other"),
                                              F.col("o_orderstatus"), F.lit("reg__a"),
                                              (F.col("o_orderkey") % 3).cast("string")).alias("params"))
    return o.groupBy(reshape.param_group_key("params", "reg__").alias("param_key")).agg(
        F.count(F.lit(1)).alias("n_candidates"))


def _groups_sql():
    """The greedy scan as a recursion over the features by variance."""
    terms = {n.replace(" ", "*").replace("^", "_"): " * ".join(f"{c}::DOUBLE" for c in cs) for n, cs in _poly_terms()}
    names = list(terms)
    var = ", ".join(f"var_samp(t{i}) AS v{i}" for i in range(len(names)))
    cor = ", ".join(f"abs(corr(t{i}, t{j})) AS r{i}_{j}" for i in range(len(names)) for j in range(i))
    o = " UNION ALL ".join(f"SELECT '{n}' AS name, {i} AS i, v{i} AS v FROM m" for i, n in enumerate(names))
    p = " UNION ALL ".join(f"SELECT '{names[a]}' AS a, '{names[b]}' AS b, r{max(a, b)}_{min(a, b)} AS c FROM m" for a in range(len(names)) for b in range(len(names)) if a != b)
    return f"""WITH RECURSIVE t AS (SELECT {', '.join(f'{e} AS t{i}' for i, e in enumerate(terms.values()))} FROM lineitem),
m AS (SELECT {var}, {cor} FROM t), o AS (SELECT name, row_number() OVER (ORDER BY v DESC, i) AS rk FROM ({o})), p AS ({p}),
n AS (SELECT o.name, o.rk, list(p.b) FILTER (WHERE p.c > 0.8) AS near FROM o JOIN p ON p.a = o.name GROUP BY ALL),
r AS (SELECT 0::BIGINT AS rk, []::VARCHAR[] AS used, NULL::VARCHAR AS keep, []::VARCHAR[] AS members
  UNION ALL SELECT n.rk, CASE WHEN list_contains(used, n.name) THEN used ELSE list_concat(used, list_append(list_filter(coalesce(n.near, []), lambda x: NOT list_contains(used, x)), n.name)) END,
    CASE WHEN NOT list_contains(used, n.name) THEN n.name END, list_append(list_filter(coalesce(n.near, []), lambda x: NOT list_contains(used, x)), n.name) FROM r JOIN n ON n.rk = r.rk + 1)
SELECT keep, unnest(members) AS member FROM r WHERE keep IS NOT NULL"""


def _poly_terms():
    from ..operators import select
    return select.polynomial_terms(POLY_COLS, 2)


@register("sel_correlated_groups", _groups_sql())
def q_sel_correlated_groups(spark, d):
    from ..operators import select
    poly = select.polynomial_features(_li(spark, d), POLY_COLS, 2)
    names = [n for n, _ in select.polynomial_terms(POLY_COLS, 2)]
    safe = poly.toDF(*[n.replace(" ", "*").replace("^", "_") for n in poly.columns])
    groups = select.greedy_correlated_groups(safe, safe.columns, 0.8)
    rows = [(g["keep"], m) for g in groups for m in [g["keep"], *g["drop"]]]
    return spark.createDataFrame(rows, "keep string, member string")


@register("scale_pca_variance", """WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_discount) AS b, corr(l_quantity, l_tax) AS c,
  corr(l_extendedprice, l_discount) AS d, corr(l_extendedprice, l_tax) AS e, corr(l_discount, l_tax) AS f FROM lineitem)
SELECT round(1.0, 6) AS total, round((4 + 2 * (a * a + b * b + c * c + d * d + e * e + f * f)) / 16, 6) AS squares,
  round((4 + 6 * (a * a + b * b + c * c + d * d + e * e + f * f) + 6 * (a * b * d + a * c * e + b * c * f + d * e * f)) / 64, 6) AS cubes FROM c""")
def q_scale_pca_variance(spark, d):
    """The power sums of the explained-variance ratios are traces of powers of the correlation
    matrix: three of them and the sum fix four ratios up to rounding."""
    from ..operators import scale
    v = scale.pca_variance(_li(spark, d), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    r = F.col("explained_variance_ratio")
    return round_all(v.agg(F.sum(r).alias("total"), F.sum(r * r).alias("squares"), F.sum(r * r * r).alias("cubes")))


# --------------------------------------------------------------------------- recording features

XKEYS = "patient_id, exercise_id, recording"
MOTION_CTE = S.JSEQ_CTE + f""",
ang AS (SELECT *, CASE WHEN has_prev THEN atan2(y - lag(y) OVER w, x - lag(x) OVER w) END AS angle FROM jsteps WINDOW w AS (PARTITION BY recording, joint ORDER BY frame)),
turn AS (SELECT *, abs(angle - lag(angle) OVER (PARTITION BY recording, joint ORDER BY frame)) AS dangle FROM ang),
jm AS (SELECT CAST(recording // 5 AS INTEGER) AS patient_id, 'E' || CAST(recording % 5 + 1 AS VARCHAR) AS exercise_id, recording, joint,
  sum(step) AS path, coalesce(avg(step) FILTER (WHERE has_prev), 0) AS mstep, count(*) AS t, max(x) - min(x) AS ax, max(y) - min(y) AS ay,
  count(*) FILTER (WHERE least(dangle, 2 * pi() - dangle) > 0.5) AS dirs, count(*) FILTER (WHERE dangle > pi() / 4) AS turns FROM turn GROUP BY ALL),
gap AS (SELECT a.recording, a.joint AS ja, b.joint AS jb, avg(sqrt((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2)) AS g, sqrt(sum((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2)) AS fro
  FROM jseq a JOIN jseq b USING (recording, frame) GROUP BY ALL)"""


def _jm(e, joint):
    return f"max({e}) FILTER (WHERE joint = {joint})"


def _gap(col, a, b):
    return f"(SELECT {col} FROM gap WHERE gap.recording = jm.recording AND ja = {a} AND jb = {b})"


def _w16_sql():
    out = []
    for s, pk, kn, ix in (("r", 17, 27, 19), ("l", 18, 26, 20)):
        for nme, j in (("pinky", pk), ("knee", kn)):
            out += [f"round({_jm('mstep', j)}, 6) AS {nme}_vel_{s}", f"round({_jm('path', j)}, 6) AS {nme}_dist_{s}", f"round({_jm('ax', j)}, 6) AS {nme}_amp_x_{s}",
                    f"round({_jm('ay', j)}, 6) AS {nme}_amp_y_{s}", f"{_jm('dirs', j)} AS {nme}_turns_{s}", f"round({_jm('path / CASE WHEN ay = 0 THEN 1 ELSE ay END', j)}, 6) AS {nme}_dist_norm_{s}"]
        out.append(f"round({_gap('g', pk, ix)}, 6) AS finger_gap_{s}")
    return f"WITH {MOTION_CTE} SELECT {XKEYS}, {', '.join(out)} FROM jm GROUP BY {XKEYS}"


@register("seq_recording_features", _w16_sql())
def q_seq_recording_features(spark, d):
    return round_all(seq.recording_features(tables.exercise_sequence_frame(spark, d), ["patient_id", "exercise_id", "recording"]))


def _w17_sql():
    on = lambda codes, e: f"CASE WHEN exercise_id IN ({', '.join(repr(c) for c in codes)}) THEN {e} END"
    fro = lambda a, b: _gap("fro", a, b)
    out = []
    for s, pk, kn, ix, wr in (("r", 17, 27, 19, 16), ("l", 18, 26, 20, 15)):
        speed = lambda j: f"round({_jm('path * 30 / t', j)}, 6)"
        norm = lambda j: f"round({_jm('coalesce(path / nullif(2 * ay, 0), 0)', j)}, 6)"
        amp = lambda j: f"round({_jm('ay', j)}, 6)"
        out += [f"{on(['E3', 'E4'], speed(pk))} AS pinky_speed_{s}", f"{on(['E3', 'E4'], amp(pk))} AS pinky_amp_{s}", f"{on(['E3'], f'round({fro(pk, ix)}, 6)')} AS finger_gap_{s}",
                f"{on(['E3'], speed(wr))} AS wrist_speed_{s}", f"{on(['E4'], norm(pk))} AS pinky_path_{s}", f"{on(['E5'], amp(kn))} AS knee_amp_{s}", f"{on(['E5'], norm(kn))} AS knee_path_{s}",
                f"{on(['E5'], speed(kn))} AS knee_speed_{s}", f"{on(['E5'], _jm('turns', kn))} AS knee_turns_{s}"]
    return f"WITH {MOTION_CTE} SELECT recording, exercise_id, {', '.join(out)} FROM jm GROUP BY recording, exercise_id"


@register("seq_exercise_features", _w17_sql())
def q_seq_exercise_features(spark, d):
    return round_all(seq.exercise_features(tables.exercise_sequence_frame(spark, d), ["recording"], "exercise_id"))


def _w18_sql():
    out = []
    for nme, r, left, codes in (("pinky", 17, 18, "'E1', 'E2', 'E3', 'E4'"), ("toe", 31, 30, "'E4', 'E5'"), ("knee", 27, 26, "'E4', 'E5'")):
        for s, j in (("r", r), ("l", left)):
            for f, e in (("distance", "path"), ("velocity", "path * 30 / t"), ("amplitude", "ax + ay")):
                out.append(f"CASE WHEN exercise_id IN ({codes}) THEN round({_jm(e, j)}, 6) END AS {nme}_{s}_{f}")
    return f"WITH {MOTION_CTE} SELECT recording, exercise_id, {', '.join(out)} FROM jm GROUP BY recording, exercise_id"


@register("seq_feature_families", _w18_sql())
def q_seq_feature_families(spark, d):
    return round_all(seq.feature_families(tables.exercise_sequence_frame(spark, d), ["recording"], "exercise_id"))


def _a14_sql():
    m = lambda e, j, c: f"coalesce(avg({c}) FILTER (WHERE exercise_id = '{e}' AND joint = {j}), 0)"
    out = []
    for e, nme, r, left in (("E3", "pinky", 17, 18), ("E4", "pinky", 17, 18), ("E5", "knee", 27, 26)):
        out += [f"round({m(e, r, 'mstep')} - {m(e, left, 'mstep')}, 6) AS {nme}_speed_{e}", f"round({m(e, r, 'ay')} - {m(e, left, 'ay')}, 6) AS {nme}_amp_{e}"]
        if e != "E3":
            norm = lambda j: f"coalesce({m(e, j, 'path')} / nullif(2 * {m(e, j, 'ay')}, 0), 0)"
            out.append(f"round({norm(r)} - {norm(left)}, 6) AS {nme}_path_{e}")
    return f"WITH {MOTION_CTE} SELECT patient_id, {', '.join(out)} FROM jm GROUP BY patient_id"


@register("seq_asymmetry_vector", _a14_sql())
def q_seq_asymmetry_vector(spark, d):
    return round_all(seq.asymmetry_vector(tables.exercise_sequence_frame(spark, d), "patient_id", "recording", "exercise_id"))


@register("seq_part_jitter", f"""WITH {S.JSEQ_CTE},
sm AS (SELECT *, sum(x) OVER w / 4 AS mx, sum(y) OVER w / 4 AS my FROM jseq WINDOW w AS (PARTITION BY recording, joint ORDER BY frame ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
pf AS (SELECT recording, frame, part, side, sum(sqrt((x - mx) ^ 2 + (y - my) ^ 2)) AS v FROM sm JOIN parts USING (joint) GROUP BY ALL)
SELECT recording, part, side, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(quantile_cont(v, 0.5), 6) AS median FROM pf GROUP BY ALL""")
def q_seq_part_jitter(spark, d):
    st = seq.motion_steps(tables.joint_sequence_frame(spark, d), JKEYS).select("recording", "joint", "frame", "jitter")
    return round_all(seq.part_stats(st, tables.joint_parts(spark), ["recording"], "jitter"))


# --------------------------------------------------------------------------- model runs and curves

MODEL_GRID = [{"model": "ols"}, {"model": "ridge", "reg": 0.5}]
GRID_COLS = ["l_quantity", "l_discount", "l_tax"]


def _grid_scores(spark, d):
    from ..operators import models
    li = _li(spark, d).withColumn("fold", F.col("l_linenumber") % 3)
    return models.grid_fold_scores(li, ["l_quantity"], "l_extendedprice", MODEL_GRID, "fold")


GRID_SQL = """fl AS (SELECT l_linenumber % 3 AS fold, l_quantity AS x, l_extendedprice AS y FROM lineitem),
fit AS (SELECT k.fold, m.model, covar_pop(x, y) / (var_pop(x) + m.reg) AS b, avg(y) - covar_pop(x, y) / (var_pop(x) + m.reg) * avg(x) AS a
  FROM (SELECT DISTINCT fold FROM fl) k JOIN fl ON fl.fold <> k.fold, (VALUES ('ols', 0.0::DOUBLE), ('ridge', 0.5::DOUBLE)) m(model, reg) GROUP BY k.fold, m.model, m.reg),
preds AS (SELECT fit.model, fit.fold, CASE WHEN fl.fold = fit.fold THEN 'val' ELSE 'train' END AS set, y AS y_true, a + b * x AS y_pred FROM fl, fit)"""


@register("ml_grid_fold_scores", f"WITH {GRID_SQL} " + reg_score_sql("model, fold, set"))
def q_ml_grid_fold_scores(spark, d):
    from ..operators import metrics
    return _reg_scores_rounded(metrics.regression_scores(_grid_scores(spark, d), ["model", "fold", "set"]))


@register("board_score_curve", f"WITH {GRID_SQL}, sc AS (" + reg_score_sql("model, fold, set", False) + """)
SELECT model, set, fold, round(avg(r2), 6) AS mean_score, count(*) AS n_scores FROM sc WHERE model = 'ridge' GROUP BY ALL""")
def q_board_score_curve(spark, d):
    from ..operators import metrics
    sc = metrics.regression_scores(_grid_scores(spark, d), ["model", "fold", "set"])
    return round_all(metrics.score_curve(sc, "fold", "r2", "ridge", by=["set"]))


@register("board_mean_score", f"WITH {GRID_SQL}, sc AS (" + reg_score_sql("model, fold, set", False) + """)
SELECT model, fold, round(avg(r2), 6) AS mean_score, count(*) AS n_scores FROM sc GROUP BY ALL""")
def q_board_mean_score(spark, d):
    from ..operators import metrics
    sc = metrics.regression_scores(_grid_scores(spark, d), ["model", "fold", "set"])
    return round_all(metrics.score_curve(sc, "fold", "r2"))


LEARN_SIZES = list(range(140, 581, 40))


@register("fold_learning_curve", f"""WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY {H_ORDER}, o_orderkey) - 1 AS rn FROM orders),
p AS (SELECT s.size, c.param, (o_totalprice - (SELECT avg(o_totalprice) FROM r z WHERE z.rn < s.size) * c.param / 4) ^ 2 AS e
  FROM (SELECT unnest({LEARN_SIZES}) AS size) s JOIN r ON r.rn < s.size, (SELECT unnest([2.0, 3.0, 4.0, 5.0])::DOUBLE AS param) c),
sc AS (SELECT size, param, -avg(e) AS score FROM p GROUP BY ALL),
b AS (SELECT size, first(param ORDER BY score DESC, param) AS best FROM sc GROUP BY size)
SELECT round(regr_slope(best, size), 6) AS slope, round(regr_intercept(best, size), 6) AS intercept,
  round(regr_intercept(best, size) + regr_slope(best, size) * 700, 6) AS extrapolated FROM b""")
def q_fold_learning_curve(spark, d):
    """Samples of growing size, nested in hash order; a shrunken mean per parameter; its error."""
    from ..operators import folds
    sizes = folds.nested_samples(_orders(spark, d).select("o_orderkey", "o_totalprice"), "o_orderkey", LEARN_SIZES)
    mean = sizes.groupBy("size").agg(F.avg("o_totalprice").alias("m"))
    sized = sizes.join(mean, "size").select("size", "o_totalprice", "m", F.explode(F.array(*[F.lit(float(p)) for p in (2, 3, 4, 5)])).alias("param"))
    e = F.col("o_totalprice") - F.col("m") * F.col("param") / 4
    sc = sized.groupBy("size", "param").agg((-F.avg(e * e)).alias("score"))
    return round_all(folds.learning_curve(sc, "size", "param", "score", 700.0))


@register("quality_impute_mode", """WITH v AS (SELECT o_orderkey AS id, 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders),
r AS (SELECT s.seed, v.*, row_number() OVER (PARTITION BY s.seed, "column" ORDER BY CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || 'imp' || s.seed), 1, 8)) AS BIGINT), id) - 1 AS rn,
        count(*) OVER (PARTITION BY s.seed, "column") AS n FROM v, (SELECT unnest([0, 1]) AS seed) s),
c AS (SELECT seed, "column", value, count(*) AS k FROM r WHERE rn >= floor(n * 0.1) GROUP BY ALL),
f AS (SELECT seed, "column", first(value ORDER BY k DESC, value) AS fill FROM c GROUP BY ALL),
e AS (SELECT r.seed, r."column", avg(CAST(value = fill AS DOUBLE)) AS score, count(*) AS nm FROM r JOIN f USING (seed, "column") WHERE rn < floor(n * 0.1) GROUP BY ALL)
SELECT "column", round(avg(score), 6) AS score, round(avg(nm), 6) AS n_masked FROM e GROUP BY ALL""")
def q_quality_impute_mode(spark, d):
    from ..operators import quality
    return round_all(quality.evaluate_imputer(_orders(spark, d), "o_orderkey", ["o_orderstatus", "o_orderpriority"], "mode", 0.1, (0, 1)))


@register("quality_impute_median", """WITH v AS (SELECT p_partkey AS id, 'p_retailprice' AS "column", p_retailprice AS value FROM part UNION ALL SELECT p_partkey, 'p_size', p_size FROM part),
r AS (SELECT v.*, row_number() OVER (PARTITION BY "column" ORDER BY CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || 'imp7'), 1, 8)) AS BIGINT), id) - 1 AS rn, count(*) OVER (PARTITION BY "column") AS n FROM v),
f AS (SELECT "column", quantile_cont(value, 0.5) AS fill FROM r WHERE rn >= floor(n * 0.2) GROUP BY ALL)
SELECT "column", round(sqrt(avg((value - fill) ^ 2)), 6) AS score, round(count(*)::DOUBLE, 6) AS n_masked FROM r JOIN f USING ("column") WHERE rn < floor(n * 0.2) GROUP BY ALL""")
def q_quality_impute_median(spark, d):
    from ..operators import quality
    p = tables.read_table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    return round_all(quality.evaluate_imputer(p, "p_partkey", ["p_retailprice", "p_size"], "median", 0.2, (7,)))


@register("sel_corr_histogram", f"""WITH p AS (SELECT {_poly_sql()}, l_extendedprice FROM lineitem), c AS (
  {_pairs_sql([n for n, _ in __import__('ferrule.operators.select', fromlist=['x']).polynomial_terms(POLY_COLS, 2)], 'p', digits=None)}),
n AS (SELECT CAST(least(floor(abs_corr / 0.05), 19) AS INTEGER) AS bin, count(*) AS k FROM c GROUP BY ALL)
SELECT CAST(b.bin AS INTEGER) AS bin, round(b.bin * 0.05, 6) AS bin_lo, round((b.bin + 1) * 0.05, 6) AS bin_hi, coalesce(k, 0) AS count
FROM (SELECT unnest(range(20)) AS bin) b LEFT JOIN n USING (bin)""")
def q_sel_corr_histogram(spark, d):
    """Bins of 0.05 over the absolute correlations."""
    from ..operators import profile, select
    poly = select.polynomial_features(_li(spark, d), POLY_COLS, 2)
    pairs = select.corr_pairs(poly, [f"`{n}`" for n, _ in select.polynomial_terms(POLY_COLS, 2)])
    return round_all(profile.shared_histogram(pairs.select("abs_corr"), ["abs_corr"], 20, (0.0, 1.0)).drop("column"))


@register("reshape_columns_by_pattern", f"WITH {S.POSE_CTE} SELECT row_id, " + ", ".join(f"-{_pc('ymean', j)} AS ymean{j}" for j in range(16)) + " FROM pose")
def q_reshape_columns_by_pattern(spark, d):
    """the columns whose name matches."""
    from ..operators import pose
    u = pose.unpack(_pose(spark, d), "features", 16, keep=["row_id"], negate_y=True)
    return u.select("row_id", u.colRegex("`ymean.*`"))


@register("board_best_per_family", f"WITH {GRID_SQL}, sc AS (" + reg_score_sql("model, fold, set", False) + """)
SELECT set, model, fold, round(r2, 6) AS r2, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY set ORDER BY r2 DESC, model, fold) AS rank FROM sc) WHERE rank <= 2""")
def q_board_best_per_family(spark, d):
    from ..operators import metrics
    sc = metrics.regression_scores(_grid_scores(spark, d), ["model", "fold", "set"])
    best = metrics.best_per_group(sc, ["set"], "r2", ["model", "fold"], 2)
    return round_all(best.select("set", "model", "fold", "r2", F.col("rank").cast("int").alias("rank")))


@register("reshape_distinct_sorted", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_reshape_distinct_sorted(spark, d):
    from ..operators import reshape
    return reshape.distinct_sorted(_orders(spark, d), ["o_orderstatus", "o_orderpriority"])


@register("reshape_rename_models", f"WITH {S.REG_PRED_CTE} SELECT regexp_replace(model, '^qty_x_', 'factor ') AS model, count(*) AS n FROM preds GROUP BY ALL")
def q_reshape_rename_models(spark, d):
    from ..operators import reshape
    p = reshape.rename_models(tables.regression_predictions(spark, d), "model", "^qty_x_", "factor ")
    return p.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


@register("prof_missing_mask", f"WITH {S.MISSING_CTE} SELECT " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in MISS_COLS) + " FROM miss")
def q_prof_missing_mask(spark, d):
    from ..operators import profile
    return profile.missing_mask(tables.missing_frame(spark, d), MISS_COLS)


@register("pose_select_slots", f"WITH {S.POSE_CTE} SELECT row_id, CAST(k - 1 AS INTEGER) AS pos, features[[8, 3, 60][k] + 1] AS value FROM pose, range(1, 4) t(k)")
def q_pose_select_slots(spark, d):
    from ..operators import pose
    return _pose(spark, d).select("row_id", F.posexplode(pose.select_joints("features", [8, 3, 60])).alias("pos", "value"))


@register("pose_one_hot_observed", "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderstatus = '{v}' AS INTEGER) AS o_orderstatus_{v}" for v in "FOP") + " FROM orders")
def q_pose_one_hot_observed(spark, d):
    from ..operators import pose
    return pose.one_hot_observed(_orders(spark, d).select("o_orderkey", "o_orderstatus"), "o_orderstatus").drop("o_orderstatus")


def _mi_gain_sql():
    prods = {f"{a}*{b}": (a, b) for i, a in enumerate(POLY_COLS) for b in POLY_COLS[i + 1:]}
    src = "wide AS (SELECT *, " + ", ".join(f'{a} * {b} AS "{k}"' for k, (a, b) in prods.items()) + " FROM lineitem)"
    named = {**{c: c for c in POLY_COLS}, **{k: f'"{k}"' for k in prods}}
    plain = {k: f"c{i}" for i, k in enumerate(named)}
    src += ", lw AS (SELECT l_extendedprice, " + ", ".join(f"{v} AS {plain[k]}" for k, v in named.items()) + " FROM wide)"
    mi = _mi_sql(list(plain.values()), "l_extendedprice").replace("lineitem", "lw").replace("WITH edges", "edges").replace("round(sum(", "(sum(").replace(", 6) AS mutual_information", ") AS mutual_information")
    head, tail = mi.rsplit("\nSELECT", 1)
    rows = "\nUNION ALL\n".join(f"""SELECT '{a}' AS a, '{b}' AS b, round((SELECT mutual_information FROM mi WHERE "column" = '{plain[f'{a}*{b}' if f'{a}*{b}' in prods else f'{b}*{a}']}')
  - (SELECT mutual_information FROM mi WHERE "column" = '{plain[b]}'), 6) AS mi_gain""" for a in POLY_COLS for b in POLY_COLS if a != b)
    return f"WITH {src}, {head},\nmi AS (SELECT{tail})\n{rows}"


@register("sel_mi_gain_of_products", _mi_gain_sql())
def q_sel_mi_gain_of_products(spark, d):
    from ..operators import select
    return round_all(select.mi_gain_of_products(_li(spark, d), POLY_COLS, "l_extendedprice", 10))


from . import artifact_queries, reductions, screening, selection  # noqa: E402, F401  (register their queries)
