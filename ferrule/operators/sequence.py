"""Ordered-sequence (motion) operators over a long frame table.

Working form: one row per ``(recording..., joint, frame)`` with coordinates
``x`` (and optionally ``y``).  Every look-back is bounded (at most
``smooth_window - 1`` frames), so windows run per ``(recording, joint, block)``
with halo rows (see ``ordering.with_lookback``); a single very long recording
is spread over many tasks.  Per-recording results are plain grouped
aggregates (map-side combined).

Variants of the reference are parameters:
* ``include_first``  step table with the first frame as a 0 step (T rows,
  ``diff().fillna(0)``) or without it (T-1 rows, ``np.diff``);
* ``ddof``           0 (numpy) or 1 (pandas) for standard deviations;
* speeds ``speed_per_frame`` = sum*fps/T and ``speed_mean`` = mean step*fps;
* direction changes wrapped (threshold 0.5 rad) and orientation changes
  unwrapped (threshold pi/4).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import div_or
from .ordering import attach_group, block_window, number_rows, own_rows, with_lookback
from .quantile import quantiles_long


def motion_steps(df: DataFrame, by: Sequence[str], frame: str = "frame", x: str = "x",
                 y: str | None = "y", smooth_window: int = 4,
                 block_rows: int = 1 << 20) -> DataFrame:
    """Per frame: ``has_prev, dx, dy, step, angle, dangle, sx, sy, jitter``.

    * ``dx, dy``  difference to the previous frame, 0 on the first (W1)
    * ``step``    Euclidean step length (|dx| in 1-D), 0 on the first (W2)
    * ``angle``   atan2(dy, dx) of the step (0 for a zero step), NULL on the first
    * ``dangle``  |angle - previous angle|, NULL without two steps (W7)
    * ``sx, sy``  trailing mean over ``smooth_window`` frames, zero padded (W8)
    * ``jitter``  ||(x, y) - (sx, sy)|| (W9)
    """
    by = list(by)
    halo = max(2, smooth_window - 1)
    t = with_lookback(df, frame, halo, block_rows)
    w = block_window(by, frame)
    frame_w = w.rowsBetween(-(smooth_window - 1), 0)
    t = t.withColumn("has_prev", F.lag(frame).over(w).isNotNull())
    t = t.withColumn("dx", F.when(F.col("has_prev"), F.col(x) - F.lag(x).over(w)).otherwise(F.lit(0.0)))
    if y is not None:
        t = t.withColumn("dy", F.when(F.col("has_prev"), F.col(y) - F.lag(y).over(w)).otherwise(F.lit(0.0)))
        t = t.withColumn("step", F.hypot("dx", "dy"))
    else:
        t = t.withColumn("dy", F.lit(0.0)).withColumn("step", F.abs("dx"))
    t = t.withColumn("angle", F.when(F.col("has_prev"), F.atan2(F.col("dy"), F.col("dx"))))
    t = t.withColumn("dangle", F.abs(F.col("angle") - F.lag("angle").over(w)))
    t = t.withColumn("sx", F.sum(x).over(frame_w) / float(smooth_window))
    if y is not None:
        t = t.withColumn("sy", F.sum(y).over(frame_w) / float(smooth_window))
        t = t.withColumn("jitter", F.hypot(F.col(x) - F.col("sx"), F.col(y) - F.col("sy")))
    else:
        t = t.withColumn("sy", F.lit(0.0)).withColumn("jitter", F.abs(F.col(x) - F.col("sx")))
    return own_rows(t)


def wrapped(d: Column) -> Column:
    """Smallest angle between two directions: min(d, 2*pi - d)."""
    return F.least(d, F.lit(2 * math.pi) - d)


def motion_features(df: DataFrame, by: Sequence[str], frame: str = "frame", x: str = "x",
                    y: str | None = "y", fps: float = 1.0, angle_thresh: float = 0.5,
                    orient_thresh: float = math.pi / 4, smooth_window: int = 4) -> DataFrame:
    """One row per sequence (W4-W7, W9, W14): path length, speeds, amplitudes,
    direction/orientation changes, jitter mean and normalised paths."""
    s = motion_steps(df, by, frame, x, y, smooth_window)
    amp_y = (F.max(y) - F.min(y)) if y is not None else F.lit(0.0)
    agg = s.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.sum("step").alias("path_length"),
        F.avg(F.when(F.col("has_prev"), F.col("step"))).alias("_mstep"),
        (F.max(x) - F.min(x)).alias("amp_x"),
        amp_y.alias("amp_y"),
        F.count_if(wrapped(F.col("dangle")) > angle_thresh).alias("direction_changes"),
        F.count_if(F.col("dangle") > orient_thresh).alias("orientation_changes"),
        F.avg("jitter").alias("jitter_mean"))
    path, ay = F.col("path_length"), F.col("amp_y")
    return agg.select(
        *by, "n_frames", "path_length",
        (path * fps / F.col("n_frames")).alias("speed_per_frame"),
        (F.coalesce(F.col("_mstep"), F.lit(0.0)) * fps).alias("speed_mean"),
        "amp_x", "amp_y", (F.col("amp_x") + ay).alias("amplitude"),
        "direction_changes", "orientation_changes", "jitter_mean",
        F.coalesce(F.try_divide(path, 2 * ay), F.lit(0.0)).alias("path_norm_2amp"),
        (path / F.when(ay == 0, F.lit(1.0)).otherwise(ay)).alias("path_norm_amp"),
        F.coalesce(F.try_divide(2 * ay, path), F.lit(0.0)).alias("amp_norm_path"))


def sign_flips_1d(df: DataFrame, by: Sequence[str], frame: str = "frame", x: str = "x") -> DataFrame:
    """1-D direction changes (W7c): sign flips between consecutive non-zero steps.
    Zero steps are removed and the remaining steps renumbered (skew tolerant), so
    the comparison partner is always one row back."""
    by = list(by)
    s = motion_steps(df, by, frame, x, None).where(F.col("has_prev") & (F.col("dx") != 0))
    s = number_rows(s.select(*by, frame, F.signum("dx").alias("sg")), by, [frame], "_k")
    t = with_lookback(s, "_k", 1)
    t = t.withColumn("_prev", F.lag("sg").over(block_window(by, "_k")))
    t = own_rows(t)
    flips = t.groupBy(*by).agg(F.count_if(F.col("_prev").isNotNull() & (F.col("_prev") != F.col("sg")))
                               .alias("sign_flips"))
    keys = df.select(*by).distinct()
    f = flips.select(*[F.col(b).alias("_f_" + b) for b in by], "sign_flips")
    same = F.lit(True)
    for b in by:
        same = same & keys[b].eqNullSafe(f["_f_" + b])
    return keys.join(f, same, "left").select(*by, F.coalesce("sign_flips", F.lit(0)).alias("sign_flips"))


def step_table(df: DataFrame, by: Sequence[str], frame: str = "frame", x: str = "x",
               y: str = "y", include_first: bool = True) -> DataFrame:
    """W2 (T rows, first step 0) or W3 (T-1 rows)."""
    s = motion_steps(df, by, frame, x, y)
    if not include_first:
        s = s.where("has_prev")
    return s.select(*by, frame, "dx", "dy", "step")


def frame_position(df: DataFrame, by: Sequence[str], frame: str = "frame") -> DataFrame:
    """T / max(t) per sequence, 0 when the sequence has one frame."""
    last = df.groupBy(*by).agg(F.max(frame).alias("_last"))
    return attach_group(df, last, list(by)).withColumn(
        "t_norm", F.coalesce(F.try_divide(F.col(frame), F.col("_last")), F.lit(0.0))).drop("_last")


def per_frame_totals(df: DataFrame, by: Sequence[str], frame: str = "frame",
                     value: str = "step") -> DataFrame:
    """Total per sequence divided by its number of distinct frames."""
    return df.groupBy(*by).agg(F.try_divide(F.sum(value), F.count_distinct(frame)).alias("per_frame"))


def part_stats(steps: DataFrame, parts: DataFrame, recording: Sequence[str], value: str,
               frame: str = "frame", joint: str = "joint", ddof: int = 0) -> DataFrame:
    """Per frame, sum ``value`` over the joints of each (part, side); then
    mean, std (ddof 0 or 1) and exact median over frames per (recording, part,
    side).  ``parts`` is a small ``(part, side, joint)`` dimension."""
    rec = list(recording)
    j = steps.join(parts, joint, "inner")
    per_frame = j.groupBy(*rec, frame, "part", "side").agg(F.sum(value).alias("_v"))
    std = F.stddev_pop("_v") if ddof == 0 else F.stddev_samp("_v")
    moments = per_frame.groupBy(*rec, "part", "side").agg(F.avg("_v").alias("mean"), std.alias("std"))
    med = quantiles_long(per_frame, [*rec, "part", "side"], [0.5], value="_v").select(
        *rec, "part", "side", F.col("quantile").alias("median"))
    return attach_group(moments, med, [*rec, "part", "side"], "left")


def side_totals(stats: DataFrame, recording: Sequence[str]) -> DataFrame:
    """Per recording and side: the part statistics summed over parts (W10 totals)."""
    return stats.groupBy(*recording, "side").agg(
        F.sum("mean").alias("total_mean"), F.sum("std").alias("total_std"),
        F.sum("median").alias("total_median"))


def pair_distance(df: DataFrame, recording: Sequence[str], joint_a: int, joint_b: int,
                  frame: str = "frame", joint: str = "joint", x: str = "x", y: str = "y") -> DataFrame:
    """W12 mean and W13 Frobenius distance between two joints over common frames."""
    a = df.where(F.col(joint) == joint_a).select(*recording, frame, F.col(x).alias("_ax"), F.col(y).alias("_ay"))
    b = df.where(F.col(joint) == joint_b).select(*recording, frame, F.col(x).alias("_bx"), F.col(y).alias("_by"))
    d = attach_group(a.where(F.col(frame).isNotNull()), b, [*recording, frame]).withColumn(
        "_d", F.hypot(F.col("_ax") - F.col("_bx"), F.col("_ay") - F.col("_by")))
    return d.groupBy(*recording).agg(F.coalesce(F.avg("_d"), F.lit(0.0)).alias("mean_distance"),
                                     F.sqrt(F.sum(F.col("_d") * F.col("_d"))).alias("frobenius"))


def flatten_frames(df: DataFrame, by: Sequence[str], values: Sequence[str], frames: int, fill: float = 0.0, frame: str = "frame", name: str = "f") -> DataFrame:
    """A sequence as wide rows ``(by..., piece, n_frames, f0..fN)``: the values of ``frames``
    frames side by side in order, ``fill`` where a frame or a value is missing.  A sequence longer
    than that goes on in the next piece, so no group is larger than a piece and the width
    doesn't grow with the data.  Frames count from 0; a NULL frame has no place and is left out;
    of frames that occur twice the greatest values are taken."""
    at = F.col(frame).cast("long")
    rows = df.where(at.isNotNull()).select(*by, F.expr(f"`{frame}` div {frames}").alias("piece"), (at % frames).cast("int").alias("_at"),
                                           *[F.col(v).cast("double").alias(f"_v{j}") for j, v in enumerate(values)])
    slots = [F.expr(f"coalesce(max(IF(_at = {i}, _v{j}, NULL)), {float(fill)}D) AS {name}{i * len(values) + j}") for i in range(frames) for j in range(len(values))]
    return rows.groupBy(*by, "piece").agg(F.count_distinct("_at").alias("n_frames"), *slots)


def patient_exercise_matrix(features: DataFrame, patient: str, exercise: str,
                            codes: Sequence[str], value_cols: Sequence[str],
                            fill_value: float = 0.0) -> DataFrame:
    """Per patient, mean of every feature per exercise code, a presence flag
    and a count per code; missing codes filled with ``fill_value``."""
    piv = features.groupBy(patient).pivot(exercise, list(codes)).agg(
        *[F.avg(c).alias(c) for c in value_cols], F.count(F.lit(1)).alias("n"))
    out = [F.col(patient)]
    for code in codes:
        out.append(F.coalesce(F.col(f"{code}_n"), F.lit(0)).alias(f"{code}_count"))
        out.append((F.coalesce(F.col(f"{code}_n"), F.lit(0)) > 0).cast("int").alias(f"{code}_present"))
        for c in value_cols:
            out.append(F.coalesce(F.col(f"{code}_{c}"), F.lit(fill_value)).alias(f"{code}_{c}"))
    return piv.select(*out)


def side_asymmetry(features: DataFrame, patient: str, side: str, value_cols: Sequence[str],
                   left: str = "l", right: str = "r") -> DataFrame:
    """Left - right difference of per-patient means for every feature."""
    agg = features.groupBy(patient).agg(*[
        F.avg(F.when(F.col(side) == s, F.col(c))).alias(f"{c}_{s}")
        for c in value_cols for s in (left, right)])
    return agg.select(patient, *[(F.col(f"{c}_{left}") - F.col(f"{c}_{right}")).alias(f"{c}_diff")
                                 for c in value_cols])


# Joints of the recording features (name -> joint id in the sequence layout).
MOTION_JOINTS = {"pinky_r": 17, "pinky_l": 18, "index_r": 19, "index_l": 20, "wrist_r": 16, "wrist_l": 15, "knee_r": 27, "knee_l": 26, "toe_r": 31, "toe_l": 30}


def joint_motion(df: DataFrame, recording: Sequence[str], joints: dict, fps: float = 1.0, joint: str = "joint") -> DataFrame:
    """Motion features of the named joints, one wide row per recording: columns
    ``<name>__<feature>`` of ``motion_features``.  One grouped aggregate over the long frame
    table, then a pivot over the fixed names (a joint that is missing gives NULL)."""
    rec = list(recording)
    names = F.create_map(*[v for n, j in joints.items() for v in (F.lit(j), F.lit(n))])
    picked = df.where(F.col(joint).isin([int(j) for j in joints.values()])).withColumn("_name", names[F.col(joint)])
    f = motion_features(picked, [*rec, "_name"], fps=fps)
    feats = ["path_length", "speed_mean", "speed_per_frame", "amp_x", "amp_y", "amplitude", "direction_changes", "orientation_changes", "path_norm_2amp", "path_norm_amp"]
    return f.groupBy(*rec).agg(*[F.max(F.when(F.col("_name") == n, F.col(c))).alias(f"{n}__{c}") for n in joints for c in feats])


def recording_features(df: DataFrame, recording: Sequence[str], joints: dict = MOTION_JOINTS, fps: float = 1.0) -> DataFrame:
    """26 scalars per recording: pinky speed, distance, amplitudes, direction changes and
    mean gap to the index finger, knee amplitudes, distance, speed and direction changes,
    and the distances over the y amplitude (over 1 where that is 0)."""
    rec = list(recording)
    used = {n: joints[n] for n in ("pinky_r", "pinky_l", "knee_r", "knee_l")}
    m = joint_motion(df, rec, used, fps)
    out = []
    for s in "rl":
        c = lambda f, j=f"pinky_{s}": F.col(f"{j}__{f}")
        out += [c("speed_mean").alias(f"pinky_vel_{s}"), c("path_length").alias(f"pinky_dist_{s}"), c("amp_x").alias(f"pinky_amp_x_{s}"),
                c("amp_y").alias(f"pinky_amp_y_{s}"), c("direction_changes").alias(f"pinky_turns_{s}"), c("path_norm_amp").alias(f"pinky_dist_norm_{s}")]
        k = lambda f, j=f"knee_{s}": F.col(f"{j}__{f}")
        out += [k("speed_mean").alias(f"knee_vel_{s}"), k("path_length").alias(f"knee_dist_{s}"), k("amp_x").alias(f"knee_amp_x_{s}"),
                k("amp_y").alias(f"knee_amp_y_{s}"), k("direction_changes").alias(f"knee_turns_{s}"), k("path_norm_amp").alias(f"knee_dist_norm_{s}")]
    t = m.select(*rec, *out)
    for s in "rl":
        gap = pair_distance(df, rec, joints[f"pinky_{s}"], joints[f"index_{s}"]).select(*rec, F.col("mean_distance").alias(f"finger_gap_{s}"))
        t = _attach_left(t, gap, rec)
    return t


def _attach_left(df: DataFrame, other: DataFrame, keys: list) -> DataFrame:
    o = other.select(*[F.col(c).alias("_k_" + c) if c in keys else F.col(c) for c in other.columns])
    same = F.lit(True)
    for c in keys:
        same = same & df[c].eqNullSafe(o["_k_" + c])
    return df.join(o, same, "left").drop(*["_k_" + c for c in keys])


def exercise_features(df: DataFrame, recording: Sequence[str], exercise: str, joints: dict = MOTION_JOINTS, fps: float = 30.0) -> DataFrame:
    """Features that belong to the recording's exercise, NULL for the others.  E3: pinky
    speed, y amplitude and gap to the index finger (root of summed squares), wrist speed;
    E4: pinky speed, y amplitude and path over twice the amplitude; E5: knee y amplitude,
    normalised path, speed and orientation changes.  Speeds are path * fps / frames."""
    rec = list(recording)
    m = joint_motion(df, [*rec, exercise], {n: j for n, j in joints.items() if n[:-2] in ("pinky", "wrist", "knee")}, fps)
    for s in "rl":
        gap = pair_distance(df, [*rec, exercise], joints[f"pinky_{s}"], joints[f"index_{s}"]).select(*rec, exercise, F.col("frobenius").alias(f"_gap_{s}"))
        m = _attach_left(m, gap, [*rec, exercise])
    on = lambda *codes: F.col(exercise).isin(*codes)
    out = []
    for s in "rl":
        c = lambda j, f, s=s: F.col(f"{j}_{s}__{f}")
        out += [F.when(on("E3", "E4"), c("pinky", "speed_per_frame")).alias(f"pinky_speed_{s}"), F.when(on("E3", "E4"), c("pinky", "amp_y")).alias(f"pinky_amp_{s}"),
                F.when(on("E3"), F.col(f"_gap_{s}")).alias(f"finger_gap_{s}"), F.when(on("E3"), c("wrist", "speed_per_frame")).alias(f"wrist_speed_{s}"),
                F.when(on("E4"), c("pinky", "path_norm_2amp")).alias(f"pinky_path_{s}"), F.when(on("E5"), c("knee", "amp_y")).alias(f"knee_amp_{s}"),
                F.when(on("E5"), c("knee", "path_norm_2amp")).alias(f"knee_path_{s}"), F.when(on("E5"), c("knee", "speed_per_frame")).alias(f"knee_speed_{s}"),
                F.when(on("E5"), c("knee", "orientation_changes")).alias(f"knee_turns_{s}")]
    return m.select(*rec, exercise, *out)


# Joints measured per exercise group in the feature families.
FAMILY_JOINTS = {"pinky": ("E1", "E2", "E3", "E4"), "toe": ("E4", "E5"), "knee": ("E4", "E5")}


def feature_families(df: DataFrame, recording: Sequence[str], exercise: str, joints: dict = MOTION_JOINTS, fps: float = 30.0) -> DataFrame:
    """Distance, velocity (path * fps / frames) and amplitude (x + y range) of the joints
    that the exercise uses (``FAMILY_JOINTS``), NULL elsewhere."""
    rec = list(recording)
    used = {n: j for n, j in joints.items() if n[:-2] in FAMILY_JOINTS}
    m = joint_motion(df, [*rec, exercise], used, fps)
    return m.select(*rec, exercise, *[F.when(F.col(exercise).isin(*FAMILY_JOINTS[n[:-2]]), F.col(f"{n}__{c}")).alias(f"{n}_{name}")
                                      for n in used for name, c in (("distance", "path_length"), ("velocity", "speed_per_frame"), ("amplitude", "amplitude"))])


def asymmetry_vector(df: DataFrame, patient: str, recording: str, exercise: str, joints: dict = MOTION_JOINTS, fps: float = 1.0) -> DataFrame:
    """Per patient 8 right-minus-left differences of exercise means: E3 pinky speed and y
    amplitude; E4 the same and the mean distance over twice the mean amplitude; E5 the same
    three for the knee.  A missing exercise or a zero amplitude counts 0."""
    m = joint_motion(df, [patient, recording, exercise], {n: joints[n] for n in ("pinky_r", "pinky_l", "knee_r", "knee_l")}, fps)
    mean = lambda e, c: F.coalesce(F.avg(F.when(F.col(exercise) == e, F.col(c))), F.lit(0.0))
    parts = [("E3", "pinky"), ("E4", "pinky"), ("E5", "knee")]
    agg = m.groupBy(patient).agg(*[mean(e, f"{j}_{s}__{f}").alias(f"{e}_{s}_{f}") for e, j in parts for s in "rl" for f in ("speed_mean", "amp_y", "path_length")])
    out = []
    for e, j in parts:
        side = {s: div_or(F.col(f"{e}_{s}_path_length"), 2 * F.col(f"{e}_{s}_amp_y")) for s in "rl"}
        out += [(F.col(f"{e}_r_speed_mean") - F.col(f"{e}_l_speed_mean")).alias(f"{j}_speed_{e}"), (F.col(f"{e}_r_amp_y") - F.col(f"{e}_l_amp_y")).alias(f"{j}_amp_{e}")]
        if e != "E3":
            out.append((side["r"] - side["l"]).alias(f"{j}_path_{e}"))
    return agg.select(patient, *out)
