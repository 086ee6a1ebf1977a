"""Pose-summary array features.

A pose-summary row holds one array of 4n doubles in *blocked* layout::

    [xmean0, ymean0, ..., xmean{n-1}, ymean{n-1}, xstd0, ystd0, ..., ystd{n-1}]

Every feature is an array/arithmetic expression on that column (one projection,
whole-stage codegen); nothing leaves the JVM.  Joint roles (hands, torso,
knees, sides) are a ``Skeleton`` argument because the reference's own
definitions disagree between files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import attach_group
from .profile import attach_row

EPS = 1e-9  # |scale| below this is replaced by 1


@dataclass(frozen=True)
class Skeleton:
    n_joints: int
    hands: dict = field(default_factory=dict)          # side -> joint ids
    torso: tuple = (0, 0, 0, 0)                        # left shoulder, left hip, right shoulder, right hip
    diff_pairs: tuple = ()                             # (a, b) joint ids or '<side>_hand'
    knees: tuple = ()                                  # joint ids whose stds pass through
    sides: dict = field(default_factory=dict)          # side -> joint ids (std sums)


# The 33-keypoint layout used by the pose-summary feature row of the
# reference (hands, torso diagonals, difference pairs, knees, side lists).
POSE33 = Skeleton(
    n_joints=33,
    hands={"left": [15, 17, 19, 21], "right": [16, 18, 20, 22]},
    torso=(11, 23, 12, 24),
    diff_pairs=((25, 23), (26, 24), (27, 23), (28, 24), ("left_hand", 0), ("right_hand", 0),
                ("left_hand", 11), ("right_hand", 12), (13, 0), (14, 0), (13, 11), (14, 12)),
    knees=(25, 26),
    sides={"left": [4, 5, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24, 26, 28, 30, 32],
           "right": [1, 2, 3, 7, 9, 11, 13, 15, 17, 19, 21, 23, 25, 27, 29, 31]})

# The driver's 64-wide embedding stands in for a 16-joint skeleton (4 x 16 = 64):
# nose 0; odd ids on the left, even ids on the right.
POSE16 = Skeleton(
    n_joints=16,
    hands={"left": [7, 9], "right": [8, 10]},
    torso=(1, 11, 2, 12),
    diff_pairs=((13, 11), (14, 12), ("left_hand", 0), ("right_hand", 0), (3, 0), (4, 0)),
    knees=(13, 14),
    sides={"left": [1, 3, 5, 7, 9, 11, 13, 15], "right": [2, 4, 6, 8, 10, 12, 14]})

COMPONENTS = ("xmean", "ymean", "xstd", "ystd")


class Pose:
    """Element accessors for a blocked pose array column."""

    def __init__(self, col: str | Column, n_joints: int):
        self.a = F.col(col) if isinstance(col, str) else col
        self.n = n_joints

    def comp(self, name: str, j: int) -> Column:
        off = {"xmean": 2 * j, "ymean": 2 * j + 1, "xstd": 2 * self.n + 2 * j, "ystd": 2 * self.n + 2 * j + 1}[name]
        return self.a.getItem(off)

    def mean_of(self, name: str, joints: Sequence[int]) -> Column:
        e = F.lit(0.0)
        for j in joints:
            e = e + self.comp(name, j)
        return e / float(len(joints))


def check_width(df: DataFrame, col: str, n_joints: int) -> DataFrame:
    """Shape guard: every array must have 4 * n_joints values."""
    return df.withColumn(col, F.when(F.size(col) == 4 * n_joints, F.col(col)).otherwise(
        F.raise_error(F.concat(F.lit("pose array width "), F.size(col).cast("string"),
                               F.lit(f" != {4 * n_joints}")))))


def unpack(df: DataFrame, col: str, n_joints: int, keep: Sequence[str] = (), negate_y: bool = False) -> DataFrame:
    """C1 (+C5): array -> named scalars ``xmean{i}, ymean{i}, xstd{i}, ystd{i}``."""
    p = Pose(col, n_joints)
    out = []
    for c in COMPONENTS:
        for j in range(n_joints):
            e = p.comp(c, j)
            out.append((-e if (negate_y and c == "ymean") else e).alias(f"{c}{j}"))
    return df.select(*keep, *out)


def to_interleaved(col: str, n_joints: int) -> Column:
    """Blocked -> ``[x, y, xstd, ystd] * n``."""
    n = n_joints
    return F.expr(f"flatten(transform(sequence(0, {n - 1}), _j -> array(`{col}`[2 * _j], `{col}`[2 * _j + 1], "
                  f"`{col}`[{2 * n} + 2 * _j], `{col}`[{2 * n} + 2 * _j + 1])))")


def component(col: str, n_joints: int, c: int) -> Column:
    """Component c (0 x, 1 y, 2 xstd, 3 ystd) of an interleaved array."""
    return F.expr(f"transform(sequence(0, {n_joints - 1}), _j -> `{col}`[4 * _j + {c}])")


def negate_y(col: str, n_joints: int) -> Column:
    """Flip the sign of the y means (odd slots of the first half)."""
    return F.expr(f"transform(`{col}`, (v, i) -> CASE WHEN i < {2 * n_joints} AND i % 2 = 1 THEN -v ELSE v END)")


def select_joints(col: str, idx: Sequence[int]) -> Column:
    """Keep the given array slots, in order."""
    return F.array(*[F.col(col).getItem(int(i)) for i in idx])


def torso_length(p: Pose, sk: Skeleton) -> Column:
    """Mean of the two shoulder-hip diagonals."""
    ls, lh, rs, rh = sk.torso
    d = lambda a, b: F.sqrt((p.comp("xmean", a) - p.comp("xmean", b)) ** 2
                            + (p.comp("ymean", a) - p.comp("ymean", b)) ** 2)
    return d(ls, lh) / 2.0 + d(rs, rh) / 2.0


def feature_row(df: DataFrame, col: str, sk: Skeleton, keep: Sequence[str] = ()) -> DataFrame:
    """Hand means (8), torso-normalised pair differences (2 per pair), knee
    stds, left/right std sums and the torso length, in this fixed order."""
    p = Pose(col, sk.n_joints)
    hand = {}
    out = []
    for side, joints in sk.hands.items():
        for c in COMPONENTS:
            hand[(c, side)] = p.mean_of(c, joints)
            out.append(hand[(c, side)].alias(f"{c}{side}_hand"))
    torso = torso_length(p, sk)
    pt = lambda c, a: hand[(c, a.split("_")[0])] if isinstance(a, str) else p.comp(c, a)
    for a, b in sk.diff_pairs:
        for c in ("xmean", "ymean"):
            out.append(F.try_divide(pt(c, a) - pt(c, b), torso).alias(f"{c}diff{a}-{b}"))
    for j in sk.knees:
        for c in ("xstd", "ystd"):
            out.append(p.comp(c, j).alias(f"{c}{j}"))
    for side, joints in sk.sides.items():
        e = F.lit(0.0)
        for j in joints:
            e = e + p.comp("xstd", j) + p.comp("ystd", j)
        out.append(e.alias(f"{side}_std"))
    out.append(torso.alias("torso_length"))
    return df.select(*keep, *out)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used: names and
    projections are expanded where they stand, the variable of a lambda is not."""
    return F.transform(F.array(value), use)[0]


def centre_and_scale(col: str, n_joints: int, center: str = "root", root_index: int | None = None,
                     scale: str = "torso", torso_pair: tuple[int, int] | None = None) -> Column:
    """C4: struct(features, scale, cx, cy).  centre: centroid mean, median root or a
    joint; scale: none, bbox, std (ddof 0), torso pair or mean magnitude; a scale
    below 1e-9 becomes 1.  Means are centred and scaled, stds only scaled.  Every part is
    worked out once per row."""
    n, a = n_joints, F.col(col)
    if scale not in ("none", "bbox", "std", "torso"):
        raise ValueError(f"unknown scale mode {scale}")
    slots = lambda k: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: a[2 * i + k])
    total = lambda arr, f: F.aggregate(arr, F.lit(0.0), lambda s, v: s + f(v))
    middle = lambda t: t[n // 2] if n % 2 else (t[n // 2 - 1] + t[n // 2]) / 2

    def centre_of(values: Column, k: int) -> Column:
        if center == "centroid":
            return total(values, lambda v: v) / n
        return _let(F.array_sort(values), middle) if root_index is None else a[2 * root_index + k]

    def spread(xs: Column, ys: Column, c: Column) -> Column:
        if scale == "none":
            return F.lit(1.0)
        if scale == "torso" and torso_pair is not None:
            i1, i2 = torso_pair
            return F.sqrt(F.pow(a[2 * i1] - a[2 * i2], F.lit(2)) + F.pow(a[2 * i1 + 1] - a[2 * i2 + 1], F.lit(2)))
        if scale == "torso":
            far = F.zip_with(xs, ys, lambda x, y: F.sqrt(F.pow(x - c["cx"], F.lit(2)) + F.pow(y - c["cy"], F.lit(2))))
            return total(far, lambda v: v) / n
        moved = F.struct(F.transform(xs, lambda v: v - c["cx"]).alias("x"), F.transform(ys, lambda v: v - c["cy"]).alias("y"))
        if scale == "bbox":
            return _let(moved, lambda m: F.greatest(F.array_max(m["x"]) - F.array_min(m["x"]), F.array_max(m["y"]) - F.array_min(m["y"])))
        return _let(F.concat(moved["x"], moved["y"]), lambda m: F.sqrt(total(m, lambda v: v * v) / (2 * n) - F.pow(total(m, lambda v: v) / (2 * n), F.lit(2))))

    def scaled(c: Column, sc: Column) -> Column:
        feats = F.transform(a, lambda v, i: F.when((i < 2 * n) & (i % 2 == 0), (v - c["cx"]) / sc).when(i < 2 * n, (v - c["cy"]) / sc).otherwise(v / sc))
        return F.struct(feats.alias("features"), sc.alias("scale"), c["cx"].alias("cx"), c["cy"].alias("cy"))

    one = lambda r: F.when(F.abs(r) < EPS, F.lit(1.0)).otherwise(r)
    return _let(F.struct(slots(0).alias("xs"), slots(1).alias("ys")), lambda p: _let(
        F.struct(centre_of(p["xs"], 0).alias("cx"), centre_of(p["ys"], 1).alias("cy")), lambda c: _let(
            spread(p["xs"], p["ys"], c), lambda r: _let(one(r), lambda sc: scaled(c, sc)))))


def impairment_side(df: DataFrame, row_features: DataFrame | None, patient: str,
                    left: str = "left_std", right: str = "right_std") -> DataFrame:
    """Per patient totals of the left and right std sums, joined back to the rows;
    ``impairment_side`` = 1 when the left total is larger."""
    tot = df.groupBy(patient).agg(F.sum(left).alias("left_total"), F.sum(right).alias("right_total"))
    tot = tot.withColumn("impairment_side", (F.col("left_total") > F.col("right_total")).cast("int"))
    return attach_group(df, tot, [patient])


def sample_weights(df: DataFrame, cols: Sequence[str], name: str = "weight") -> DataFrame:
    """Min-max every activity column, sum per row, square, divide by the maximum."""
    mm = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols], *[F.max(c).alias(f"{c}__hi") for c in cols])
    t = attach_row(df, mm)
    s = F.lit(0.0)
    for c in cols:
        s = s + F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}__lo"), F.col(f"{c}__hi") - F.col(f"{c}__lo")),
                           F.lit(0.0))
    t = t.withColumn("_w2", s * s).drop(*[f"{c}__{k}" for c in cols for k in ("lo", "hi")])
    mx = t.agg(F.max("_w2").alias("_wmax"))
    return attach_row(t, mx).withColumn(name, F.try_divide(F.col("_w2"), F.col("_wmax"))).drop("_w2", "_wmax")


def weighted_class_means(df: DataFrame, cols: Sequence[str], weight: str, by: Sequence[str]) -> DataFrame:
    """sum(c * w) / sum(w) for every column per class."""
    return df.groupBy(*by).agg(*[F.try_divide(F.sum(F.col(c) * F.col(weight)), F.sum(weight)).alias(c) for c in cols])


def activity_score(col: str, sk: Skeleton, joints: Sequence[int]) -> Column:
    """O1 score: sum of x and y stds of the given joints."""
    p = Pose(col, sk.n_joints)
    e = F.lit(0.0)
    for j in joints:
        e = e + p.comp("xstd", j) + p.comp("ystd", j)
    return e


def one_hot_closed(df: DataFrame, col: str, codes: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per code of a closed set; any other value raises."""
    pre = prefix if prefix is not None else f"{col}_"
    ok = F.col(col).isin(list(codes))
    guard = F.when(ok, F.lit(1)).otherwise(F.raise_error(F.concat(F.lit("unknown code: "),
                                                                 F.coalesce(F.col(col), F.lit("NULL")))))
    return df.withColumns({f"{pre}{c}": ((F.col(col) == c).cast("int") * guard).alias(f"{pre}{c}") for c in codes})


def one_hot_observed(df: DataFrame, col: str, prefix: str | None = None, limit: int = 1000) -> DataFrame:
    """One column per observed value; more than ``limit`` values raise."""
    found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} values")
    pre = prefix if prefix is not None else f"{col}_"
    return df.withColumns({f"{pre}{v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in sorted(r[0] for r in found)})


def threshold_class(p: str | Column, threshold: float = 0.5) -> Column:
    """Probability -> class."""
    c = F.col(p) if isinstance(p, str) else p
    return (c >= threshold).cast("int")


def argmax_class(probs: str | Column) -> Column:
    """Index of the first maximum of a probability array."""
    c = F.col(probs) if isinstance(probs, str) else probs
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def arm_over_patient_max(df: DataFrame, arm: str, patient: str, name: str = "arm_rel") -> DataFrame:
    """Arm length divided by the patient's largest arm length (group max joined back)."""
    mx = df.groupBy(patient).agg(F.max(arm).alias("_amax"))
    return attach_group(df, mx, [patient]).withColumn(name, F.try_divide(F.col(arm), F.col("_amax"))).drop("_amax")


def mirror_rows(df: DataFrame, col: str, n_joints: int, left: str = "left_std", right: str = "right_std") -> DataFrame:
    """C13 mirroring: where the left std sum exceeds the right one, negate the x means
    and swap the two sums (so the more active side is always 'right')."""
    flip = F.col(left) > F.col(right)
    xneg = F.transform(F.col(col), lambda v, i: F.when(flip & (i < 2 * n_joints) & (i % 2 == 0), -v).otherwise(v))
    return df.withColumns({col: xneg, left: F.when(flip, F.col(right)).otherwise(F.col(left)),
                           right: F.when(flip, F.col(left)).otherwise(F.col(right)),
                           "mirrored": flip.cast("int")})


@dataclass(frozen=True)
class Body:
    """Joints of the body geometry set; pairs are (left, right)."""
    n_joints: int
    nose: int
    shoulders: tuple
    hands: tuple
    eyes: tuple
    feet: tuple
    hips: tuple
    bend: tuple            # elbows and knees whose spread is reported
    hand_sets: tuple
    foot_sets: tuple
    kept: tuple            # joints whose raw slots the "kept" variant passes on


# Joints of the 33-keypoint layout.
BODY33 = Body(n_joints=33, nose=0, shoulders=(11, 12), hands=(19, 20), eyes=(3, 6), feet=(29, 30), hips=(23, 24), bend=(13, 14, 25, 26),
              hand_sets=((15, 17, 19, 21), (16, 18, 20, 22)), foot_sets=((27, 29, 31), (28, 30, 32)), kept=(15, 16, 17, 18, 19, 20, 21, 22, 27, 28))

# Feature groups of each variant, in output order, and what raw slots lead the row.
GEOMETRY = {
    "base": (None, ("limbs", "hand_spread", "nose", "bend_spread", "size", "end_position", "end_difference")),
    "kept": ("kept", ("limbs", "hand_spread", "nose", "bend_spread", "end_spread", "end_position")),
    "full": ("all", ("limbs", "hand_spread", "nose", "bend_spread", "end_spread", "end_position")),
    "final": ("all", ("nose", "bend_spread", "end_spread", "end_position")),
}


def body_geometry(df: DataFrame, col: str, body: Body, variant: str = "final", flip_y: bool = False, std_slots: str = "blocked",
                  keep: Sequence[str] = ()) -> DataFrame:
    """C14a-d: raw slots (``g_raw<i>``) and body proportions of a pose row, one projection.

    Height is the larger signed eye-foot difference in y, width the signed hip difference
    in x.  Arms (shoulder to hand) and legs (hip to foot) are in heights; x positions and
    spreads in widths, y ones in heights; nose-hand differences stay as they are.  ``flip_y``
    negates the y means first.  ``std_slots='blocked'`` reads spreads from the second half
    of the array, ``'stride'`` from slots 4j and 4j + 1.  A zero height or width gives NULL.
    """
    raw, groups = GEOMETRY[variant]
    n = body.n_joints
    a = F.col(col)
    slot = lambda i: -a[i] if flip_y and i < 2 * n and i % 2 else a[i]
    x, y = (lambda j: slot(2 * j)), (lambda j: slot(2 * j + 1))
    at = (lambda j: 2 * n + 2 * j) if std_slots == "blocked" else (lambda j: 4 * j)
    sx, sy = (lambda j: slot(at(j))), (lambda j: slot(at(j) + 1))
    span = lambda p, q: F.hypot(x(p) - x(q), y(p) - y(q))

    def mean(f, joints):
        total = f(joints[0])
        for j in joints[1:]:
            total = total + f(j)
        return total / float(len(joints))

    height = F.greatest(*[y(e) - y(f) for e, f in zip(body.eyes, body.feet)])
    width = x(body.hips[0]) - x(body.hips[1])
    per_h, per_w = (lambda e: F.try_divide(e, height)), (lambda e: F.try_divide(e, width))
    sides = ("l", "r")
    ends = [(f"{s}_{k}", sets[i]) for k, sets in (("foot", body.foot_sets), ("hand", body.hand_sets)) for i, s in ((1, "r"), (0, "l"))]
    out = {
        "limbs": [(f"{s}_arm", per_h(span(h, sh))) for s, h, sh in zip(sides, body.hands, body.shoulders)]
        + [(f"{s}_leg", per_h(span(hp, ft))) for s, hp, ft in zip(sides, body.hips, body.feet)],
        "hand_spread": [(f"{s}_hand_spread", per_w(sy(h))) for s, h in zip(sides, body.hands)],
        "nose": [(f"{s}_nose_hand", y(body.nose) - y(h)) for s, h in zip(sides, body.hands)],
        "bend_spread": [(f"x_spread{j}", per_w(sx(j))) for j in body.bend] + [(f"y_spread{j}", per_h(sy(j))) for j in body.bend],
        "end_spread": [v for name, js in ends for v in ((f"{name}_sx", per_w(mean(sx, js))), (f"{name}_sy", per_h(mean(sy, js))))],
        "size": [("height", height), ("width", width)],
        "end_position": [v for name, js in ends for v in ((f"{name}_x", per_w(mean(x, js))), (f"{name}_y", per_h(mean(y, js))))],
        "end_difference": [v for i, s in ((1, "r"), (0, "l")) for v in (
            (f"{s}_foot_hand_x", per_w(mean(x, body.foot_sets[i]) - mean(x, body.hand_sets[i]))),
            (f"{s}_foot_hand_y", per_h(mean(y, body.foot_sets[i]) - mean(y, body.hand_sets[i]))))],
    }
    slots = {None: [], "all": list(range(4 * n)),
             "kept": [2 * j for j in body.kept] + [2 * j + 1 for j in body.kept] + [4 * j for j in body.kept] + [4 * j + 1 for j in body.kept]}[raw]
    return df.select(*keep, *[slot(i).alias(f"g_raw{k}") for k, i in enumerate(slots)], *[e.alias(name) for g in groups for name, e in out[g]])


def side_normalised(df: DataFrame, col: str, n_joints: int, sides: dict, shoulders: dict, keep: Sequence[str] = ()) -> DataFrame:
    """The joints of each side over the absolute coordinates of that side's shoulder
    (x slots over |x|, y slots over |y|, spreads alike), then the side's sum of spreads.
    Sides are taken in order, so a shoulder listed under an earlier side is read after that
    side was scaled.  A zero coordinate gives NULL; joints of no side stay."""
    n, a = n_joints, F.col(col)
    slots = [a[i] for i in range(4 * n)]
    for side, joints in sides.items():
        dx, dy = F.abs(slots[2 * shoulders[side]]), F.abs(slots[2 * shoulders[side] + 1])
        for j in joints:
            for i in (2 * j, 2 * n + 2 * j):
                slots[i], slots[i + 1] = F.try_divide(slots[i], dx), F.try_divide(slots[i + 1], dy)
    sums = [F.aggregate(F.array(*[slots[2 * n + 2 * j + k] for j in joints for k in (0, 1)]), F.lit(0.0), lambda s, v: s + v).alias(f"{side}std")
            for side, joints in sides.items()]
    return df.select(*keep, F.inline(F.array(F.struct(F.array(*slots).alias(col), *sums))))


def shoulder_frame(df: DataFrame, col: str, n_joints: int, sides: dict, shoulders: tuple, hips: tuple, wrists: tuple, knees: tuple, nose: int,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Y means negated; x slots over the shoulder width, y slots over the mean torso
    height; side sums of spreads; rows whose left sum is larger mirrored (x means negated,
    sums swapped); then hand-nose distances and knee-hip differences in x."""
    n, a = n_joints, F.col(col)
    (ls, rs), (lh, rh) = shoulders, hips
    w = F.abs(a[2 * ls] - a[2 * rs])
    h = (F.abs(a[2 * ls + 1] - a[2 * lh + 1]) + F.abs(a[2 * rs + 1] - a[2 * rh + 1])) / 2.0
    slots = [F.try_divide(-a[i] if i < 2 * n and i % 2 else a[i], h if i % 2 else w) for i in range(4 * n)]
    sums = [F.aggregate(F.array(*[slots[2 * n + 2 * j + k] for j in joints for k in (0, 1)]), F.lit(0.0), lambda s, v: s + v).alias(f"{side}std")
            for side, joints in sides.items()]
    # Generators keep Catalyst from inlining the arrays into each of their many uses.
    t = df.select(*keep, F.inline(F.array(F.struct(F.array(*slots).alias(col), *sums))))
    flip = F.col("lstd") > F.col("rstd")
    mirrored = [F.when(flip & F.lit(i % 2 == 0 and i < 2 * n), -a[i]).otherwise(a[i]) for i in range(4 * n)]
    t = t.select(*keep, F.inline(F.array(F.struct(F.array(*mirrored).alias(col), F.when(flip, F.col("rstd")).otherwise(F.col("lstd")).alias("lstd"),
                                                  F.when(flip, F.col("lstd")).otherwise(F.col("rstd")).alias("rstd"), flip.cast("int").alias("mirrored")))))
    out = [F.hypot(a[2 * j] - a[2 * nose], a[2 * j + 1] - a[2 * nose + 1]).alias(f"{s}hand_dist") for s, j in zip("lr", wrists)]
    out += [(a[2 * k] - a[2 * p]).alias(f"{s}hip_diff") for s, k, p in zip("lr", knees, hips)]
    return t.select(*keep, col, "lstd", "rstd", "mirrored", *out)
