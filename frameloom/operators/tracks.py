"""Trajectories as one row per sample: gap filling, smoothing, derivatives, path lengths and open/close events.

All are windows over (video_id, handedness) in order of seq; series columns are named by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import frames_in

#: Quadratic least squares over five samples, by place in the window, in 35ths.
SMOOTH = ((31, 9, -3, -5, 3), (9, 13, 12, 6, -5), (-3, 12, 17, 12, -3), (-5, 6, 12, 13, 9), (3, -5, -3, 9, 31))
MAX_GAP = 5


def series() -> Window:
    return Window.partitionBy("video_id", "handedness").orderBy("seq")


def _placed(rows: DataFrame) -> DataFrame:
    """rows with _i, their place in the series, and _m, its length."""
    return rows.withColumn("_i", F.row_number().over(series())).withColumn("_m", F.count("*").over(Window.partitionBy("video_id", "handedness")))


def _known(value: str, step: str) -> Column:
    """Struct (i, v) of the known sample next before (lag) or after (lead) a row, null at an edge. Offsets that skip nulls read each sample once, so a series takes linear time however long its gaps are."""
    return F.expr(f"{step}(IF({value} IS NULL, NULL, named_struct('i', _i, 'v', {value})), 1) IGNORE NULLS OVER (PARTITION BY video_id, handedness ORDER BY seq)")


def _size(left: str, right: str) -> Column:
    """How many samples lie between two known ones, or an edge."""
    return F.coalesce(F.col(f"{right}.i"), F.col("_m") + 1) - F.coalesce(F.col(f"{left}.i"), F.lit(0)) - 1


def gap_sizes(rows: DataFrame, value: str) -> DataFrame:
    """rows with, for value, _n: samples of the gap that a null is in, null for known ones; and _near: whether that gap has a neighbour."""
    rows = _placed(rows).withColumns({"_l": _known(value, "lag"), "_r": _known(value, "lead")})
    rows = rows.withColumns({"_n": F.when(F.col(value).isNull(), _size("_l", "_r")), "_near": F.coalesce("_l.v", "_r.v").isNotNull()})
    return rows.drop("_i", "_m", "_l", "_r")


def fill_gaps(rows: DataFrame, *values: str, max_gap: int | None = MAX_GAP) -> DataFrame:
    """rows with each value's gaps of at most max_gap samples filled: from the left neighbour at the gap's first sample to the right one at its last.

    A gap of one takes the left neighbour, a gap at an edge the only one there is; longer gaps stay. None fills all. All values take one window.
    """
    sides = {f"_{side}_{v}": _known(v, step) for v in values for side, step in (("l", "lag"), ("r", "lead"))}
    rows, filled = _placed(rows).withColumns(sides), {}
    for v in values:
        before, after = f"_l_{v}", f"_r_{v}"
        left, right = F.coalesce(f"{before}.v", f"{after}.v"), F.coalesce(f"{after}.v", f"{before}.v")
        n, k = _size(before, after), F.col("_i") - F.coalesce(F.col(f"{before}.i"), F.lit(0)) - 1
        line = F.when(n > 1, left + (right - left) * k / (n - 1)).otherwise(left)
        ok = F.lit(True) if max_gap is None else n <= max_gap
        filled[v] = F.when(F.col(v).isNotNull(), F.col(v)).when(ok, line)
    return rows.withColumns(filled).drop("_i", "_m", *sides)


def smooth(rows: DataFrame, *values: str, skip: int = 0) -> DataFrame:
    """rows with each of values smoothed over five samples; series of fewer stay as they are. The first and last two samples use the first and last five. The first `skip` samples have no values and are not part of the series."""
    w, whole = series(), Window.partitionBy("video_id", "handedness")
    rows = rows.withColumn("_i", F.row_number().over(w) - skip).withColumn("_n", F.count("*").over(whole) - skip)
    # each neighbour is looked up once, whichever of the five rows of coefficients a sample takes
    near = {f"_{v}{d:+d}": (F.lag(v, -d) if d < 0 else F.lead(v, d)).over(w) for v in values for d in range(-4, 5) if d}
    place = F.when(F.col("_i") <= 2, F.col("_i") - 1).when(F.col("_i") > F.col("_n") - 2, F.col("_i") - F.col("_n") + 4).otherwise(2)
    rows, fits = rows.withColumns({**near, "_place": F.when((F.col("_n") >= 5) & (F.col("_i") >= 1), place)}), {}
    for v in values:
        fits[v] = F.col(v)
        for p, row in enumerate(SMOOTH):
            at = sum(F.col(f"_{v}{j - p:+d}" if j != p else v) * c for j, c in enumerate(row)) / 35.0
            fits[v] = F.when(F.col("_place") == p, at).otherwise(fits[v])
    return rows.withColumns(fits).drop("_i", "_n", "_place", *near)


def derivative(rows: DataFrame, dt: float | Column, **named: str) -> DataFrame:
    """rows with new columns: name=value gives value's difference to the sample before, over dt. First samples have none."""
    w = series()
    return rows.select("*", *[((F.col(v) - F.lag(v).over(w)) / dt).alias(k) for k, v in named.items()])


def path_summary(moving: DataFrame) -> DataFrame:
    """(video_id, handedness, n_samples, path_length, max_velocity) of rows with x, y, vx, vy."""
    w = series()
    dx, dy = (F.col(c) - F.lag(c).over(w) for c in ("x", "y"))
    step, speed = F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy")), F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy"))
    steps = moving.withColumns({"_dx": dx, "_dy": dy})
    return steps.groupBy("video_id", "handedness").agg(F.count("*").alias("n_samples"), F.coalesce(F.sum(step), F.lit(0.0)).alias("path_length"), F.coalesce(F.max(speed), F.lit(0.0)).alias("max_velocity"))


def grasp_signal(rows: DataFrame, distance: str) -> DataFrame:
    """rows with grasp (0 open, 1 closed): distance between its 5th and 95th percentile, turned over and sharpened. Missing distances count as open; a series without range is 0."""
    p = rows.groupBy("video_id", "handedness").agg(F.percentile(distance, F.lit(0.05)).alias("_p5"), F.percentile(distance, F.lit(0.95)).alias("_p95"), F.count(distance).alias("_valid"))
    rows = rows.join(p, ["video_id", "handedness"])
    span = F.col("_p95") - F.col("_p5")
    v = F.coalesce(F.least(F.greatest((F.col("_p95") - F.col(distance)) / span, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    flat = (F.col("_valid") < 2) | (span < 1e-6)
    return rows.withColumn("grasp", F.when(flat, 0.0).otherwise(1 / (1 + F.exp(-6 * (v - 0.5))))).drop("_p5", "_p95", "_valid")


def grasp_events(rows: DataFrame) -> DataFrame:
    """(video_id, handedness, ts, event_type, duration_to_next): where grasp crosses one half."""
    w = series()
    was = F.lag("grasp").over(w)
    kind = F.when((was < 0.5) & (F.col("grasp") >= 0.5), "close").when((was >= 0.5) & (F.col("grasp") < 0.5), "open")
    found = rows.withColumn("event_type", kind).where("event_type is not null")
    return found.select("video_id", "handedness", "ts", "event_type", F.round(F.lead("ts").over(w) - F.col("ts"), 4).alias("duration_to_next"))


def motion(rows: DataFrame, dt: float | Column, position: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """rows (x, y smoothed) with vx, vy, ax, ay: each a difference over dt, then smoothed itself. A track's first sample has no velocity and its first two no acceleration. All in one partitioning, without a join."""
    for skip, (new, old) in enumerate((("v", ""), ("a", "v")), 1):
        names = {new + c: old + c for c in position}
        rows = smooth(derivative(rows, dt, **names), *names, skip=skip)
    return rows


def median_dt(rows: DataFrame, default: float = 0.5) -> DataFrame:
    """(video_id, dt): the median step between the times of a video's samples; default for fewer than two, 1 where it isn't positive."""
    w = Window.partitionBy("video_id").orderBy("ts")
    step = rows.select("video_id", (F.col("ts") - F.lag("ts").over(w)).alias("_d")).groupBy("video_id").agg(F.percentile("_d", F.lit(0.5)).alias("_m"))
    return step.select("video_id", step_of(F.col("_m"), default).alias("dt"))


def step_of(median: Column, default: float = 0.5) -> Column:
    """The time step that a median of steps stands for: default where there is none, 1 where it isn't positive."""
    return F.when(median.isNull(), default).when(median <= 0, 1.0).otherwise(median)


def tracked(rows: DataFrame, value: str = "x", least: int = 2) -> DataFrame:
    """(video_id, handedness) of hands that are seen often enough to have a track."""
    return rows.groupBy("video_id", "handedness").agg(F.count(value).alias("_n")).where(F.col("_n") >= least).select("video_id", "handedness")


def smoothness(moving: DataFrame) -> DataFrame:
    """(video_id, handedness, smoothness): 1 less a hundredth of the mean jerk, not under 0; a half with fewer than two accelerations."""
    w = series()
    d = lambda c: F.col(c) - F.lag(c).over(w)
    jerk = moving.where("ax is not null").withColumn("_j", F.sqrt(d("ax") * d("ax") + d("ay") * d("ay")))
    mean = jerk.groupBy("video_id", "handedness").agg(F.avg("_j").alias("_j"))
    return mean.select("video_id", "handedness", F.coalesce(F.greatest(F.lit(0.0), 1 - F.col("_j") / 100), F.lit(0.5)).alias("smoothness"))


def segment_summary(segs: DataFrame, samples: DataFrame, paths: DataFrame, events: DataFrame) -> DataFrame:
    """segs (video_id, segment_id, start_time, end_time) with path_length, max_velocity and grasp_events.

    The first two are the largest of the whole-video paths (video_id, handedness, path_length, max_velocity) of hands with
    a sample (video_id, handedness, ts) in the segment; events (video_id, ts) are counted. Both ends belong to a segment.
    """
    key = ["video_id", "segment_id"]
    met = frames_in(segs.select(*key, "start_time", "end_time"), samples.select("video_id", "handedness", "ts")).select(*key, "handedness").distinct()
    path = met.join(paths, ["video_id", "handedness"]).groupBy(*key).agg(F.max("path_length").alias("path_length"), F.max("max_velocity").alias("max_velocity"))
    n = frames_in(segs.select(*key, "start_time", "end_time"), events.select("video_id", "ts")).groupBy(*key).agg(F.count("*").alias("grasp_events"))
    return segs.join(path, key, "left").join(n, key, "left").fillna({"path_length": 0.0, "max_velocity": 0.0, "grasp_events": 0})
