"""Checks of what the steps made: some raise, some report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import CRUISE_ANCHOR_MPS, TRAJECTORY_ANCHOR_MPS, GridConfig, SegmentConfig
from driftline.functions.percentile import beside, medians, percentiles, selected
from driftline.operators import segments as seg

_SEGMENT = ("date", "icao24", "segment_id")


class GateError(ValueError):
    """An output breaks a rule that always has to hold."""


def gap_sensitivity(points: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Segments, points and the median duration if final points are split anew at one, two and three times the gap.

    Only aircraft with a pause between one and three gaps are split differently. Their
    points go through the steps once for each gap, side by side in the same windows; those
    of all others go through once and count for each.
    """
    aircraft, multiples = Window.partitionBy("date", "icao24"), (1, 2, 3)
    pause = F.col("t") - F.lag("t").over(aircraft.orderBy("t", "src_order"))
    bare = points.drop("segment_id", "segment_start_time", "segment_end_time", "segment_duration_s").repartition("date", "icao24")
    differs = F.max((F.col("_pause") > config.gap_split_s) & (F.col("_pause") <= max(multiples) * config.gap_split_s)).over(aircraft)
    rows = bare.withColumn("_pause", pause).withColumn("_differs", F.coalesce(differs, F.lit(False)))
    each = F.when(F.col("_differs"), F.array(*map(F.lit, multiples))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("_times", F.explode(each)).drop("_pause", "_differs")
    also = ("_times",)
    split = seg.assign_segments(rows, F.greatest("_times", F.lit(1)) * F.lit(float(config.gap_split_s)), also)
    again = seg.judged_segments(seg.remove_glitches(split, config, also), config, also).where("is_valid")
    by_segment = again.groupBy(*_SEGMENT, "_times").agg(F.count(F.lit(1)).alias("n"), F.min_by("segment_duration_s", "t").alias("duration"))
    gap = lambda k: F.lit(float(config.gap_split_s)) * k
    counts_for = F.when(F.col("_times") == 0, F.array(*map(gap, multiples))).otherwise(F.array(gap(F.col("_times"))))
    every = by_segment.select(F.explode(counts_for).alias("gap_split_s"), "n", F.col("duration").alias("value"))
    every = every.groupBy("gap_split_s", "value").agg(F.sum("n").alias("points"), F.count(F.lit(1)).alias("n"))
    sums = every.groupBy("gap_split_s").agg(F.sum("n").alias("num_segments"), F.sum("points").alias("total_points_kept"))
    middle = percentiles(every.select("gap_split_s", F.lit("duration").alias("channel"), "value", "n"), ["gap_split_s"], {"duration": (0.5,)})
    gaps = points.sparkSession.createDataFrame([(float(k * config.gap_split_s),) for k in multiples], "gap_split_s double")
    joined = beside(gaps, sums, middle.select("gap_split_s", F.col("x").alias("median_duration_s")), on="gap_split_s")
    return joined.select("gap_split_s", "num_segments", "total_points_kept", "median_duration_s")


def consistency(summary: DataFrame) -> DataFrame:
    """Days whose share of removed rows is over twice, or under half, the median of all days. A row is a day."""
    share = summary.select("date", (1.0 - F.col("rows_after_segmentation") / F.nullif(F.col("rows_input"), F.lit(0))).alias("removed_fraction"))
    middle = F.median("removed_fraction").over(Window.partitionBy())
    found = share.withColumn("median_fraction", middle)
    off = (F.col("removed_fraction") > 2 * F.col("median_fraction")) | (F.col("removed_fraction") < F.col("median_fraction") / 2)
    return found.withColumn("is_flagged", F.coalesce((F.col("median_fraction") > 0) & off, F.lit(False)))


def _some(rows: DataFrame, keys: tuple[str, ...], n: int, seed: int) -> DataFrame:
    """All rows of ``n`` groups, those of least seeded hash."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))
    chosen = rows.select(*keys).distinct().orderBy(order, *keys).limit(n)
    return rows.join(F.broadcast(chosen), list(keys), "left_semi")  # n rows


def segment_speeds(points: DataFrame, n: int = 3, seed: int = 1, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Slowest, median and fastest step of ``n`` segments by a seeded choice, and whether none is too fast."""
    speed = seg.step_speed(Window.partitionBy(*_SEGMENT).orderBy("t", "src_order"))
    found = _some(points, _SEGMENT, n, seed).withColumn("v", speed).groupBy(*_SEGMENT)
    found = found.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("min_mps"), F.median("v").alias("median_mps"), F.max("v").alias("max_mps"))
    return found.withColumn("is_ok", F.coalesce(F.col("max_mps") < config.max_speed_mps, F.lit(False)))


def trajectory_extremes(samples: DataFrame, n: int = 3, seed: int = 1) -> DataFrame:
    """Samples, duration and the strongest motion of ``n`` trajectories by a seeded choice."""
    keys = ("date", "trajectory_id")
    return _some(samples, keys, n, seed).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.max("trajectory_duration_s").alias("duration_s"),
        F.max("speed_mps").alias("max_speed_mps"),
        F.max(F.abs("accel_mps2")).alias("max_accel_mps2"),
        F.max(F.abs("turn_rate_deg_s")).alias("max_turn_rate_deg_s"),
    )


def cruise_anchor(points: DataFrame) -> DataFrame:
    """The median reported velocity over all days, and whether it is a light aircraft's."""
    middle = medians(points, F.col("velocity")).select(F.col("median").alias("_median"))
    found = middle.agg(F.max("_median").alias("median_velocity"))  # a row, null without any velocity
    return found.withColumn("in_range", F.coalesce(F.col("median_velocity").between(*CRUISE_ANCHOR_MPS), F.lit(False)))


def uniform_spacing(samples: DataFrame, dt_s: float = 10.0) -> DataFrame:
    """For each trajectory, its steps and how many differ from ``dt_s``; rows are taken as they stand, by sample number."""
    order = Window.partitionBy("date", "icao24", "segment_id", "trajectory_id").orderBy("sample_idx")
    step = F.col("timestamp") - F.lag("timestamp").over(order)
    off = F.abs(step - dt_s) > 1e-6 + 1e-5 * dt_s
    return samples.select("trajectory_id", step.alias("step"), off.alias("off")).groupBy("trajectory_id").agg(F.count("step").alias("steps"), F.count_if("off").alias("steps_off"))


def thresholds(samples: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    found = samples.agg(F.min("trajectory_duration_s").alias("min_duration_s"), F.min("n_samples").alias("min_samples"))
    return found.withColumn("is_ok", F.coalesce((F.col("min_duration_s") >= config.min_duration_s) & (F.col("min_samples") >= config.min_points), F.lit(True)))


def motion_percentiles(samples: DataFrame) -> DataFrame:
    """p50, p95 and p99 of speed and of the sizes of both accelerations and the turn rate; a row each."""
    channels = {"speed_mps": F.col("speed_mps")} | {c: F.abs(c) for c in ("accel_mps2", "accel_vector_mps2", "turn_rate_deg_s")}
    ps = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = selected(samples, [], channels, dict.fromkeys(channels, tuple(ps.values())))
    every = samples.sparkSession.createDataFrame([(c,) for c in channels], "channel string")
    return every.join(found, "channel", "left").groupBy("channel").agg(*[F.max(F.when(F.col("p") == p, F.col("x"))).alias(n) for n, p in ps.items()])


def check_segments(funnel: DataFrame) -> None:
    """Raise if no day had a report on the ground: then the flag was misread."""
    if not funnel.agg(F.sum("removed_on_ground")).first()[0]:
        raise GateError("no report on the ground was removed on any day")


def check_trajectories(samples: DataFrame, config: GridConfig = GridConfig()) -> None:
    """Raise if there is no sample, a step isn't ``dt_s``, a trajectory is too short, or speeds aren't an aircraft's."""
    if samples.isEmpty():
        raise GateError("no trajectory on any day")
    if not uniform_spacing(samples, config.dt_s).where("steps_off > 0").isEmpty():
        raise GateError(f"a step isn't {config.dt_s:g} s")
    if not thresholds(samples, config).first().is_ok:
        raise GateError("a trajectory is shorter than allowed")
    middle = medians(samples, F.col("speed_mps")).first()
    middle = middle.median if middle else float("nan")
    if not TRAJECTORY_ANCHOR_MPS[0] <= middle <= TRAJECTORY_ANCHOR_MPS[1]:
        raise GateError(f"median speed {middle:.1f} m/s")
