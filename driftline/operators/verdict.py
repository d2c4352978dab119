"""Which trajectories stay, which are marked, and why the others went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import GridConfig
from driftline.functions.percentile import beside, percentiles, selected, value_counts
from driftline.operators.grid import on_grid, output_longitudes, pieces
from driftline.operators.motion import motion, raw_entries

_PIECE = ("date", "icao24", "segment_id", "piece")
REASONS = ("duration", "min_points", "speed", "accel", "turn_rate")


def judged(samples: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """Samples with motion, and ``reason`` (why the trajectory is dropped, or null) and the two flags.

    Window aggregates over a trajectory need no second exchange and no join back. Flags
    are only raised on trajectories that pass the hard rules.
    """
    whole = Window.partitionBy(*_PIECE)
    share = lambda c, limit: F.coalesce(F.avg((F.abs(c) > limit).cast("double")).over(whole), F.lit(0.0)) > config.violation_fraction
    hard = (
        F.when(F.col("trajectory_duration_s") < config.min_duration_s, "duration")
        .when(F.col("n_samples") < config.min_points, "min_points")
        .when(F.max("speed_mps").over(whole) > config.max_speed_mps, "speed")
    )
    rows = samples.withColumn("reason", hard).withColumns(
        {"exceeds_accel_limit": share("accel_mps2", config.max_accel_mps2), "exceeds_turn_rate_limit": share("turn_rate_deg_s", config.max_turn_rate_deg_s)}
    )
    passed = F.col("reason").isNull()
    rows = rows.withColumns({c: passed & F.col(c) for c in ("exceeds_accel_limit", "exceeds_turn_rate_limit")})
    if config.drop_dynamics:
        rows = rows.withColumn("reason", F.coalesce("reason", F.when(F.col("exceeds_accel_limit"), "accel"), F.when(F.col("exceeds_turn_rate_limit"), "turn_rate")))
    return rows


def all_samples(segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    return judged(motion(on_grid(pieces(segments, config.max_gap_s), config)), config)


def judged_trajectories(segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """All samples with the raw dynamics between them and ``reason``; in the partitioning of the segments."""
    return judged(motion(on_grid(raw_entries(pieces(segments, config.max_gap_s), config.dt_s), config)), config)


def trajectories(segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """The samples of the trajectories that stay."""
    return trajectories_of(judged_trajectories(segments, config))


def trajectories_of(samples: DataFrame) -> DataFrame:
    """``trajectories`` from ``judged_trajectories``."""
    kept = samples.where("reason IS NULL").drop("reason")
    out = output_longitudes(kept).withColumns({"n_raw_fixes": F.coalesce("n_raw_fixes", F.lit(0)), "source_segment_id": F.col("segment_id")})
    have = set(out.columns)
    order = """date icao24 callsign segment_id trajectory_id source_segment_id sample_idx timestamp dt_s lat_interp lon_interp alt_interp lat_smooth lon_smooth alt_smooth
    is_interpolated speed_mps accel_mps2 accel_vector_mps2 turn_rate_deg_s raw_speed_max_mps raw_accel_max_mps2 raw_turn_rate_max_deg_s n_raw_fixes raw_update_median_s velocity_interp
    heading_interp vertrate_interp segment_start_time segment_end_time segment_duration_s trajectory_start_time trajectory_end_time trajectory_duration_s n_samples
    was_split_by_interp_gap exceeds_accel_limit exceeds_turn_rate_limit""".split()  # fixed values: the layout of the trajectory table
    return out.select(*[c for c in order if c in have])


def dropped(segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """A row for each trajectory that was dropped: ``date, trajectory_id, source_segment_id, reason, n_samples, duration_s``."""
    return dropped_of(all_samples(segments, config), segments, config)


def dropped_of(samples: DataFrame, segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """``dropped`` from judged samples, and from the segments' keys and times for pieces of one fix, which have no samples."""
    tiny = pieces(segments, config.max_gap_s).where("n_fixes < 2")
    tiny = tiny.select("date", "trajectory_id", F.col("segment_id").alias("source_segment_id"), F.lit("min_points").alias("reason"), F.col("n_fixes").alias("n_samples"), F.lit(0.0).alias("duration_s"))
    first = samples.where("reason IS NOT NULL AND sample_idx = 0")
    return first.select("date", "trajectory_id", F.col("segment_id").alias("source_segment_id"), "reason", "n_samples", F.col("trajectory_duration_s").alias("duration_s")).union(tiny)


def _asked() -> tuple[dict[str, Column], dict[str, Column]]:
    """What the percentiles of a day are of, and what is counted of it."""
    first, stays = F.col("sample_idx") == 0, F.col("reason").isNull()
    motions = {"speed_mps": F.col("speed_mps"), "accel_mps2": F.abs("accel_mps2"), "turn_rate_deg_s": F.abs("turn_rate_deg_s")}
    tallies = {
        "output_rows": stays,
        "output_trajectories": stays & first,
        "flagged_accel": stays & first & F.col("exceeds_accel_limit"),
        "flagged_turn_rate": stays & first & F.col("exceeds_turn_rate_limit"),
        **{f"dropped_{r}": first & (F.col("reason") == r) for r in REASONS},
    }
    return {c: F.when(stays, v) for c, v in motions.items()}, tallies


def day_summary(segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """The accounts of each day, days without any trajectory too.

    Samples and trajectories are counted by value and channel in one pass over the chain;
    counts and exact percentiles come from that.
    """
    motions, tallies = _asked()
    counts = value_counts(all_samples(segments, config), ["date"], motions | {c: F.when(v, 0.0) for c, v in tallies.items()})
    tallied = counts.groupBy("date").agg(*[F.sum(F.when(F.col("channel") == c, F.col("n"))).alias(c) for c in tallies])
    return _by_day(segments, config, tallied, percentiles(counts, ["date"], dict.fromkeys(motions, (0.5, 0.95))))


def accounts(samples: DataFrame, segments: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """``day_summary`` from judged samples that are written, and, for what has no samples, the segments' keys and times.

    Rows are tallied in one aggregation. For exact percentiles values are counted in bins, and
    only those of bins that hold a rank are shuffled, in a second read of three columns.
    """
    motions, tallies = _asked()
    tallied = samples.groupBy("date").agg(*[F.count_if(v).alias(c) for c, v in tallies.items()])
    return _by_day(segments, config, tallied, selected(samples, ["date"], motions, dict.fromkeys(motions, (0.5, 0.95))))


def _by_day(segments: DataFrame, config: GridConfig, tallied: DataFrame, ranks: DataFrame) -> DataFrame:
    """A row a day: what was read, from the pieces; tallies; percentiles ``date, channel, p, x``."""
    split = pieces(segments.withColumn("_reports", F.count(F.lit(1)).over(Window.partitionBy("date", "icao24", "segment_id", "t"))), config.max_gap_s)
    by_segment = split.groupBy("date", "icao24", "segment_id").agg(
        F.sum("_reports").alias("rows"), F.max(F.col("was_split_by_interp_gap").cast("int")).alias("split"), F.count_if(F.col("n_fixes") < 2).alias("tiny")
    )
    read = by_segment.groupBy("date").agg(
        F.sum("rows").alias("input_rows"),
        F.count(F.lit(1)).alias("input_segments"),
        F.sum("split").alias("segments_split_by_interp_gap"),
        F.sum("tiny").alias("tiny"),
    )
    names = {(c, p): f"{word}_{c}" for c in _asked()[0] for word, p in (("median", 0.5), ("p95", 0.95))}
    ranks = ranks.groupBy("date").agg(*[F.max(F.when((F.col("channel") == c) & (F.col("p") == p), F.col("x"))).alias(n) for (c, p), n in names.items()])
    found = beside(read, tallied, ranks)
    out = ["output_rows", "output_trajectories", "flagged_accel", "flagged_turn_rate", *names.values(), "segments_split_by_interp_gap"]
    dropped_counts = [(F.col(f"dropped_{r}") + (F.col("tiny") if r == "min_points" else 0)).alias(f"dropped_{r}") for r in REASONS]
    return found.select("date", "input_rows", "input_segments", *out, *dropped_counts)
