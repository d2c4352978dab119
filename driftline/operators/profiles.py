"""Aggregated tables for maps and distributions of trajectories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import KM_PER_DEG, MAP_CELL_DEG
from driftline.functions.percentile import at_ranks

_ID = ("date", "trajectory_id")
# Channel, range and number of bins of the distributions.
REGIMES = (("duration_min", 0.0, 240.0), ("alt_m", 0.0, 6000.0), ("speed_mps", 0.0, 120.0), ("turn_rate_deg_s", 0.0, 6.0))
BINS = 60


def _bin(value, low: float, high: float, bins: int):
    """Number of the bin, the right end being in the last one; null outside."""
    at = F.least(F.floor((value - low) / ((high - low) / bins)), F.lit(bins - 1))
    return F.when((value >= low) & (value <= high), at)


def coverage(samples: DataFrame) -> DataFrame:
    """``cell_lon, cell_lat, n``: samples in each cell of the world map that has any."""
    lon = _bin(F.col("lon_interp"), -180.0, 180.0, int(360 / MAP_CELL_DEG))
    lat = _bin(F.col("lat_interp"), -90.0, 90.0, int(180 / MAP_CELL_DEG))
    return samples.select(lon.alias("cell_lon"), lat.alias("cell_lat")).where("cell_lon IS NOT NULL AND cell_lat IS NOT NULL").groupBy("cell_lon", "cell_lat").agg(F.count(F.lit(1)).alias("n"))


def extent(cells: DataFrame, margin: int = 8) -> DataFrame:
    """The part of the map that is in use, with a margin, within the world; upper ends exclusive."""
    return cells.agg(
        F.greatest(F.min("cell_lon") - margin, F.lit(0)).alias("lon_from"),
        F.least(F.max("cell_lon") + margin, F.lit(int(360 / MAP_CELL_DEG))).alias("lon_to"),
        F.greatest(F.min("cell_lat") - margin, F.lit(0)).alias("lat_from"),
        F.least(F.max("cell_lat") + margin, F.lit(int(180 / MAP_CELL_DEG))).alias("lat_to"),
    )


def _regime_bins() -> Column:
    values = {
        "duration_min": F.when(F.col("sample_idx") == 0, F.col("trajectory_duration_s") / 60.0),
        "alt_m": F.col("alt_interp"),
        "speed_mps": F.col("speed_mps"),
        "turn_rate_deg_s": F.abs("turn_rate_deg_s"),
    }
    return F.array(*[F.struct(F.lit(c).alias("channel"), _bin(values[c], low, high, BINS).alias("bin")) for c, low, high in REGIMES])


def regimes(samples: DataFrame) -> DataFrame:
    """``channel, bin, n``: distributions of durations by trajectory, and of altitude, speed and turn rate by sample."""
    return samples.select(F.explode(_regime_bins()).alias("x")).select("x.*").where("bin IS NOT NULL").groupBy("channel", "bin").agg(F.count(F.lit(1)).alias("n"))


def tally(samples: DataFrame) -> DataFrame:
    """Everything that maps, distributions and choices of trajectories are made from, in one read of the samples.

    Each sample counts for its cell (``kind`` is ``cell``), for its bin of each channel (the
    channel's name) and for its trajectory (``trajectory``), in one aggregation over the three
    kinds of keys; samples of a trajectory stand together, so tasks send few rows.
    """
    lon = _bin(F.col("lon_interp"), -180.0, 180.0, int(360 / MAP_CELL_DEG))
    lat = _bin(F.col("lat_interp"), -90.0, 90.0, int(180 / MAP_CELL_DEG))
    none = F.lit(None)
    key = lambda kind, date, trajectory, a, b: F.struct(kind.alias("kind"), date.cast("date").alias("date"), trajectory.cast("string").alias("trajectory_id"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    bins = F.transform(F.filter(_regime_bins(), lambda x: x["bin"].isNotNull()), lambda x: key(x["channel"], none, none, x["bin"], none))
    cell = F.when(lon.isNotNull() & lat.isNotNull(), F.array(key(F.lit("cell"), none, none, lon, lat)))
    keys = F.concat(bins, F.coalesce(cell, F.slice(bins, 1, 0)), F.array(key(F.lit("trajectory"), F.col("date"), F.col("trajectory_id"), none, none)))
    filled = F.col("is_interpolated").cast("double").alias("_filled")
    rows = samples.select(filled, "n_samples", "trajectory_duration_s", F.explode(keys).alias("x")).select("x.*", "_filled", "n_samples", "trajectory_duration_s")
    return rows.groupBy("kind", "date", "trajectory_id", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_filled").alias("filled_fraction"), F.max("n_samples").alias("n_samples"), F.max("trajectory_duration_s").alias("trajectory_duration_s")
    )


def coverage_of(tallied: DataFrame) -> DataFrame:
    return tallied.where("kind = 'cell'").select(F.col("a").alias("cell_lon"), F.col("b").alias("cell_lat"), "n")


def regimes_of(tallied: DataFrame) -> DataFrame:
    return tallied.where("kind NOT IN ('cell', 'trajectory')").select(F.col("kind").alias("channel"), F.col("a").alias("bin"), "n")


def trajectories_of(tallied: DataFrame) -> DataFrame:
    return tallied.where("kind = 'trajectory'").select(*_ID, "filled_fraction", "n_samples", "trajectory_duration_s")


def gallery(samples: DataFrame, n: int = 25) -> DataFrame:
    """``n`` trajectories of each day, evenly spread from rank 4 % to 96 % by duration, with their rank.

    Ranks need no jitter here. Only trajectories near a wanted rank are sorted.
    """
    return gallery_of(samples.where("sample_idx = 0").select(*_ID, "trajectory_duration_s"), n)


def gallery_of(per: DataFrame, n: int = 25) -> DataFrame:
    """``gallery`` from a row for each trajectory."""

    def wanted(total: Column) -> Column:
        cells = F.least(F.lit(n), total)
        place = lambda k: F.floor((0.04 + 0.92 * k / F.greatest(cells - 1, F.lit(1))) * (total - 1))
        return F.transform(F.sequence(F.lit(0).cast("long"), cells - 1), place)

    found = at_ranks(per, "date", "trajectory_duration_s", "trajectory_id", wanted)
    return found.select("date", "trajectory_id", "trajectory_duration_s", F.col("rank").cast("int").alias("rank"))


def gap_fill(samples: DataFrame) -> DataFrame:
    """For each trajectory, the share of samples without a near fix and their number, and whether it makes a good picture."""
    return _marked(samples.groupBy(*_ID).agg(F.avg(F.col("is_interpolated").cast("double")).alias("filled_fraction"), F.max("n_samples").alias("n_samples")))


def _marked(per: DataFrame) -> DataFrame:
    return per.withColumn("is_pick", F.col("filled_fraction").between(0.05, 0.25) & F.col("n_samples").between(150, 400))


def pick(samples: DataFrame) -> DataFrame:
    """The first of the good ones by id, or the one filled most."""
    return pick_of(gap_fill(samples))


def pick_of(per: DataFrame) -> DataFrame:
    """``pick`` from a row for each trajectory."""
    return _marked(per).orderBy(F.desc("is_pick"), F.when(~F.col("is_pick"), F.col("filled_fraction")).desc_nulls_first(), "trajectory_id").limit(1)


def local_km(samples: DataFrame) -> DataFrame:
    """Samples in kilometres east and north of their trajectory's mean position."""
    whole = Window.partitionBy(*_ID)
    lat0, lon0 = F.avg("lat_interp").over(whole), F.avg("lon_interp").over(whole)
    return samples.select(
        *_ID,
        "sample_idx",
        "is_interpolated",
        ((F.col("lon_interp") - lon0) * F.cos(F.radians(lat0)) * KM_PER_DEG).alias("east_km"),
        ((F.col("lat_interp") - lat0) * KM_PER_DEG).alias("north_km"),
    )
