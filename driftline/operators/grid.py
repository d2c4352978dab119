"""Segments on a uniform grid: linear interpolation between neighbouring fixes, never over a long gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import GridConfig
from driftline.functions.geo import wrapped
from driftline.sources.tables import require

_SEGMENT = ("date", "icao24", "segment_id")
_PIECE = (*_SEGMENT, "piece")
REPORTED = ("velocity", "heading", "vertrate")
#: What a sample has of the raw entries that fall to it: name, field of an entry, aggregate.
RAW = (("n_raw_fixes", "n", F.sum), ("raw_speed_max_mps", "speed", F.max), ("raw_accel_max_mps2", "accel", F.max), ("raw_turn_rate_max_deg_s", "turn", F.max))


def unwrapped(degrees: str, order: Window) -> Column:
    """A column without jumps of over 180 degrees: each adds a turn to all that follows."""
    jump = F.col(degrees) - F.lag(degrees).over(order)
    turn = F.when(jump > 180, -360.0).when(jump < -180, 360.0).otherwise(0.0)
    return turn


def pieces(segments: DataFrame, max_gap_s: float = 30.0) -> DataFrame:
    """Fixes with ``piece`` (parts without a long gap, from 0 on), ``trajectory_id``, ``n_fixes`` and ``was_split_by_interp_gap``.

    Of fixes at one time the first stays. What describes the segment comes from its
    earliest fix. Longitudes are unwrapped within a piece, as ``lon_u``.
    """
    require(segments.columns, "icao24", "lat", "lon", "alt", "segment_id", "segment_start_time", "segment_end_time", "segment_duration_s", "t")
    once = Window.partitionBy(*_SEGMENT, "t").orderBy("src_order")
    order = Window.partitionBy(*_SEGMENT).orderBy("t")
    rows = segments.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    gap = (F.col("t") - F.lag("t").over(order) > max_gap_s).cast("int")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_gap", F.coalesce(gap, F.lit(0))).withColumn("piece", F.sum("_gap").over(running).cast("int")).drop("_gap")
    described = [c for c in ("callsign", "segment_start_time", "segment_end_time", "segment_duration_s") if c in rows.columns]
    rows = rows.withColumns({c: F.first(c).over(first) for c in described})
    rows = rows.withColumns({"was_split_by_interp_gap": F.max("piece").over(Window.partitionBy(*_SEGMENT)) > 0, "n_fixes": F.count(F.lit(1)).over(Window.partitionBy(*_PIECE))})
    inside = Window.partitionBy(*_PIECE).orderBy("t")
    rows = rows.withColumn("_turn", unwrapped("lon", inside))
    turned = F.sum("_turn").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumns({"lon_u": F.col("lon") + turned, "trajectory_id": F.concat(F.col("segment_id"), F.lit("_r"), F.col("piece").cast("string"))}).drop("_turn")


def _neighbours(fixes: DataFrame, channel: str) -> DataFrame:
    """``channel`` at the known fixes before and after each fix, itself included before, and their times.

    Where there is none on one side, that on the other stands for it, so that ends are level.
    """
    inside = Window.partitionBy(*_PIECE).orderBy("t")
    past = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*_PIECE).orderBy(F.col("t").desc()).rowsBetween(Window.unboundedPreceding, -1)
    value = F.col(channel)
    if channel == "heading":  # turns are counted between known headings
        known = F.last("heading", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
        jump = F.col("heading") - known
        fixes = fixes.withColumn("_turn", F.when(jump > 180, -360.0).when(jump < -180, 360.0).otherwise(0.0))
        fixes = fixes.withColumn("_value", F.col("heading") + F.sum("_turn").over(past)).drop("_turn")
        value = F.col("_value")
    at = F.when(value.isNotNull(), F.col("t"))
    known = F.count(value).over(Window.partitionBy(*_PIECE))
    found = {
        f"_{channel}_v0": F.last(value, ignorenulls=True).over(past),
        f"_{channel}_t0": F.last(at, ignorenulls=True).over(past),
        f"_{channel}_v1": F.last(value, ignorenulls=True).over(back),
        f"_{channel}_t1": F.last(at, ignorenulls=True).over(back),
        f"_{channel}_n": known,
    }
    return fixes.withColumns(found).drop("_value")


def _between(v0: Column, v1: Column, t0: Column, t1: Column, t: Column) -> Column:
    slope = (v1 - v0) / F.when(t1 > t0, t1 - t0)
    return F.coalesce(v0 + slope * (t - t0), v0, v1)


def _channel(channel: str) -> Column:
    v0, v1, t0, t1 = (F.col(f"_{channel}_{x}") for x in ("v0", "v1", "t0", "t1"))
    value = F.when(F.col(f"_{channel}_n") >= 2, _between(v0, v1, t0, t1, F.col("timestamp")))
    return F.pmod(value, F.lit(360.0)) if channel == "heading" else value


def on_grid(fixes: DataFrame, config: GridConfig = GridConfig()) -> DataFrame:
    """Samples at the first fix and every ``dt_s`` after it up to the last fix, for pieces with two fixes or more.

    Each fix emits the grid points from itself to the next one, and no others: no join, and
    no task holds a trajectory. ``lon_u`` stays unwrapped for what is computed from it. Of fixes that
    have ``raw`` (entries of ``raw_entries``), each entry is a row as well, which counts for
    its sample in a window, and then goes.
    """
    dt = F.lit(float(config.dt_s))
    inside, whole = Window.partitionBy(*_PIECE).orderBy("t"), Window.partitionBy(*_PIECE)
    rows = fixes.where("n_fixes >= 2")
    reported = [c for c in REPORTED if c in rows.columns]
    for channel in reported:
        rows = _neighbours(rows, channel)
    rows = rows.withColumns({"_t0": F.min("t").over(whole), "_t1": F.max("t").over(whole), "_next_t": F.lead("t").over(inside)})
    rows = rows.withColumns({f"_next_{c}": F.lead(c).over(inside) for c in ("lat", "lon_u", "alt")})
    rows = rows.withColumn("raw_update_median_s", F.median(F.col("_next_t") - F.col("t")).over(whole))
    rows = rows.withColumn("n_samples", F.ceil((F.col("_t1") - F.col("_t0") + 1e-9) / dt))
    timestamp = lambda k: F.col("_t0") + k * dt

    def first_from(t: Column) -> Column:
        """The number of the first grid point at ``t`` or later: by division, put right by a comparison on each side."""
        k = F.ceil((t - F.col("_t0")) / dt)
        return F.when(timestamp(k - 1) >= t, k - 1).when(timestamp(k) < t, k + 1).otherwise(k)

    low, last = F.greatest(first_from(F.col("t")), F.lit(0)), F.col("n_samples") - 1
    high = F.least(F.coalesce(first_from(F.col("_next_t")) - 1, last), last)
    points = F.when(low <= high, F.sequence(low, high))
    if "raw" in rows.columns:
        none = F.lit(None).cast(rows.schema["raw"].dataType.elementType)
        entries = F.concat(F.transform(points, lambda k: F.struct(k.alias("sample_idx"), none.alias("raw"))), F.transform("raw", lambda x: F.struct(x["sample_idx"].alias("sample_idx"), x.alias("raw"))))
        made = rows.withColumn("_entry", F.explode(F.coalesce(entries, F.transform("raw", lambda x: F.struct(x["sample_idx"].alias("sample_idx"), x.alias("raw"))))))
        made = made.withColumns({"sample_idx": F.col("_entry.sample_idx"), "raw": F.col("_entry.raw")})
    else:
        made = rows.withColumn("sample_idx", F.explode(points))
    made = made.withColumn("timestamp", timestamp(F.col("sample_idx")))
    raw = {}
    if "raw" in rows.columns:
        at = Window.partitionBy(*_PIECE, "sample_idx")
        raw = {name: value(F.col(f"raw.{field}")).over(at) for name, field, value in RAW}
        made = made.withColumns(raw).where("raw IS NULL")
    values = {c: _between(F.col(c), F.col(f"_next_{c}"), F.col("t"), F.col("_next_t"), F.col("timestamp")) for c in ("lat", "lon_u", "alt")}
    nearest = F.least(F.col("timestamp") - F.col("t"), F.abs(F.col("_next_t") - F.col("timestamp")))
    carried = [c for c in ("callsign",) if c in rows.columns]
    out = made.select(
        *_PIECE,
        *carried,
        "trajectory_id",
        "sample_idx",
        "timestamp",
        dt.alias("dt_s"),
        values["lat"].alias("lat_interp"),
        values["lon_u"].alias("lon_u"),
        values["alt"].alias("alt_interp"),
        (nearest > dt / 2).alias("is_interpolated"),
        "raw_update_median_s",
        *[_channel(c).alias(f"{c}_interp") for c in reported],
        "segment_start_time",
        "segment_end_time",
        "segment_duration_s",
        F.col("_t0").alias("trajectory_start_time"),
        (F.col("_t0") + (F.col("n_samples") - 1) * dt).alias("trajectory_end_time"),
        ((F.col("_t0") + (F.col("n_samples") - 1) * dt) - F.col("_t0")).alias("trajectory_duration_s"),
        "n_samples",
        "was_split_by_interp_gap",
        *raw,
    )
    return smoothed(out) if config.smooth else out.withColumns({"lat_smooth": F.col("lat_interp"), "lon_su": F.col("lon_u"), "alt_smooth": F.col("alt_interp")})


def median3(column: str, order: Window) -> Column:
    """Median of a row, the one before and the one after; at the ends, of the two there are."""
    x, y, z = F.lag(column).over(order), F.col(column), F.lead(column).over(order)
    inner = x + y + z - F.greatest(x, y, z) - F.least(x, y, z)
    return F.coalesce(inner, (y + x) / 2, (y + z) / 2, y)


def smoothed(samples: DataFrame) -> DataFrame:
    order = Window.partitionBy(*_PIECE).orderBy("sample_idx")
    return samples.withColumns({"lat_smooth": median3("lat_interp", order), "lon_su": median3("lon_u", order), "alt_smooth": median3("alt_interp", order)})


def output_longitudes(samples: DataFrame) -> DataFrame:
    return samples.withColumns({"lon_interp": wrapped(F.col("lon_u")), "lon_smooth": wrapped(F.col("lon_su"))}).drop("lon_u", "lon_su")
