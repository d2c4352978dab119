"""Motion on the grid, and the strongest motion of the fixes between grid times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.geo import compass, east_m, length, north_m, wrapped
from driftline.operators.grid import RAW

_PIECE = ("date", "icao24", "segment_id", "piece")


def motion(samples: DataFrame) -> DataFrame:
    """The samples with ``speed_mps, accel_mps2, accel_vector_mps2, turn_rate_deg_s`` by backward differences.

    The first speed copies the second; the others are null for the first two samples.
    """
    order = Window.partitionBy(*_PIECE).orderBy("sample_idx")
    back = lambda c: F.col(c) - F.lag(c).over(order)
    start = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = samples.withColumns({"_lat0": F.first("lat_smooth").over(start), "_lon0": F.first("lon_su").over(start)})
    rows = rows.withColumns({"_e": east_m(F.col("lon_su"), F.col("_lon0"), F.col("_lat0")), "_n": north_m(F.col("lat_smooth"), F.col("_lat0"))})
    rows = rows.withColumns({"_ve": back("_e") / F.col("dt_s"), "_vn": back("_n") / F.col("dt_s")})
    rows = rows.withColumns({"_speed": length(F.col("_ve"), F.col("_vn")), "_heading": compass(F.col("_ve"), F.col("_vn"))})
    return rows.withColumns(
        {
            "speed_mps": F.coalesce("_speed", F.lead("_speed").over(order)),
            "accel_mps2": back("_speed") / F.col("dt_s"),
            "accel_vector_mps2": length(back("_ve"), back("_vn")) / F.col("dt_s"),
            "turn_rate_deg_s": wrapped(back("_heading")) / F.col("dt_s"),
        }
    ).drop("_lat0", "_lon0", "_e", "_n", "_ve", "_vn", "_speed", "_heading")


def raw_entries(fixes: DataFrame, dt_s: float = 10.0) -> DataFrame:
    """The fixes with ``raw``: what each adds to samples, as entries of ``sample_idx, n, speed, accel, turn``.

    A step counts at its middle for the sample at or after it; what comes after the last
    sample counts for that. A fix, its speed and its changes have an entry each.
    """
    order, whole = Window.partitionBy(*_PIECE).orderBy("t"), Window.partitionBy(*_PIECE)
    start = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = fixes.columns
    rows = fixes.where("n_fixes >= 2").withColumns({"_t0": F.min("t").over(whole), "_t1": F.max("t").over(whole), "_lat0": F.first("lat").over(start), "_lon0": F.first("lon_u").over(start)})
    rows = rows.withColumn("_last", F.ceil((F.col("_t1") - F.col("_t0") + 1e-9) / F.lit(float(dt_s))) - 1)
    rows = rows.withColumns({"_e": east_m(F.col("lon_u"), F.col("_lon0"), F.col("_lat0")), "_n": north_m(F.col("lat"), F.col("_lat0"))})
    back = lambda c: F.col(c) - F.lag(c).over(order)
    rows = rows.withColumns({"_ve": back("_e") / back("t"), "_vn": back("_n") / back("t"), "_mid": (F.col("t") + F.lag("t").over(order)) / 2})
    rows = rows.withColumns({"_speed": length(F.col("_ve"), F.col("_vn")), "_heading": compass(F.col("_ve"), F.col("_vn"))})
    rows = rows.withColumns({"_accel": F.abs(back("_speed") / back("_mid")), "_turn": F.abs(wrapped(back("_heading")) / back("_mid")), "_mid2": (F.col("_mid") + F.lag("_mid").over(order)) / 2})

    def bucket(at: Column) -> Column:
        return F.greatest(F.least(F.ceil((at - F.col("_t0")) / F.lit(float(dt_s))), F.col("_last")), F.lit(0))

    none = F.lit(None).cast("double")
    entry = lambda at, n, speed, accel, turn: F.struct(bucket(at).alias("sample_idx"), F.lit(n).alias("n"), speed.alias("speed"), accel.alias("accel"), turn.alias("turn"))
    entries = F.array(entry(F.col("t"), 1, none, none, none), entry(F.col("_mid"), 0, F.col("_speed"), none, none), entry(F.col("_mid2"), 0, none, F.col("_accel"), F.col("_turn")))
    return rows.select(*kept, F.filter(entries, lambda x: x["sample_idx"].isNotNull()).alias("raw"))


def raw_dynamics(fixes: DataFrame, dt_s: float = 10.0) -> DataFrame:
    """For each sample with fixes or steps: ``n_raw_fixes`` and the highest raw speed, acceleration and turn rate, by one aggregation."""
    flat = raw_entries(fixes, dt_s).select(*_PIECE, F.explode("raw").alias("x")).select(*_PIECE, "x.*")
    return flat.groupBy(*_PIECE, "sample_idx").agg(*[value(field).alias(name) for name, field, value in RAW])
