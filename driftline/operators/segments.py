"""From position reports to clean flight segments, by window functions over one aircraft's day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.config import HIGH_ALTITUDE_M, LOW_ALTITUDE_M, NULL_ISLAND_DEG, SegmentConfig
from driftline.functions.geo import haversine_m
from driftline.functions.percentile import beside, percentiles
from driftline.functions.text import callsign, flag
from driftline.sources.tables import require, timestamp_column

#: One exchange serves every window below; a segment lies within one such partition.
_AIRCRAFT = ("date", "icao24")
_SEGMENT = ("date", "icao24", "segment_id")
_ORDER = ("t", "src_order")


def with_time(states: DataFrame) -> DataFrame:
    """``t`` is the time of the last position if there is one, else that of the report."""
    return states.withColumn("t", F.col(timestamp_column(states.columns)))


def fresh(states: DataFrame, max_lag_s: float = 10.0) -> DataFrame:
    """Reports whose position is 0 to ``max_lag_s`` old; all where a time column is missing. A null lag drops the row."""
    if not {"time", "lastposupdate"} <= set(states.columns):
        return states
    return states.where((F.col("time") - F.col("lastposupdate")).between(0, max_lag_s))


def dealt(states: DataFrame) -> DataFrame:
    """The reports by aircraft and day: the one exchange that all steps from here on share.

    Reports without an id would meet in one task; they are spread by their time. Windows
    have the key ``_aircraft`` in their partition, which is the trimmed id wherever there is one.
    """
    key = F.when(_has_id(), F.trim("icao24")).otherwise(F.concat(F.lit("?"), F.col("t").cast("string")))
    return states.withColumn("_aircraft", key).repartition("date", "_aircraft")


def _first_of_time(states: DataFrame) -> DataFrame:
    at = Window.partitionBy(*_AIRCRAFT, "_aircraft", "t").orderBy("src_order")
    return states.where("t IS NOT NULL").withColumn("_n", F.row_number().over(at)).where("_n = 1").drop("_n")


def first_reports(states: DataFrame) -> DataFrame:
    """With a time; of several for one aircraft and time, the first in file order."""
    return _first_of_time(dealt(states)).drop("_aircraft")


def altitude(columns: list[str]) -> Column:
    """Geometric altitude, barometric where that is missing."""
    require(columns, one_of=("geoaltitude", "baroaltitude"))
    return F.coalesce(*[F.col(c) for c in ("geoaltitude", "baroaltitude") if c in columns])


def _has_id() -> Column:
    trimmed = F.trim("icao24")
    return F.coalesce((trimmed != "") & (F.lower(trimmed) != "nan"), F.lit(False))


def _clean_steps() -> list[tuple[str, Column]]:
    """Conditions in the order in which a row fails them."""
    island = (F.abs("lat") < NULL_ISLAND_DEG) & (F.abs("lon") < NULL_ISLAND_DEG)
    return [
        ("missing_id", _has_id()),
        ("missing_position", F.col("lat").isNotNull() & F.col("lon").isNotNull()),
        ("bad_position", F.coalesce((F.abs("lat") <= 90) & (F.abs("lon") <= 180) & ~island, F.lit(False))),
        ("on_ground", ~flag(F.col("onground"))),
        ("missing_altitude", F.col("alt").isNotNull()),
        ("bad_altitude", F.coalesce(F.col("alt").between(LOW_ALTITUDE_M, HIGH_ALTITUDE_M), F.lit(False))),
    ]


def judged(states: DataFrame) -> DataFrame:
    """The rows with ``alt`` and ``removed_by``, the first condition that they fail, or null."""
    verdict = F.lit(None).cast("string")
    for name, passes in reversed(_clean_steps()):
        verdict = F.when(~passes, name).otherwise(verdict)
    return states.withColumn("alt", altitude(states.columns)).withColumn("removed_by", verdict)


def clean(states: DataFrame) -> DataFrame:
    return judged(states).where("removed_by IS NULL").drop("removed_by")


def clean_funnel(states: DataFrame) -> DataFrame:
    """For each day, the rows before and after, and removals by condition, in one pass."""
    removed = [F.count_if(F.col("removed_by") == name).alias(f"removed_{name}") for name, _ in _clean_steps()]
    return judged(states).groupBy("date").agg(F.count(F.lit(1)).alias("rows_before"), *removed, F.count_if(F.col("removed_by").isNull()).alias("rows_after"))


def known_callsign(also: tuple[str, ...] = ()) -> Column:
    """The last real callsign of the aircraft strictly before a row, over all gaps."""
    before = Window.partitionBy(*_AIRCRAFT, *also).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(callsign(F.col("callsign")), ignorenulls=True).over(before)


def assign_segments(states: DataFrame, gap_split_s: float | Column = 60.0, also: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``starts_segment, segment_id, segment_start_time, segment_end_time, segment_duration_s``.

    A segment starts with an aircraft's first row, after a gap, or when a real callsign
    differs from the last real one. Two segments of an aircraft that start within one
    second share an id and are one from there on. ``also`` are columns, of one value for
    an aircraft, by which the rows are dealt.
    """
    aircraft = Window.partitionBy(*_AIRCRAFT, *also).orderBy(*_ORDER)
    before = F.lag("t").over(aircraft)
    changed = F.lit(False)
    if "callsign" in states.columns:
        changed = F.coalesce(callsign(F.col("callsign")) != known_callsign(also), F.lit(False))
    started = states.withColumn("starts_segment", before.isNull() | (F.col("t") - before > gap_split_s) | changed)
    running = aircraft.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = started.withColumn("_segment", F.sum(F.col("starts_segment").cast("int")).over(running))
    whole = Window.partitionBy(*_AIRCRAFT, *also, "_segment")
    timed = numbered.withColumns({"segment_start_time": F.min("t").over(whole), "segment_end_time": F.max("t").over(whole)})
    return timed.withColumns(
        {
            "segment_duration_s": F.col("segment_end_time") - F.col("segment_start_time"),
            "segment_id": F.concat_ws("_", "icao24", F.col("segment_start_time").cast("long").cast("string")),
        }
    ).drop("_segment")


def step_speed(order: Window) -> Column:
    """Metres per second from the row before; 0 where no time passed, null for a first row."""
    dt = F.col("t") - F.lag("t").over(order)
    way = haversine_m(F.lag("lat").over(order), F.lag("lon").over(order), F.col("lat"), F.col("lon"))
    return F.when(dt > 0, F.try_divide(way, dt)).when(dt.isNotNull(), 0.0)


def glitch_pass(rows: DataFrame, max_speed_mps: float, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows with ``_worst``: whether it is the one point of its segment that a pass removes.

    That is the point that takes part in most of the steps that are too fast, the
    earliest among equals; none if no step is.
    """
    order, whole = Window.partitionBy(*_SEGMENT, *also).orderBy(*_ORDER), Window.partitionBy(*_SEGMENT, *also)
    fast = rows.withColumns({"_fast": F.coalesce(step_speed(order) > max_speed_mps, F.lit(False)).cast("int"), "_at": F.row_number().over(order)})
    parts = fast.withColumn("_parts", F.col("_fast") + F.coalesce(F.lead("_fast").over(order), F.lit(0)))
    most = parts.withColumn("_most", F.max("_parts").over(whole))
    first = F.min(F.when(F.col("_parts") == F.col("_most"), F.col("_at"))).over(whole)
    return most.withColumn("_worst", (F.col("_most") > 0) & (F.col("_at") == first)).drop("_fast", "_parts", "_most", "_at")


def remove_glitches(segments: DataFrame, config: SegmentConfig = SegmentConfig(), also: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``points_removed`` and ``is_persistent``, after so many passes of removing one point a segment.

    A segment of which more than a share of the steps stays too fast is persistent; its
    rows stay here, marked, for the accounts.
    """
    order, whole = Window.partitionBy(*_SEGMENT, *also).orderBy(*_ORDER), Window.partitionBy(*_SEGMENT, *also)
    rows = segments.withColumn("_before", F.count(F.lit(1)).over(whole))
    for _ in range(config.glitch_passes):
        rows = glitch_pass(rows, config.max_speed_mps, also).where(~F.col("_worst")).drop("_worst")
    left = rows.withColumn("_fast", (step_speed(order) > config.max_speed_mps).cast("double"))
    share = F.coalesce(F.avg("_fast").over(whole), F.lit(0.0))
    return left.withColumns({"points_removed": F.col("_before") - F.count(F.lit(1)).over(whole), "is_persistent": share > config.persistent_fraction}).drop("_fast", "_before")


def judged_segments(cleaned: DataFrame, config: SegmentConfig = SegmentConfig(), also: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``is_valid``: long by the duration at its start, with points enough, and fast in the median.

    A segment without any velocity fails; without a velocity column speed isn't asked.
    """
    whole = Window.partitionBy(*_SEGMENT, *also)
    first = F.first("segment_duration_s").over(whole.orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    valid = (first >= config.min_duration_s) & (F.count(F.lit(1)).over(whole) >= config.min_points) & ~F.col("is_persistent")
    if "velocity" in cleaned.columns:
        valid = valid & F.coalesce(F.median("velocity").over(whole) >= config.min_velocity_mps, F.lit(False))
    return cleaned.withColumn("is_valid", valid)


def segment_points(states: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """All steps from daily reports on, rows of invalid segments still in, marked.

    Rows without an id go first: they are no aircraft, and cleaning would remove them.
    """
    with_id = with_time(fresh(states, config.max_lag_s)).where(_has_id()).repartition(*_AIRCRAFT)
    at = Window.partitionBy(*_AIRCRAFT, "t").orderBy("src_order")
    reports = with_id.where("t IS NOT NULL").withColumn("_n", F.row_number().over(at)).where("_n = 1").drop("_n")
    return judged_segments(remove_glitches(assign_segments(clean(reports), config.gap_split_s), config), config)


def segments_of(states: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Points of the valid segments."""
    return segment_points(states, config).where("is_valid").drop("is_valid", "is_persistent", "points_removed", "starts_segment")


def verdicts(states: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """Every report of the days, with ``removed_by`` and, where that is null, all of ``segment_points``; in one read and one exchange.

    ``removed_by`` is ``stale``, ``no_time``, ``repeated`` or the first condition of cleaning that a
    report fails. Removed reports take no part in the windows of the others: they are
    aircraft of their own there, under the column ``_id``.
    """
    lagging = {"time", "lastposupdate"} <= set(states.columns)
    is_fresh = F.coalesce((F.col("time") - F.col("lastposupdate")).between(0, config.max_lag_s), F.lit(False)) if lagging else F.lit(True)
    rows = dealt(with_time(states)).withColumn("_fresh", is_fresh)
    at = Window.partitionBy(*_AIRCRAFT, "_aircraft", "_fresh", "t").orderBy("src_order")
    rows = judged(rows.withColumn("_n", F.row_number().over(at)))
    early = F.when(~F.col("_fresh"), "stale").when(F.col("t").isNull(), "no_time").when(F.col("_n") > 1, "repeated")
    rows = rows.withColumn("removed_by", F.coalesce(early, "removed_by")).drop("_fresh", "_n")
    own = F.concat(F.lit("!"), F.col("src_order").cast("string"))
    rows = rows.withColumn("_id", F.col("icao24")).withColumn("icao24", F.when(F.col("removed_by").isNotNull(), own).otherwise(F.col("icao24")))
    also = ("_aircraft",)
    return judged_segments(remove_glitches(assign_segments(rows, config.gap_split_s, also), config, also), config, also)


def points_of(judged_rows: DataFrame) -> DataFrame:
    """Points of the valid segments of ``verdicts``, as ``segments_of`` has them."""
    kept = judged_rows.where(F.col("removed_by").isNull() & F.col("is_valid"))
    return kept.drop("removed_by", "is_valid", "is_persistent", "points_removed", "starts_segment", "_id", "_aircraft")


def removals(judged_rows: DataFrame) -> DataFrame:
    """The funnel of cleaning by day, from ``verdicts``: ``clean_funnel`` without reading the reports again."""
    by = F.col("removed_by")
    asked = by.isNull() | by.isin(*[name for name, _ in _clean_steps()])
    # a report that a pass removes as a glitch isn't among the rows, but in ``points_removed`` of its segment
    removed = [F.count_if(by == name).alias(f"removed_{name}") for name, _ in _clean_steps()]
    return judged_rows.where(asked).groupBy("date").agg(*removed)


#: The accounts of a day but for its durations, in the order of ``day_summary``.
_COUNTS = (
    "rows_input", "unique_aircraft_input", "rows_after_freshness", "rows_after_basic_cleaning", "rows_removed_glitch_points", "segments_discarded_persistent_violations",
    "rows_in_discarded_segments", "rows_removed_short_segments", "rows_after_segmentation", "unique_aircraft_output", "num_segments_output",
)


def day_summary(states: DataFrame, config: SegmentConfig = SegmentConfig()) -> DataFrame:
    """The accounts of each day, and ``rows_in_discarded_segments``, which no other column has; the reports are read once."""
    return accounts(verdicts(states, config))


def accounts(judged_rows: DataFrame) -> DataFrame:
    """``day_summary`` from ``verdicts``.

    Rows are counted by segment first and then by day and duration, whose counts give
    both the sums of a day and its median; in the partitioning of the windows the first
    of these needs no exchange.
    """
    by_segment = judged_rows.groupBy("date", "_aircraft", "icao24", "segment_id").agg(
        F.max("removed_by").alias("removed_by"),
        F.count(F.lit(1)).alias("n"),
        F.first("points_removed").alias("glitches"),
        F.first("is_persistent").alias("is_persistent"),
        F.first("is_valid").alias("is_valid"),
        F.min_by("segment_duration_s", "t").alias("duration"),
        F.max(F.coalesce(F.trim("_id"), F.lit("nan"))).alias("id"),
    )
    inside, known = F.col("removed_by").isNull(), F.substring("_aircraft", 1, 1) != "?"
    by_segment = by_segment.withColumns({"valid": inside & F.col("is_valid"), "persistent": inside & F.col("is_persistent"), "all_rows": F.col("n") + F.col("glitches")})
    of_id, of_aircraft = Window.partitionBy("date", "_aircraft"), Window.partitionBy("date", "_aircraft", "icao24").orderBy("segment_id")
    kept_before = F.coalesce(F.max("valid").over(of_aircraft.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    by_segment = by_segment.withColumns({"first_valid": F.col("valid") & ~kept_before, "first_of_id": known & (F.row_number().over(of_id.orderBy("icao24", "segment_id")) == 1)})
    early = F.coalesce(F.col("removed_by").isin("stale", "no_time", "repeated"), F.lit(False))
    sums = {
        "rows_input": F.col("all_rows"),
        "unique_aircraft_input": F.when(F.col("first_of_id"), 1),
        "rows_after_freshness": F.when(~early, F.col("all_rows")),
        "rows_after_basic_cleaning": F.when(inside, F.col("all_rows")),
        "rows_removed_glitch_points": F.when(inside & ~F.col("persistent"), F.col("glitches")),
        "segments_discarded_persistent_violations": F.when(F.col("persistent"), 1),
        "rows_in_discarded_segments": F.when(F.col("persistent"), F.col("all_rows")),
        "rows_removed_short_segments": F.when(inside & ~F.col("persistent") & ~F.col("valid"), F.col("n")),
        "rows_after_segmentation": F.when(F.col("valid"), F.col("n")),
        "unique_aircraft_output": F.when(F.col("first_valid"), 1),
        "num_segments_output": F.when(F.col("valid"), 1),
    }
    unknown = F.collect_set(F.when(~known, F.col("id")))  # spellings of no id: a few
    counts = by_segment.groupBy("date", F.when(F.col("valid"), F.col("duration")).alias("value")).agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in sums.items()], F.count_if("valid").alias("n"), unknown.alias("unknown")
    )
    ended = counts.groupBy("date").agg(
        *[F.sum(k).alias(k) for k in sums],
        F.size(F.array_distinct(F.flatten(F.collect_list("unknown")))).alias("unknown"),
        F.coalesce(F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum("n")), F.lit(0.0)).alias("mean_segment_duration_s"),
        F.coalesce(F.max("value"), F.lit(0.0)).alias("max_segment_duration_s"),
    )
    ended = ended.withColumn("unique_aircraft_input", F.col("unique_aircraft_input") + F.col("unknown"))
    middle = percentiles(counts.select("date", F.lit("duration").alias("channel"), "value", "n"), ["date"], {"duration": (0.5,)})
    return beside(ended, middle.select("date", F.col("x").alias("median_segment_duration_s"))).select(
        "date",
        *_COUNTS,
        (F.col("rows_input") - F.col("rows_after_freshness")).alias("rows_removed_freshness"),
        (F.col("rows_after_freshness") - F.col("rows_after_basic_cleaning")).alias("rows_removed_basic_cleaning"),
        "median_segment_duration_s",
        "mean_segment_duration_s",
        "max_segment_duration_s",
    )
