"""The four steps from files to trajectories, each writing what the next one reads."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.config import GridConfig, SegmentConfig
from driftline.functions.text import spacing_tag
from driftline.operators import classify, gates, profiles, segments, states, verdict
from driftline.sources import files, folders, tables


def run_classify(spark: SparkSession, registry: str, out: str) -> DataFrame:
    """The whitelist, with all columns of the registry; returns the funnel."""
    found = tables.read_csv(spark, registry, numbers=()).drop("src_file", "src_order")
    classify.whitelist(found).write.mode("overwrite").option("header", True).csv(out)
    return classify.funnel(found)


def run_states(spark: SparkSession, raw: str, whitelist: str, out: str, kind: str = "parquet", days: list[str] | None = None) -> DataFrame:
    """Reports of whitelisted aircraft, a folder a day, each day in order; returns the days' counts.

    Of the files in ``raw`` only those of states are read, of ``days`` alone if given. A
    file with lines but without an id or any time is an error; a file without a line isn't,
    and ``files.state_file_table`` tells it. Days that aren't read stay as they are in ``out``.
    """
    found = files.state_file_table(spark, raw, whitelist).collect()  # a row a file
    if bad := [r for r in found if r.problem in ("no icao24", "no time")]:
        raise ValueError(f"{bad[0].problem} in {bad[0].path}")
    dated = [r for r in found if r.date is not None and (not days or r.date in days)]
    if not any(r.columns for r in dated):
        raise ValueError(f"no file with a header in {raw}")
    reports = tables.with_date(tables.read_csv(spark, [r.path for r in dated]))
    keys = states.whitelist_keys(tables.read_csv(spark, whitelist, numbers=()))
    order = F.col(tables.timestamp_column(reports.columns, "time", "lastposupdate")).asc_nulls_last()
    days = sorted({r.date for r in dated})
    tables.write_days(states.of_whitelist(reports, keys), out, states.normal_id(), order, "src_order", kind=kind, days=days, whole=True)
    return states.day_summary(tables.read_table(spark, out))


def _keep(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Write what several results are made from, and read it: its chain runs once. Underscored, so that readers of the folder pass it by."""
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _of_days(rows: DataFrame, days: list[str] | None) -> DataFrame:
    return rows.where(F.col("date").cast("string").isin(days)) if days else rows


def _write_by_day(spark: SparkSession, rows: DataFrame, path: str, days: list[str], few: bool = True) -> DataFrame:
    """A table of rows by day as CSV, one file if they are ``few``: those of ``days`` anew, those of other days as they were; returns it."""
    path, new = path.rstrip("/"), f"{path.rstrip('/')}.new"
    if tables.exists(spark, path):
        before = spark.read.option("header", True).csv(path)
        of_others = before.where(~F.col("date").isin(days) | F.col("date").isNull())
        rows = tables.union_all([rows.select([F.col(c).cast("string") for c in rows.columns]), of_others])
    rows = rows.coalesce(1).sortWithinPartitions("date") if few else rows
    rows.write.mode("overwrite").option("header", True).csv(new)
    folders.delete(spark, path)
    folders.rename(spark, new, path)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def run_segments(spark: SparkSession, daily: str, out: str, config: SegmentConfig = SegmentConfig(), kind: str = "parquet", days: list[str] | None = None) -> DataFrame:
    """Points of valid segments; returns the summary, written before the check that may raise.

    All steps run once: every report is written with its verdict, and the points, the
    summary and the check are read from that. With ``days`` other days stay as they are.
    """
    out = out.rstrip("/")
    work = f"{out}/_judged"
    judged = _keep(spark, segments.verdicts(_of_days(tables.read_table(spark, daily), days), config), work)
    there = [str(r.date) for r in judged.select("date").distinct().collect()]
    summary = _write_by_day(spark, segments.accounts(judged), f"{out}_summary", there)
    tables.write_days(segments.points_of(judged), out, "icao24", "t", kind=kind, days=there)
    gates.check_segments(segments.removals(judged))
    folders.delete(spark, work)
    return summary


def run_trajectories(spark: SparkSession, parts: str, out: str, config: GridConfig = GridConfig(), kind: str = "parquet", days: list[str] | None = None) -> DataFrame:
    """Trajectories under a folder named by the spacing, the summary and the audit; then the checks.

    Samples are computed once and written with their verdict; trajectories, summary and
    audit are read from that. What has no samples is counted on the segments' keys and
    times alone. With ``days`` other days stay as they are.
    """
    points = _of_days(tables.read_table(spark, parts), days)
    root = f"{out.rstrip('/')}/{spacing_tag(config.dt_s)}"
    work = f"{root}/_judged"
    judged = _keep(spark, verdict.judged_trajectories(points, config), work)
    there = [str(r.date) for r in points.select("date").distinct().collect()]
    summary = _write_by_day(spark, verdict.accounts(judged, points, config), f"{root}/summary", there)
    tables.write_days(verdict.trajectories_of(judged), f"{root}/trajectories", "icao24", "trajectory_id", "sample_idx", kind=kind, days=there)
    _write_by_day(spark, verdict.dropped_of(judged, points, config), f"{root}/dropped", there, few=False)
    gates.check_trajectories(_of_days(tables.read_table(spark, f"{root}/trajectories"), days), config)
    folders.delete(spark, work)
    return summary


def run_figures(spark: SparkSession, trajectories: str, out: str) -> dict[str, DataFrame]:
    """The tables that figures are drawn from, each in a folder of ``out``: returns them by name.

    ``coverage`` (samples by cell of the map), ``extent`` (the part of it in use), ``regimes``
    (distributions), ``gallery`` (trajectories of each day across durations, with their
    tracks) and ``track`` (one trajectory with gaps filled in, in kilometres). All samples are
    read once, of few columns; the tracks of the chosen are read by their days and ids.
    """
    out = out.rstrip("/")
    samples = tables.read_table(spark, trajectories)
    if samples.isEmpty():
        raise ValueError(f"no samples in {trajectories}")
    tallied = _keep(spark, profiles.tally(samples), f"{out}/_tally")
    per = profiles.trajectories_of(tallied)
    write = lambda rows, name: rows.write.mode("overwrite").parquet(f"{out}/{name}")
    write(profiles.coverage_of(tallied), "coverage")
    write(profiles.extent(spark.read.parquet(f"{out}/coverage")), "extent")
    write(profiles.regimes_of(tallied), "regimes")
    chosen = profiles.gallery_of(per).select("date", "trajectory_id", "trajectory_duration_s", "rank").collect()  # 25 a day
    picked = profiles.pick_of(per).first()

    def of(rows: list) -> DataFrame:  # days prune folders, ids are pushed into the files
        return samples.where(F.col("date").isin(sorted({r.date for r in rows})) & F.col("trajectory_id").isin(sorted({r.trajectory_id for r in rows})))

    ranks = spark.createDataFrame([(r.date, r.trajectory_id, r["rank"]) for r in chosen], "date date, trajectory_id string, rank int")
    write(profiles.local_km(of(chosen)).join(F.broadcast(ranks), ["date", "trajectory_id"]), "gallery")  # 25 rows a day
    write(profiles.local_km(of([picked])).where(F.col("date") == F.lit(picked.date)), "track")
    folders.delete(spark, f"{out}/_tally")
    return {name: spark.read.parquet(f"{out}/{name}") for name in ("coverage", "extent", "regimes", "gallery", "track")}


#: What is told of each day by a step: words and the column of its summary.
REPORTS = {
    "segments": (
        ("reports read", "rows_input"), ("aircraft read", "unique_aircraft_input"), ("reports that are fresh, timed and the first of their time", "rows_after_freshness"),
        ("reports after cleaning", "rows_after_basic_cleaning"), ("glitches removed", "rows_removed_glitch_points"), ("segments given up, persistently too fast", "segments_discarded_persistent_violations"),
        ("reports in segments too short or slow", "rows_removed_short_segments"), ("points written", "rows_after_segmentation"), ("aircraft written", "unique_aircraft_output"),
        ("segments written", "num_segments_output"), ("median duration of a segment, s", "median_segment_duration_s"),
    ),
    "trajectories": (
        ("points read", "input_rows"), ("segments read", "input_segments"), ("samples written", "output_rows"), ("trajectories written", "output_trajectories"),
        ("segments split at long gaps", "segments_split_by_interp_gap"), ("dropped: duration", "dropped_duration"), ("dropped: too few points", "dropped_min_points"), ("dropped: speed", "dropped_speed"),
        ("dropped: acceleration", "dropped_accel"), ("dropped: turn rate", "dropped_turn_rate"), ("kept with a flag: acceleration", "flagged_accel"), ("kept with a flag: turn rate", "flagged_turn_rate"),
    ),
}


def day_reports(summary: DataFrame, step: str) -> list[str]:
    """For each day, in order, its counts in words, a line each."""
    rows = summary.orderBy("date").collect()  # a row a day
    width = max(len(words) for words, _ in REPORTS[step])
    return ["\n".join([str(r["date"]), *(f"  {words:<{width}}  {r[name]:g}" for words, name in REPORTS[step] if r[name] is not None)]) for r in rows]


def report_segments(spark: SparkSession, out: str, summary: DataFrame, config: SegmentConfig) -> list[DataFrame]:
    """What the step reports: sensitivity to the gap on the first day, consistency of days, three segments' speeds, the usual speed."""
    points = tables.read_table(spark, out)
    first = points.agg(F.min("date")).first()[0]
    day = points.where(F.col("date") == first)
    return [gates.gap_sensitivity(day, config), gates.consistency(summary), gates.segment_speeds(points, config=config), gates.cruise_anchor(points)]


def report_trajectories(spark: SparkSession, out: str, config: GridConfig) -> list[DataFrame]:
    """What the step reports: percentiles of motion, and three trajectories."""
    samples = tables.read_table(spark, f"{out.rstrip('/')}/{spacing_tag(config.dt_s)}/trajectories")
    return [gates.motion_percentiles(samples), gates.trajectory_extremes(samples)]


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=("classify", "states", "segments", "trajectories", "figures"))
    parser.add_argument("paths", nargs="*", help="inputs, then the output; without any, the usual ones below --root")
    parser.add_argument("--root", help="folder of the usual paths; else $DRIFTLINE_DATA, else data")
    parser.add_argument("--days", nargs="+", help="of the input's days only these; others stay as they are in the output")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet", help="of states, segments and trajectories")
    for kind, names in ((SegmentConfig, ("gap_split_s", "min_velocity_mps")), (GridConfig, ("dt_s", "max_gap_s", "max_accel_mps2", "max_turn_rate_deg_s"))):
        for name in names:
            parser.add_argument(f"--{name.replace('_', '-')}", type=float, default=getattr(kind, name))
    parser.add_argument("--min-duration-s", type=float, default=SegmentConfig.min_duration_s)
    parser.add_argument("--max-speed-mps", type=float, default=SegmentConfig.max_speed_mps)
    parser.add_argument("--min-points", type=int, help=f"of a segment {SegmentConfig.min_points}, of a trajectory {GridConfig.min_points} without it")
    parser.add_argument("--smooth", action="store_true")
    parser.add_argument("--drop-dynamics", action="store_true")
    return parser.parse_args(given)


def config_of(a: argparse.Namespace, kind: type) -> SegmentConfig | GridConfig:
    """The thresholds of a step as the arguments have them; those not given are the defaults."""
    given = {f.name: getattr(a, f.name) for f in dataclasses.fields(kind) if getattr(a, f.name, None) is not None}
    return kind(**given)


def main() -> None:
    a = arguments()
    usual = files.default_paths(a.dt_s, a.root)
    named = {"classify": ("registry", "whitelist"), "states": ("raw", "whitelist", "states"), "segments": ("states", "segments"), "trajectories": ("segments", "out"), "figures": ("trajectories", "figures")}
    paths = a.paths or [usual[n] for n in named[a.step]]
    spark = SparkSession.builder.getOrCreate()
    if a.step == "classify":
        run_classify(spark, *paths).show()
    elif a.step == "figures":
        for table in run_figures(spark, *paths).values():
            table.show(20, truncate=False)
    elif a.step == "states":
        for row in files.state_file_table(spark, paths[0], paths[1]).where("problem IS NOT NULL").collect():
            print(f"{row.problem}: {row.path}")
        run_states(spark, *paths, kind=a.format, days=a.days).show()
    elif a.step == "segments":
        config = config_of(a, SegmentConfig)
        summary = run_segments(spark, *paths, config, a.format, a.days)
        print("\n".join(day_reports(summary, a.step)))
        for table in report_segments(spark, paths[-1], summary, config):
            table.show(100, truncate=False)
    else:
        config = config_of(a, GridConfig)
        summary = run_trajectories(spark, *paths, config, a.format, a.days)
        print("\n".join(day_reports(summary, a.step)))
        for table in report_trajectories(spark, paths[-1], config):
            table.show(100, truncate=False)


if __name__ == "__main__":
    main()
