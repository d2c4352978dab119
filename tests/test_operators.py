"""Hand-sized rows with the results written out."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.config import GridConfig, SegmentConfig
from driftline.functions.percentile import medians, percentiles, selected, value_counts
from driftline.functions.text import flag, spacing_tag
from driftline.operators import classify, gates, grid, motion, segments, states, verdict
from driftline.operators.rules import RULES
from driftline.plans import pipeline
from driftline.plans.derived import AIRCRAFT
from driftline.plans.queries import QUERIES
from driftline.sources import files, tables

SF = "/root/testdata/sf0.001"
FIXES = "date string, icao24 string, callsign string, t double, lat double, lon double, alt double, velocity double, heading double, src_order long"


def reports(rows, columns="icao24,callsign,time,lastposupdate,lat,lon,geoaltitude,baroaltitude,velocity,heading,vertrate,onground"):
    return "\n".join([columns, *rows]) + "\n"


def fixes(spark, rows):
    """Rows of t, lat, lon and optionally callsign, velocity, heading."""
    full = [("2022-06-06", "00000a", *(r[3:4] or ("A",)), float(r[0]), float(r[1]), float(r[2]), 1000.0, *(r[4:5] or (50.0,)), *(r[5:6] or (0.0,)), k) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, FIXES)


def test_model_codes_and_types(spark):
    rows = [("CESSNA", "172", "L1P", "abc123"), ("CESSNA", "172S", "L1P", "ABC123"), ("CESSNA", "R172K", None, "010203"), ("CESSNA", "1172", "L1P", "abc124"), ("CESSNA", "172", "H1P", "abc125"),
            ("CESSNA", "310", "L2T", "abc126"), ("CESSNA", "C-145", "L1P", "abc127"), ("CESSNA", "172", "L1P", "abc12"), ("PIPER", "PA-28 GLIDER", "L1P", "abc128"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "manufacturername string, model string, icaoaircrafttype string, icao24 string")
    assert [r.is_kept for r in classify.flags(df).collect()] == [True, True, True, False, True, False, False, False, False, False]
    assert classify.funnel(df.limit(0)).first().rows_total == 0
    with pytest.raises(ValueError, match="icao24"):
        classify.flags(df.drop("icao24"))


def test_flags_and_tags(spark):
    rows = [(x,) for x in ("True", "true", "1", "0", "", None)]
    assert [r[0] for r in spark.createDataFrame(rows, "x string").select(flag(F.col("x"))).collect()] == [True, True, True, False, False, False]
    assert (spacing_tag(10.0), spacing_tag(2.5)) == ("10s", "2p5s")


def test_freshness(spark):
    rows = [(10.0, 11.0), (10.0, 10.0), (20.0, 10.0), (20.5, 10.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "time double, lastposupdate double")
    assert [r[0] for r in segments.fresh(df).collect()] == [10.0, 20.0]
    assert segments.fresh(df.drop("time")).count() == 5


def test_whitelist_join(spark):
    keys = states.whitelist_keys(spark.createDataFrame([(" ABC123",), ("abc123",), ("",), (None,)], "icao24 string"))
    rows = spark.createDataFrame([("abc123 ",), ("ABC123",), ("xyz",), (None,), ("",)], "icao24 string")
    assert sorted(r[0] for r in states.of_whitelist(rows, keys).collect()) == ["ABC123", "abc123 "]
    assert sorted(r[0] for r in states.of_whitelist(rows, keys, most=0).collect()) == ["ABC123", "abc123 "]
    assert "BroadcastHashJoin" in states.of_whitelist(rows, keys)._jdf.queryExecution().executedPlan().toString()


def starts(spark, rows):
    return [r.t for r in segments.assign_segments(fixes(spark, rows)).where("starts_segment").orderBy("t").collect()]


def test_callsigns_and_gaps(spark):
    at = lambda *calls: [(10 * k, 40, 8, c) for k, c in enumerate(calls)]
    assert starts(spark, at("A", "", "A")) == [0]
    assert starts(spark, at("A", "", "B")) == [0, 20]
    assert starts(spark, [(0, 40, 8, "A"), (90, 40, 8, None), (100, 40, 8, "B")]) == [0, 90, 100]
    assert starts(spark, [(0, 40, 8), (60, 40, 8), (120.5, 40, 8)]) == [0, 120.5]


def numpy_glitches(t, lat, lon):
    keep = list(range(len(t)))

    def fast(keep):
        la, lo = np.radians(np.array(lat)[keep]), np.radians(np.array(lon)[keep])
        h = np.sin(np.diff(la) / 2) ** 2 + np.cos(la[:-1]) * np.cos(la[1:]) * np.sin(np.diff(lo) / 2) ** 2
        return 2 * 6371000 * np.arcsin(np.sqrt(h)) / np.diff(np.array(t)[keep]) > 300 * 0.514444

    for _ in range(3):
        bad = fast(keep) if len(keep) > 1 else np.zeros(0, bool)
        if not bad.any():
            break
        touch = np.concatenate([bad, [0]]) + np.concatenate([[0], bad])
        del keep[int(np.argmax(touch))]
    bad = fast(keep) if len(keep) > 1 else np.zeros(0, bool)
    return keep, bool(len(bad) and bad.mean() > 0.05)


@pytest.mark.parametrize("glitches", [(), (4,), (7,), (0,), (3, 5), (2, 4, 6), (1, 3, 5, 6)])
def test_glitches_as_in_numpy(spark, glitches):
    rows = [(10 * k, 40 + 0.004 * k + (0.5 if k in glitches else 0), 8 + 0.001 * k) for k in range(8)]
    found = segments.remove_glitches(segments.assign_segments(fixes(spark, rows))).orderBy("t").collect()
    keep, persistent = numpy_glitches(*zip(*rows))
    assert [int(r.t / 10) for r in found] == keep
    assert {r.is_persistent for r in found} == {persistent} and {r.points_removed for r in found} == {8 - len(keep)}


def test_one_exchange_serves_all_windows(spark):
    made = segments.judged_segments(segments.remove_glitches(segments.assign_segments(fixes(spark, [(0, 1, 1)]).repartition(3))))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def scans_and_wide_exchanges(df):
    """Reads of files, and exchanges of what wasn't aggregated before."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.split("\n")
    wide = [k for k, x in enumerate(lines) if "Exchange hashpartitioning" in x and "Reused" not in x and not any("Aggregate" in y for y in lines[k + 1 : k + 3])]
    return len(re.findall(r"FileScan parquet|Scan parquet", plan)), len(wide)


def test_summaries_and_trajectories_in_few_passes(spark):
    assert scans_and_wide_exchanges(QUERIES["valid_segments"](spark, SF)) == (1, 1)
    assert scans_and_wide_exchanges(QUERIES["trajectory_table"](spark, SF)) == (1, 1)
    for name in ("stage3_summary", "stage4_summary"):
        assert scans_and_wide_exchanges(QUERIES[name](spark, SF))[0] <= 2


def test_exact_percentiles_as_in_numpy(spark):
    r = np.random.default_rng(5)
    groups = {"a": r.gamma(2, 30, 4000), "b": np.round(r.normal(0, 2, 999), 1), "c": np.array([7.5]), "d": np.array([-1e300, 0.0, 1e-300, 5.0]), None: np.repeat([1.0, 2.0], [3, 5])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    ps = (0.0, 0.05, 0.5, 0.95, 0.99, 1.0)
    channels, wanted = {"x": F.col("x"), "y": -F.col("x")}, {"x": ps, "y": (0.5,)}
    found = percentiles(value_counts(df, ["g"], channels), ["g"], wanted).collect()
    assert len(found) == len(groups) * 7
    assert sorted(map(tuple, selected(df, ["g"], channels, wanted).collect()), key=repr) == sorted(map(tuple, found), key=repr)
    for f in found:
        want = np.percentile(groups[f.g] * (1 if f.channel == "x" else -1), 100 * f.p)
        assert math.isclose(f.x, want, rel_tol=1e-12, abs_tol=1e-12), f
    assert medians(df.where("x IS NULL"), F.col("x")).collect() == []


def test_selection_shuffles_bins_and_few_values(spark):
    """Ten times the samples are ten times the values, but no more rows in the shuffles than there are bins and values of some bins."""
    def shuffled(n):
        rows = spark.range(n).selectExpr("rand(3) * 5e-3 AS x")  # some 7,000 bins
        store = spark._jsparkSession.sharedState().statusStore()
        before = store.executionsCount()
        medians(rows, F.col("x")).collect()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        metrics = [(store.executionsList().apply(k), store.executionMetrics(store.executionsList().apply(k).executionId())) for k in range(before, store.executionsCount())]
        total = 0
        for execution, values in metrics:
            for k in range(execution.metrics().size()):
                m = execution.metrics().apply(k)
                if m.name() == "shuffle records written" and values.get(m.accumulatorId()).isDefined():
                    total += int(values.get(m.accumulatorId()).get().replace(",", ""))
        return total

    few, many = shuffled(30_000), shuffled(300_000)
    assert 0 < many < 2.5 * few


def test_pauses_count_once_for_aircraft_that_do_not_differ(spark):
    config = SegmentConfig(gap_split_s=60, min_duration_s=10, min_points=2)
    rows = [("2022-06-06", a, "A", float(t), 40 + 1e-4 * t, 8.0, 1000.0, 50.0, 0.0, k) for a, ts in (("a", range(0, 100, 10)), ("b", [0, 10, 20, 110, 120, 130, 300, 310, 330]), ("c", [0, 10, 300, 310])) for k, t in enumerate(ts)]
    points = segments.segments_of(spark.createDataFrame([(*r, r[3], False) for r in rows], "date string, icao24 string, callsign string, lastposupdate double, lat double, lon double, geoaltitude double, velocity double, heading double, src_order long, time double, onground boolean"), config)
    found = {r.gap_split_s: (r.num_segments, r.total_points_kept) for r in gates.gap_sensitivity(points, config).collect()}
    assert found == {60.0: (6, 23), 120.0: (5, 23), 180.0: (4, 23)}


def test_reports_without_an_id_are_spread(spark):
    rows = spark.range(4000).selectExpr("'2022-06-06' AS date", "' ' AS icao24", "cast(id AS double) AS t", "id AS src_order")
    assert segments.dealt(rows).select("_aircraft").distinct().count() == segments.first_reports(rows).count() == 4000


def gridded(spark, rows, config=GridConfig()):
    seg = segments.assign_segments(fixes(spark, rows)).drop("starts_segment")
    return grid.on_grid(grid.pieces(seg, config.max_gap_s), config).orderBy("trajectory_id", "sample_idx")


def test_grid(spark):
    found = gridded(spark, [(0, 40, 8), (4, 41, 8), (12, 43, 8), (25, 45, 8), (25, 99, 9)]).collect()
    assert [(r.timestamp, r.n_samples) for r in found] == [(0, 3), (10, 3), (20, 3)]
    assert np.allclose([r.lat_interp for r in found], np.interp([0, 10, 20], [0, 4, 12, 25], [40, 41, 43, 45]))
    assert [r.is_interpolated for r in gridded(spark, [(0, 1, 1), (15, 1, 1), (30, 1, 1)]).collect()] == [False, False, False, False]
    assert [r.is_interpolated for r in gridded(spark, [(0, 1, 1), (15.5, 1, 1), (30, 1, 1)]).collect()] == [False, True, False, False]
    parts = gridded(spark, [(0, 1, 1), (10, 1, 1), (41, 1, 1), (50, 1, 1)]).collect()
    assert [(r.trajectory_id[-2:], r.timestamp) for r in parts] == [("r0", 0), ("r0", 10), ("r1", 41)]


def test_date_line_and_north(spark):
    found = grid.output_longitudes(gridded(spark, [(0, 0, 179.9, "A", 50.0, 359.0), (20, 0, -179.9, "A", 50.0, 1.0)])).collect()
    assert np.allclose([abs(r.lon_interp) for r in found], [179.9, 180, 179.9])
    assert np.allclose([(r.heading_interp + 180) % 360 for r in found], [179, 180, 181])


def test_reported_channels_clamp(spark):
    rows = [(0, 1, 1, "A", None), (10, 1, 1, "A", 10.0), (20, 1, 1, "A", None), (30, 1, 1, "A", 30.0), (40, 1, 1, "A", None)]
    assert [r.velocity_interp for r in gridded(spark, rows).collect()] == [10, 10, 20, 30, 30]
    assert {r.velocity_interp for r in gridded(spark, [(0, 1, 1, "A", 5.0), (10, 1, 1, "A", None)]).collect()} == {None}


def test_steady_turn(spark):
    rows = [(10 * k, math.degrees(1000 * math.sin(k * 0.3) / 6371000), math.degrees(1000 * math.cos(k * 0.3) / 6371000)) for k in range(12)]
    found = motion.motion(gridded(spark, rows)).orderBy("sample_idx").collect()
    assert found[0].speed_mps == found[1].speed_mps and found[1].accel_mps2 is None and found[1].turn_rate_deg_s is None
    assert all(abs(r.accel_mps2) < 1e-6 and r.accel_vector_mps2 > 0.5 for r in found[2:])
    assert np.allclose([r.turn_rate_deg_s for r in found[2:]], -math.degrees(0.3) / 10, atol=1e-3)


def test_raw_buckets(spark):
    """A step whose middle is exactly a grid time belongs to that sample; what is late, to the last one."""
    seg = segments.assign_segments(fixes(spark, [(0, 0, 0), (8, 0.01, 0), (12, 0.02, 0), (29, 0.03, 0)])).drop("starts_segment")
    found = {r.sample_idx: r for r in motion.raw_dynamics(grid.pieces(seg), 10.0).collect()}
    degree = 6371000 * math.pi / 180
    assert {k: r.n_raw_fixes for k, r in found.items()} == {0: 1, 1: 1, 2: 2}
    assert math.isclose(found[1].raw_speed_max_mps, 0.01 * degree / 4)
    assert math.isclose(found[2].raw_speed_max_mps, 0.01 * degree / 17, rel_tol=1e-6)


def test_smoothing(spark):
    config = GridConfig(smooth=True)
    found = gridded(spark, [(0, 1, 1), (10, 5, 1), (20, 2, 1), (30, 3, 1)], config).collect()
    assert [r.lat_smooth for r in found] == [3.0, 2.0, 3.0, 2.5]


def test_verdicts(spark):
    far = [(10 * k, 40 + 0.05 * k, 8) for k in range(10)]
    seg = segments.assign_segments(fixes(spark, far)).drop("starts_segment")
    assert {r.reason for r in verdict.dropped(seg).collect()} == {"duration"}  # too fast as well
    loose = GridConfig(min_duration_s=50, min_points=5)
    assert {r.reason for r in verdict.dropped(seg, loose).collect()} == {"speed"}
    assert [(r.reason, r.n_samples) for r in verdict.dropped(segments.assign_segments(fixes(spark, [(0, 1, 1)])), loose).collect()] == [("min_points", 1)]
    turns = [(10 * k, 40 + 0.004 * (k % 2), 8 + 0.005 * k) for k in range(10)]
    seg = segments.assign_segments(fixes(spark, turns)).drop("starts_segment")
    kept = verdict.trajectories(seg, loose).collect()
    assert len(kept) == 10 and all(r.exceeds_turn_rate_limit and not r.exceeds_accel_limit for r in kept)
    assert {r.reason for r in verdict.dropped(seg, GridConfig(min_duration_s=50, min_points=5, drop_dynamics=True)).collect()} == {"turn_rate"}


def test_from_files_to_trajectories(spark, tmp_path):
    (tmp_path / "registry.csv").write_text("icao24,manufacturername,model,icaoaircrafttype,owner\n00000a,CESSNA,172S,L1P,N/A\n00000b,BOEING,737,L2J,x\n")
    lines = ["icao24,callsign,time,lastposupdate,lat,lon,geoaltitude,baroaltitude,velocity,heading,vertrate,onground"]
    for k in range(60):
        lines.append(f"00000A,T1,{10 * k + 1},{10 * k},{40 + 0.005 * k},8,1000,,55,0,0,False")
        lines.append(f"00000b,T2,{10 * k + 1},{10 * k},{40 + 0.005 * k},8,1000,,55,0,0,False")
    lines.append("00000a,T1,1,0,40,8,0,,0,0,0,True")
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "states_2022-06-06-00.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "raw" / "states_undated.csv").write_text("\n".join(lines[:9]) + "\n")
    at = str(tmp_path)
    assert pipeline.run_classify(spark, f"{at}/registry.csv", f"{at}/whitelist").first().rows_kept == 1
    assert spark.read.option("header", True).csv(f"{at}/whitelist").first().owner is None
    assert [(r.rows, r.aircraft) for r in pipeline.run_states(spark, f"{at}/raw", f"{at}/whitelist", f"{at}/daily_states").collect()] == [(61, 1)]
    summary = pipeline.run_segments(spark, f"{at}/daily_states", f"{at}/segments").first()
    assert (summary.rows_input, summary.rows_after_segmentation, summary.num_segments_output) == (61, 60, 1)
    last = pipeline.run_trajectories(spark, f"{at}/segments", f"{at}/out").first()
    assert (last.output_trajectories, last.output_rows) == (1, 60)
    with pytest.raises(gates.GateError, match="no trajectory"):
        gates.check_trajectories(spark.read.parquet(f"{at}/out/10s/trajectories").limit(0))


def test_files_and_columns():
    assert files.state_files(["b_2022-06-06.CSV", "a_2022-06-13.csv", "aircraftDatabase-2022-06.csv", "x_sorted_2022-06-06.csv", "undated.csv", "a.txt"]) == ["a_2022-06-13.csv", "b_2022-06-06.CSV"]
    with pytest.raises(ValueError):
        tables.timestamp_column(["icao24"])
    assert SegmentConfig().max_speed_mps == 300 * 0.514444


def test_columns_go_by_each_files_own_header(spark, tmp_path):
    (tmp_path / "a_2022-06-06.csv").write_text("time,lat,lon,icao24\n1,2,3,00001\n")
    (tmp_path / "b_2022-06-06.csv").write_text("\ufefflat,icao24,lon,time,callsign\n20,00002,30,10,x\n,None,NaN,11,\n")
    (tmp_path / "c_2022-06-06.csv").write_text("icao24,time\n")
    (tmp_path / "d_2022-06-06.csv").write_text("")
    (tmp_path / "_hidden.csv").write_text("junk\n1\n")
    found = sorted(tables.read_csv(spark, str(tmp_path)).collect(), key=lambda r: r.time)
    assert [(r.time, r.lat, r.lon, r.icao24, r.callsign) for r in found] == [(1, 2, 3, "00001", None), (10, 20, 30, "00002", "x"), (11, None, None, None, None)]
    assert {r.src_file for r in found} == {"a_2022-06-06.csv", "b_2022-06-06.csv"}
    assert list(files.headers(spark, files.list_files(spark, str(tmp_path / "[cd]*"))).values()) == [("icao24", "time"), None]
    with pytest.raises(ValueError, match="no file"):
        tables.read_csv(spark, str(tmp_path / "d*"))


def test_format_is_what_a_file_holds(spark, tmp_path):
    spark.range(3).selectExpr("cast(id AS double) AS x").write.parquet(f"{tmp_path}/any_name")
    spark.range(3).selectExpr("cast(id AS double) AS x").write.option("header", True).csv(f"{tmp_path}/segments")
    assert sorted(r.x for r in tables.read_table(spark, f"{tmp_path}/any_name").collect()) == [0, 1, 2]
    assert sorted(r.x for r in tables.read_table(spark, f"{tmp_path}/segments").collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="no file with bytes"):
        tables.read_table(spark, f"{tmp_path}/none")


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_steps_on_a_folder_with_other_files(spark, tmp_path, kind):
    raw, at = tmp_path / "raw", str(tmp_path)
    raw.mkdir()
    (raw / "aircraftDatabase-2022-06-06.csv").write_text("icao24,manufacturername,model,icaoaircrafttype\n00000a,CESSNA,172S,L1P\n")
    good = [f"00000A,T1,{10 * k + 1},{10 * k},{40 + 0.005 * k},8,1000,,55,0,0,False" for k in range(60)]
    (raw / "states_2022-06-06-01.csv").write_text(reports(good[30:]))
    (raw / "states_2022-06-06-00.csv").write_text(reports([*good[:30], "00000a,T1,1,0,40,8,0,,0,0,0,True", "00000a,T1,,,40,8,0,,0,0,0,False"]))
    (raw / "states_2022-06-13-00.csv").write_text(reports(["00000a,T1,1,0,40,8,1000,,55,0,0,False"]))
    (raw / "states_2022-06-20-00.csv").write_text("")
    (raw / "states_2022-06-27-00.csv").write_text(reports([]))
    (raw / "filtered_2022-06-06.csv").write_text(reports(good))
    assert [f.name[7:17] for f in files.discover_states(spark, str(raw))] == ["2022-06-06", "2022-06-06", "2022-06-13", "2022-06-20", "2022-06-27"]
    pipeline.run_classify(spark, f"{raw}/aircraftDatabase*.csv", f"{at}/whitelist")
    counts = pipeline.run_states(spark, str(raw), f"{at}/whitelist", f"{at}/daily", kind)
    assert {str(r.date): r.rows for r in counts.collect()} == {"2022-06-06": 62, "2022-06-13": 1}
    there = {p.name for p in (tmp_path / "daily").iterdir() if p.name.startswith("date=")}
    assert there == {f"date=2022-06-{d}" for d in ("06", "13", "20", "27")}
    times = [r.time for r in tables.read_table(spark, f"{at}/daily").where("date = '2022-06-06'").collect()]
    assert times == sorted(t for t in times if t is not None) + [None]
    config = SegmentConfig(min_points=10)
    summary = {str(r.date): r for r in pipeline.run_segments(spark, f"{at}/daily", f"{at}/out_segments", config, kind).collect()}
    assert summary["2022-06-06"].rows_after_segmentation == 60 and summary["2022-06-13"].num_segments_output == 0
    for table in pipeline.report_segments(spark, f"{at}/out_segments", spark.createDataFrame(list(summary.values())), config):
        assert table.count() > 0
    last = {str(r.date): r.output_rows for r in pipeline.run_trajectories(spark, f"{at}/out_segments", f"{at}/out", kind=kind).collect()}
    assert last == {"2022-06-06": 60}
    assert [t.count() for t in pipeline.report_trajectories(spark, f"{at}/out", GridConfig())] == [4, 1]
    (raw / "states_2022-06-27-01.csv").write_text("icao24,lat\n1,2\n")
    with pytest.raises(ValueError, match="time"):
        pipeline.run_states(spark, str(raw), f"{at}/whitelist", f"{at}/again", kind)


def test_arguments(monkeypatch):
    a = pipeline.arguments(["segments", "--min-points", "7", "--max-speed-mps", "90", "--root", "/x"])
    assert pipeline.config_of(a, SegmentConfig) == SegmentConfig(min_points=7, max_speed_mps=90)
    b = pipeline.arguments(["trajectories", "in", "out", "--dt-s", "2.5", "--max-accel-mps2", "5", "--max-turn-rate-deg-s", "3", "--smooth"])
    assert pipeline.config_of(b, GridConfig) == GridConfig(dt_s=2.5, max_accel_mps2=5, max_turn_rate_deg_s=3, smooth=True)
    assert files.default_paths(2.5, "/x/")["trajectories"] == "/x/resampled/2p5s/trajectories"
    monkeypatch.setenv("DRIFTLINE_DATA", "/y")
    assert files.default_paths()["states"] == "/y/states"


def test_gates_raise(spark):
    with pytest.raises(gates.GateError, match="ground"):
        gates.check_segments(spark.createDataFrame([(0,), (None,)], "removed_on_ground int"))
    row = lambda k, t, v: ("2022-06-06", "a", "s", "s_r0", k, float(t), v, 600.0, 60)
    made = lambda rows: spark.createDataFrame(rows, "date string, icao24 string, segment_id string, trajectory_id string, sample_idx long, timestamp double, speed_mps double, trajectory_duration_s double, n_samples long")
    gates.check_trajectories(made([row(0, 0, 50.0), row(1, 10, 50.0)]))
    for rows, words in (([row(0, 0, 50.0), row(1, 11, 50.0)], "isn't 10 s"), ([row(0, 0, 5.0)], "median speed"), ([row(0, 0, None)], "median speed"), ([row(0, 0, 50.0)[:7] + (10.0, 60)], "shorter")):
        with pytest.raises(gates.GateError, match=words):
            gates.check_trajectories(made(rows))


def test_every_brand_is_met_in_each_of_its_branches():
    """The derived registry has a row for each pattern group of each rule, so that a slip in one shows."""
    for rule in RULES:
        own = [m.upper().strip() for b, m, _ in AIRCRAFT if b and re.search(rule.brand, b.upper().strip()) and m]
        assert any(re.search(rule.keep, m) and not (rule.drop and re.search(rule.drop, m)) for m in own) and any(not re.search(rule.keep, m) for m in own), rule.name
        for pattern in filter(None, (rule.drop, rule.trusted, rule.too_large)):
            assert any(re.search(pattern, m) for m in own), (rule.name, pattern)
