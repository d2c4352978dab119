"""Steps on files: what they read, what they leave, and what figures are drawn from."""

import re

import pytest
from pyspark.sql import functions as F

from driftline.config import GridConfig
from driftline.operators import grid, profiles, states, verdict
from driftline.plans import derived, pipeline
from driftline.plans.queries import GRID, SEGMENTS, valid
from driftline.sources import tables
from driftline.sources.folders import written

SF = "/root/testdata/sf0.001"
DAYS = {"2022-06-06", "2022-06-13", "2022-06-20", "2022-06-27"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("steps"))
    tables.write_days(derived.states(spark, SF), f"{at}/daily", "icao24", "src_order")
    return at


def scans(spark, path, job):
    """The plans' reads of a folder's files while ``job`` runs: the columns of each."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    out = job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = []
    for k in range(before, store.executionsCount()):
        plan = store.executionsList().apply(k).physicalPlanDescription()
        found += re.findall(rf"Scan parquet[^\n]*\nOutput[^\n]*\[([^\n]*)\]\nBatched[^\n]*\nLocation: InMemoryFileIndex[^\n]*{re.escape(path)}\]", plan)
    return out, found


def test_each_step_reads_its_input_once(spark, folder):
    summary, found = scans(spark, f"{folder}/daily", lambda: pipeline.run_segments(spark, f"{folder}/daily", f"{folder}/segments", SEGMENTS))
    assert len([c for c in found if "lat" in c]) == 1 and len(found) <= 2
    want = valid(spark, SF)
    got = tables.read_table(spark, f"{folder}/segments")
    keys = ["icao24", "segment_id", "src_order", "t", "segment_duration_s"]
    assert sorted(map(tuple, got.select(keys).collect())) == sorted(map(tuple, want.select(keys).collect()))
    assert {str(r.date) for r in summary.collect()} == DAYS and summary.agg(F.sum("rows_after_segmentation")).first()[0] == got.count()
    last, found = scans(spark, f"{folder}/segments", lambda: pipeline.run_trajectories(spark, f"{folder}/segments", f"{folder}/out", GRID))
    assert len([c for c in found if "lat" in c]) == 1
    samples = tables.read_table(spark, f"{folder}/out/10s/trajectories")
    assert last.agg(F.sum("output_rows")).first()[0] == samples.count() == verdict.trajectories(want, GRID).count()
    audit = spark.read.option("header", True).csv(f"{folder}/out/10s/dropped")
    assert audit.count() == verdict.dropped(want, GRID).count()
    assert not list(p for p in (tables.list_files(spark, folder)) if "_judged" in p.path)


def test_one_day_through_all_steps(spark, folder):
    """A rerun of a day replaces its rows of tables, summaries and audit, and no others."""
    pipeline.run_segments(spark, f"{folder}/daily", f"{folder}/segments", SEGMENTS)
    pipeline.run_trajectories(spark, f"{folder}/segments", f"{folder}/out", GRID)
    count = lambda: {str(r.date): r["count"] for r in tables.read_table(spark, f"{folder}/out/10s/trajectories").groupBy("date").count().collect()}
    listed = lambda: {f.path for f in tables.list_files(spark, f"{folder}/out/10s/trajectories") if "date=2022-06-13" not in f.path}
    before, files = count(), listed()
    changed = GridConfig(**{**GRID.__dict__, "min_points": 10**6})
    summary = pipeline.run_trajectories(spark, f"{folder}/segments", f"{folder}/out2", GRID)
    with pytest.raises(Exception, match="no trajectory"):
        pipeline.run_trajectories(spark, f"{folder}/segments", f"{folder}/out", changed, days=["2022-06-13"])
    assert count() == {d: n for d, n in before.items() if d != "2022-06-13"} and listed() == files
    rows = {str(r.date): r.output_rows for r in spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/out/10s/summary").collect()}
    assert rows == {**{str(r.date): r.output_rows for r in summary.collect()}, "2022-06-13": 0}
    assert len(pipeline.day_reports(summary, "trajectories")) == 4 and "dropped: turn rate" in pipeline.day_reports(summary, "trajectories")[0]


def test_figures_from_one_read(spark, folder):
    at = f"{folder}/figures-in"
    tables.write_days(verdict.trajectories(valid(spark, SF), GRID), at, "icao24", "trajectory_id", "sample_idx")
    found, read = scans(spark, at, lambda: pipeline.run_figures(spark, at, f"{folder}/figures"))
    assert len([c for c in read if "speed_mps" in c]) == 1  # the distributions; tracks are read by ids
    samples = tables.read_table(spark, at)
    same = lambda a, b: sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(a.columns).collect()), key=repr)
    assert same(found["coverage"], profiles.coverage(samples)) and same(found["regimes"], profiles.regimes(samples))
    assert same(found["extent"], profiles.extent(profiles.coverage(samples)))
    chosen = {(r.date, r.trajectory_id, r["rank"]) for r in profiles.gallery(samples).collect()}
    assert {(r.date, r.trajectory_id, r["rank"]) for r in found["gallery"].select("date", "trajectory_id", "rank").distinct().collect()} == chosen
    picked = profiles.pick(samples).first()
    assert {(r.date, r.trajectory_id) for r in found["track"].collect()} == {(picked.date, picked.trajectory_id)} and found["track"].count() == picked.n_samples
    with pytest.raises(ValueError, match="no samples"):
        pipeline.run_figures(spark, f"{folder}/empty", f"{folder}/x") if tables.write_days(samples.limit(0), f"{folder}/empty", "t" if "t" in samples.columns else "timestamp", days=["2022-06-06"]) is None else None


def test_fixes_emit_samples_and_nothing_else(spark):
    """At fixes and grid points in any position, also ones that division misses by a bit."""
    rows = [("2022-06-06", "a", "a_0", 0.1 * k * (1 + k % 3), 40 + 0.001 * k, 8.0, 900.0, float(k % 7), k) for k in range(120)]
    rows += [("2022-06-06", "b", "b_0", 1e9 + 10.0 * k + (1e-7 if k % 4 == 1 else 0), 40.0, 8.0, 900.0, 1.0, k) for k in range(40)]
    kind = "date string, icao24 string, segment_id string, t double, lat double, lon double, alt double, velocity double, src_order long"
    points = spark.createDataFrame(rows, kind).withColumns({"segment_start_time": F.lit(0.0), "segment_end_time": F.lit(1.0), "segment_duration_s": F.lit(1.0)})
    for dt in (0.1, 0.3, 10.0):
        pieces = grid.pieces(points, 30.0)
        samples = grid.on_grid(pieces, GridConfig(dt_s=dt))
        got = samples.groupBy("trajectory_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sample_idx").alias("d"), F.max("n_samples").alias("want")).collect()
        assert all(r.n == r.d == r.want for r in got) and len(got) == 2
        samples.collect()
        plan = samples._jdf.queryExecution().executedPlan()
        assert "Generate" in plan.toString() and not re.search(r"Filter[^\n]*timestamp", plan.toString())


def test_membership_beyond_a_broadcast(spark):
    keys = spark.range(3000).selectExpr("lower(lpad(hex(id * 7), 6, '0')) AS icao24")
    rows = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN upper(lpad(hex(id), 6, '0')) ELSE lpad(hex(id), 6, '0') END AS icao24", "id")
    listed = written(keys, "keys")
    near = states.passing(rows, states.key_filter(listed, listed.count()))
    found = states.of_whitelist(rows, keys, most=0)
    want = sorted(7 * k for k in range(3000) if 7 * k < 40_000)
    assert sorted(r.id for r in found.collect()) == want
    assert len(want) <= near.count() <= len(want) + 0.03 * 40_000
    assert states.passing(rows, states.key_filter(listed.limit(0), 0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan


def test_the_registry_is_read_once(spark, tmp_path):
    spark.range(100).selectExpr("lower(lpad(hex(id), 6, '0')) AS icao24").write.parquet(f"{tmp_path}/registry")
    rows = spark.range(50).selectExpr("lpad(hex(id), 6, '0') AS icao24")
    job = lambda: states.of_whitelist(rows, states.whitelist_keys(spark.read.parquet(f"{tmp_path}/registry"))).collect()
    found, read = scans(spark, f"{tmp_path}/registry", job)
    assert len(found) == 50 and len(read) == 1
