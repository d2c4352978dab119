"""Which files are read, in which order their rows stand, and what is written."""

import gzip
import random
import time

import pytest
from pyspark.sql import functions as F

from driftline.plans import derived, pipeline
from driftline.plans.queries import QUERIES
from driftline.sources import files, tables


def in_order(df):
    return [tuple(r) for r in df.orderBy("src_order").drop("src_order").collect()]


@pytest.fixture
def split_bytes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda size, cost=0: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", str(cost)))
    for name, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
        spark.conf.set(f"spark.sql.files.{name}", value)


@pytest.mark.parametrize("size, cost", [(128 << 20, 4 << 20), (64 << 10, 0), (4096, 0), (700, 100), (97, 0)])
def test_rows_keep_the_order_of_files_whatever_sizes_headers_and_splits(spark, tmp_path, split_bytes, size, cost):
    split_bytes(size, cost)
    r, want = random.Random(3), []
    for name, n, columns in (("a 1.csv", 1, "x,y"), ("b.csv", 900, "y,x"), ("c%20.csv", 3, "x"), ("d.csv", 0, "x,y"), ("z.csv", 40, "y,x"), ("é.csv", 300, "x,y")):
        rows = [(r.randrange(10**9), "p" * r.randrange(30)) for _ in range(n)]
        of = {"x": lambda v: str(v[0]), "y": lambda v: v[1]}
        (tmp_path / name).write_text("\n".join([columns, *(",".join(of[c](v) for c in columns.split(",")) for v in rows)]) + "\n")
        want += [(float(v[0]), (v[1] or None) if "y" in columns else None, name) for v in rows]
    found = tables.read_csv(spark, str(tmp_path), numbers=("x",)).select("x", "y", "src_file", "src_order")
    assert in_order(found) == want
    assert found.select("src_order").distinct().count() == len(want)


def test_first_report_is_of_the_first_file_by_name(spark, tmp_path):
    """A small file comes first by name though readers take large ones first; of one name in two folders both are read."""
    line = lambda lat, n: "icao24,time,lat\n" + "".join(f"00000a,{t},{lat}\n" for t in range(1, n + 1))
    for folder, hour, lat, n in (("b", "00", 20, 400), ("a", "00", 10, 1), ("a", "01", 30, 500)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"states_2022-06-06-{hour}.csv").write_text(line(lat, n))
    found = files.discover_states(spark, str(tmp_path))
    assert [f.path.rsplit("/", 2)[1:] for f in found] == [["a", "states_2022-06-06-00.csv"], ["b", "states_2022-06-06-00.csv"], ["a", "states_2022-06-06-01.csv"]]
    rows = tables.read_csv(spark, [f.path for f in found])
    assert rows.count() == 901
    first = rows.groupBy("time").agg(F.min_by("lat", "src_order").alias("lat")).orderBy("time").collect()
    assert [r.lat for r in first[:2]] == [10, 20] and first[450].lat == 30


def test_what_is_not_read_is_told(spark, tmp_path):
    for name, text in (("states_2022-06-06.csv", "icao24,time\n"), ("empty_2022-06-06.csv", ""), ("undated.csv", "icao24,time\n"), ("no_id_2022-06-06.csv", "time\n"), ("no_time_2022-06-06.csv", "icao24\n"), ("x_sorted_2022-06-06.csv", "a\n"), ("notes.txt", "")):
        (tmp_path / name).write_text(text)
    found = {r.name: r.problem for r in files.state_file_table(spark, str(tmp_path)).collect()}
    assert found == {"states_2022-06-06.csv": None, "empty_2022-06-06.csv": "empty", "undated.csv": "undated", "no_id_2022-06-06.csv": "no icao24", "no_time_2022-06-06.csv": "no time"}
    assert files.state_file_table(spark, str(tmp_path / "none")).collect() == []


def test_lists_are_of_files_that_are_there(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name in ("in/b 1.csv", "in/deep/a.csv", "in/_hidden.csv", "in/.x.csv"):
        (tmp_path / name).write_text("x\n1\n")
    with gzip.open(tmp_path / "in" / "z.csv.gz", "wt") as f:
        f.write("\ufeffé,\"y,z\"\n1,2\n")
    found = files.list_files(spark, str(tmp_path / "in"))
    assert [f.name for f in found] == ["b 1.csv", "a.csv", "z.csv.gz"] and [f.size for f in found[:2]] == [4, 4]
    assert list(files.headers(spark, found).values()) == [("x",), ("x",), ("é", "y,z")]
    assert [f.name for f in files.list_files(spark, [str(tmp_path / "in" / "b*"), str(tmp_path / "none"), f"{tmp_path}/in/b 1.csv"])] == ["b 1.csv"]
    assert files.list_files(spark, str(tmp_path / "no*")) == []


def test_ten_thousand_files_in_under_a_minute(spark, tmp_path):
    for k in range(10_000):
        (tmp_path / f"s{k:05d}_2022-06-{k % 28 + 1:02d}.csv").write_text("icao24,time\n" if k % 3 else "time,icao24,lat\n")
    began = time.monotonic()
    found = files.state_file_table(spark, str(tmp_path)).groupBy("columns").count().collect()
    assert {len(r["columns"]): r["count"] for r in found} == {2: 6666, 3: 3334}
    assert time.monotonic() - began < 60


def made(spark, days, n=20, more=()):
    rows = [(d, float(k), k) for d in days for k in range(n)]
    df = spark.createDataFrame(rows, "day string, t double, src_order long").select(F.to_date("day").alias("date"), "t", "src_order", *[F.lit(v).alias(c) for c, v in more])
    return df


def stamps(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in path.rglob("date=*/part-*")}


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_one_day_is_written_anew_and_others_stay(spark, tmp_path, kind):
    out = tmp_path / "out"
    days = ["2022-06-06", "2022-06-13", "2022-06-20"]
    tables.write_days(made(spark, days[:2]), str(out), "t", kind=kind, days=days)
    before = stamps(out)
    assert {p.parts[0] for p in before} >= {f"date={d}" for d in days}
    tables.write_days(made(spark, days[1:2], 5), str(out), "t", kind=kind, days=days[1:2])
    after = stamps(out)
    assert {p: s for p, s in before.items() if f"date={days[1]}" not in p.parts} == {p: s for p, s in after.items() if f"date={days[1]}" not in p.parts}
    assert sorted(map(str, before)) != sorted(map(str, after))
    count = lambda: {str(r.date): r["count"] for r in tables.read_table(spark, str(out)).groupBy("date").count().collect()}
    assert count() == {days[0]: 20, days[1]: 5}
    # a day that has no rows any more is empty
    tables.write_days(made(spark, []), str(out), "t", kind=kind, days=days[:1])
    assert count() == {days[1]: 5}


def test_the_schema_beside_a_table(spark, tmp_path):
    out = str(tmp_path / "out")
    tables.write_days(made(spark, ["2022-06-06"]), out, "t")
    tables.write_days(made(spark, ["2022-06-13"], more=[("velocity", 3.0)]), out, "t")
    found = tables.read_table(spark, out)
    assert found.columns == ["t", "src_order", "velocity", "date"]
    assert {(str(r.date), r.velocity) for r in found.collect()} == {("2022-06-06", None), ("2022-06-13", 3.0)}
    with pytest.raises(ValueError, match="other types of t"):
        tables.write_days(made(spark, ["2022-06-20"]).withColumn("t", F.col("t").cast("string")), out, "t")
    # to plan, no footer is read: a file that isn't Parquet shows only when rows are read
    for part in (tmp_path / "out" / "date=2022-06-06").glob("part-*"):
        part.write_bytes(b"junk" * 10)
    (tmp_path / "out" / "date=2022-06-06" / ".hidden").write_text("")
    assert tables.read_table(spark, out).columns == found.columns
    assert tables.read_table(spark, out).where("date = '2022-06-13'").count() == 20


def test_a_folder_of_both_formats(spark, tmp_path):
    out = str(tmp_path / "out")
    made(spark, ["2022-06-06"], 3).write.partitionBy("date").parquet(out)
    made(spark, ["2022-06-13"], 4).write.partitionBy("date").mode("append").option("header", True).csv(out)
    found = {str(r.date): r["count"] for r in tables.read_table(spark, out).groupBy("date").count().collect()}
    assert found == {"2022-06-06": 3, "2022-06-13": 4}


def test_states_of_some_days(spark, tmp_path):
    raw, at = tmp_path / "raw", str(tmp_path)
    raw.mkdir()
    (tmp_path / "keys.csv").write_text("icao24\n00000a\n")
    for day in ("06", "13"):
        (raw / f"states_2022-06-{day}-00.csv").write_text("icao24,time\n00000a,2\n00000A,1\nffffff,1\n")
    run = lambda *days: {str(r.date): r.rows for r in pipeline.run_states(spark, str(raw), f"{at}/keys.csv", f"{at}/daily", days=list(days)).collect()}
    assert run() == {"2022-06-06": 2, "2022-06-13": 2}
    before = stamps(tmp_path / "daily")
    (raw / "states_2022-06-13-01.csv").write_text("icao24,time\n00000a,3\n")
    (raw / "states_2022-06-06-01.csv").write_text("icao24,time\n00000a,3\n")
    assert run("2022-06-13") == {"2022-06-06": 2, "2022-06-13": 3}
    assert {p for p in stamps(tmp_path / "daily") if p in before} == {p for p in before if "date=2022-06-06" in p.parts}


def test_a_days_file_is_written_by_its_own_task(spark):
    """No task sorts the rows of several days."""
    wanted = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        rows = derived.by_day(derived.states(spark, "/root/testdata/sf0.001"))
        days = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("date").alias("n")).collect()
        assert len(days) == 4 and {r.n for r in days} == {1}
        got = [(r.date, r.src_order) for r in rows.select("date", "src_order").collect()]
        of_day = {d: [k for x, k in got if x == d] for d, _ in got}
        assert all(ks == sorted(ks) for ks in of_day.values())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_day_of_many_rows_is_written_in_parts(spark, monkeypatch):
    """No task has a whole day; rows keep their order over the parts, and the queries their results."""
    sf = "/root/testdata/sf0.001"
    results = lambda: [sorted(map(repr, QUERIES[q](spark, sf).collect())) for q in ("file_order_first", "file_inventory")]
    whole = results()
    monkeypatch.setattr(derived, "ROWS_A_FILE", 50, raising=False)
    found = files.discover_states(spark, derived.state_files(spark, sf))
    paths = [f.path for f in found]
    lines = spark.read.text(paths).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(lines) == len(found) > 12 and max(r["count"] for r in lines) <= 1 + 2 * 50
    rows = tables.with_date(tables.read_csv(spark, paths, numbers=()))
    nth = F.coalesce(*[F.when(F.expr(chosen), k) for k, (*_, chosen) in enumerate(derived.LAYOUTS)])
    want = derived.states(spark, sf).select("date", nth.alias("nth"), "src_order").orderBy("date", "nth", "src_order").collect()
    assert in_order(rows.select("date", F.col("report").cast("long"), "src_order")) == [(r.date, r.src_order) for r in want]
    assert results() == whole
