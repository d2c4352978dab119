"""Readers of CSV and Parquet tables and what they guarantee."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.functions.text import missing_to_null, nan_to_null
from driftline.sources.files import File, are_parquet, exists, headers, in_order, list_files

#: Columns that are texts even where every value looks like a number.
TEXTS = frozenset("icao24 callsign onground segment_id trajectory_id source_segment_id date manufacturername model icaoaircrafttype".split())
_DATE = r"(\d{4}-\d{2}-\d{2})"


#: ``src_order`` has a file's rank above so many bits of a row's position in it: files of up to 8 TB, 2^20 of them.
_POSITION_BITS = 43
#: Up to so many file names are sent to all tasks, some 20 MB.
_BROADCAST_FILES = 100_000


def _by_place(rows: DataFrame, ranks: dict[File, int]) -> DataFrame:
    """``src_file`` and ``src_order``, unless they are there, in place of ``_path``, ``_block`` and ``_row``: the file's rank, and in it the position.

    A position is the start of the block plus the number of the row in its task. A row has a
    byte at least, and a block that isn't a file's last is all that its task reads, so a
    position is below the start of the next block, however the file was split.
    """
    table = rows.sparkSession.createDataFrame([(f.uri, k, f.name) for f, k in ranks.items()], "_of string, _rank long, _name string")
    table = F.broadcast(table) if len(ranks) <= _BROADCAST_FILES else table
    placed = rows.join(table, F.regexp_replace("_path", "^file:/+", "file:/") == F.col("_of"), "left")
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("not listed: "), F.col("_path"))).cast("long"))
    given = {"src_file": F.col("_name"), "src_order": F.shiftleft(rank, _POSITION_BITS) + F.col("_block") + F.col("_row")}
    return placed.withColumns({n: c for n, c in given.items() if n not in rows.columns}).drop("_path", "_block", "_row", "_of", "_rank", "_name")


def read_csv(spark: SparkSession, paths: list[str] | str, numbers: tuple[str, ...] | None = None) -> DataFrame:
    """CSV files with headers as one table: nothing is inferred, so leading zeros stay.

    Columns go by their names in each file's own header, which may differ; a file that
    lacks a column has nulls there. Files without a line have no rows. Columns of
    ``numbers`` become doubles (of None, all that aren't ``TEXTS``); words for missing
    values and NaN become null. ``src_file`` is the file's name, and ``src_order`` rises from
    row to row in a file and from file to file by name, whatever their sizes, headers
    and splits; where a step before has written them, they stay.
    """
    found = in_order(list_files(spark, paths))
    named, groups = headers(spark, found), {}
    for k, file in enumerate(found):
        if names := named[file.path]:
            groups.setdefault(names, {})[file] = k
    if not groups:
        raise ValueError(f"no file with a header in {paths}")
    reader, tables = spark.read.option("header", True), []
    if isinstance(paths, str) and not any(c in paths for c in "*?[{") and not paths.endswith((".csv", ".gz")):
        reader = reader.option("basePath", paths)  # folders such as date=2022-06-06 are columns
    for names, ranks in groups.items():
        rows = reader.schema(", ".join(f"`{n}` STRING" for n in names)).csv([f.path for f in ranks])
        if {"src_file", "src_order"} <= set(names):
            tables.append(rows)
            continue
        nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        at = (F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), nth.alias("_row"))
        tables.append(_by_place(rows.select("*", *at), ranks))
    raw, columns = union_all(tables), []
    for name, kind in raw.dtypes:
        if name == "src_order":
            columns.append(F.col(name).try_cast("long").alias(name))
            continue
        if name == "src_file" or kind != "string":
            columns.append(F.col(f"`{name}`"))
            continue
        value = missing_to_null(F.col(f"`{name}`"))
        number = name in numbers if numbers is not None else name not in TEXTS
        columns.append((nan_to_null(value.try_cast("double")) if number else value).alias(name))
    return raw.select(*columns)


def read_parquet(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """A Parquet table, or those of its files, with NaN as null, columns by name.

    The schema is the one that ``write_days`` left beside it, so that planning opens no file;
    of other tables it is merged from all files' footers.
    """
    reader, known = spark.read, kept_schema(spark, path)
    reader = reader.schema(known) if known else reader.option("mergeSchema", True)
    raw = reader.option("basePath", path).parquet(*files) if files else reader.parquet(path)
    return raw.select(*[nan_to_null(F.col(n)).alias(n) if kind in ("double", "float") else F.col(n) for n, kind in raw.dtypes])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by what each file holds, both if a folder has both."""
    if kept_schema(spark, path):
        return read_parquet(spark, path)
    found = [f for f in list_files(spark, path) if f.size]
    if not found:
        raise ValueError(f"no file with bytes in {path}")
    kinds = are_parquet(spark, found)
    parquet, csv = ([f.path for f, is_it in zip(found, kinds) if is_it is wanted] for wanted in (True, False))
    if not csv:
        return read_parquet(spark, path)
    if not parquet:
        return read_csv(spark, path)
    of_csv = read_csv(spark, csv)
    if with_days := any("/date=" in f for f in csv):
        day = F.to_date(F.regexp_extract(F.input_file_name(), r"/date=(\d{4}-\d{2}-\d{2})/", 1))
        of_csv = of_csv.withColumn("date", day)
    of_parquet = read_parquet(spark, path, parquet)
    return union_all([of_parquet.withColumn("date", F.col("date").cast("date")) if with_days else of_parquet, of_csv])


def require(columns: list[str], *wanted: str, one_of: tuple[str, ...] = ()) -> None:
    """Raise ``ValueError`` for missing columns; of ``one_of`` at least one has to be there."""
    missing = [c for c in wanted if c not in columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if one_of and not set(one_of) & set(columns):
        raise ValueError(f"needs one of the columns {', '.join(one_of)}")


def timestamp_column(columns: list[str], first: str = "lastposupdate", second: str = "time") -> str:
    require(columns, one_of=(first, second))
    return first if first in columns else second


def with_date(rows: DataFrame) -> DataFrame:
    """``date`` from the name of each row's file; rows of files without a date go."""
    return rows.withColumn("date", F.to_date(F.nullif(F.regexp_extract("src_file", _DATE, 1), F.lit("")))).where("date IS NOT NULL")


def union_all(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables, columns by name, null where a table lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


_SCHEMA = "_columns"


def kept_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema beside a table's files, if ``write_days`` wrote it."""
    if any(c in path for c in "*?[{") or not exists(spark, f"{path.rstrip('/')}/{_SCHEMA}"):
        return None
    return StructType.fromJson(json.loads(spark.read.text(f"{path.rstrip('/')}/{_SCHEMA}").first().value))


def _keep_schema(rows: DataFrame, path: str) -> None:
    """Leave the schema of ``rows`` beside the files, with the columns that days written before have besides; raise if a column has another type there."""
    spark, schema = rows.sparkSession, StructType([f for f in rows.schema if f.name != "date"] + [f for f in rows.schema if f.name == "date"])
    before = kept_schema(spark, path)
    if before:
        now = {f.name: f.dataType for f in schema}
        if differ := [f.name for f in before if f.name in now and f.dataType != now[f.name]]:
            raise ValueError(f"{path} has other types of {', '.join(differ)}")
        more = [f for f in before if f.name not in now]
        if not more and len(before) == len(now):
            return
        schema = StructType([*schema[:-1], *more, schema[-1]])
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{_SCHEMA}")


def write_days(rows: DataFrame, path: str, *order: str | Column, kind: str = "parquet", days: list | None = None, whole: bool = False) -> None:
    """One folder a day, rows sorted in files; folders of days that ``rows`` hasn't stay as they are.

    Days go to few files of even size, and a large day to several. With ``whole`` a day's
    files, in the order of their names, are in order as a whole, at the price of reading
    the rows twice, once to part them. Of ``days`` those without rows get a folder with a
    file without rows, in place of what was there. ``rows`` may not come from ``path``.
    """
    at, spark = path.rstrip("/"), rows.sparkSession
    dealt = rows.repartitionByRange("date", *order) if whole else rows.hint("rebalance", "date")
    if kind == "parquet":
        _keep_schema(rows, at)
    counted = Observation()
    names = {str(d): f"d{k}" for k, d in enumerate(days or [])}
    if names:  # the days that have rows are told by the writing itself
        dealt = dealt.observe(counted, *[F.count_if(F.col("date").cast("string") == d).alias(n) for d, n in names.items()])
    writer = dealt.sortWithinPartitions("date", *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")
    (writer.option("header", True).csv if kind == "csv" else writer.parquet)(at)
    found = counted.get if names else {}
    empty_days = sorted(d for d, n in names.items() if not found.get(n))
    if empty_days:
        none = spark.createDataFrame([], rows.drop("date").schema).coalesce(1)
        for day in empty_days:
            empty = none.write.mode("overwrite")
            (empty.option("header", True).csv if kind == "csv" else empty.parquet)(f"{at}/date={day}")
