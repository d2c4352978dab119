"""What files there are and what they hold, asked of whatever file system a path is on."""

from __future__ import annotations

import csv
import os
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


@dataclass(frozen=True)
class File:
    path: str
    size: int
    #: The path as rows name their file: escaped as a URI.
    uri: str = ""

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


def _plain(uri: str) -> str:
    return re.sub("^file:/+", "file:/", uri)


def list_files(spark: SparkSession, paths: str | list[str]) -> list[File]:
    """Files of paths, patterns and folders with all in them, by path; names that begin with a dot or a line are none.

    Spark lists them, many folders at once by a job; no file is opened.
    """
    found = {}
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        sizes = {_plain(r.uri): r.length for r in listed.select("length", F.col("_metadata.file_path").alias("uri")).collect()}  # a row a file
        for uri in map(_plain, listed.inputFiles()):  # the empty ones too
            found[uri] = File(unquote(uri), sizes.get(uri, 0), uri)
    return sorted(found.values(), key=lambda f: f.path)


class _Opener:
    """Opens files by their paths; one file system each scheme and host."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.systems = spark._jvm, spark._jsc.hadoopConfiguration(), {}
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.codecs = self.jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self.conf)

    def __call__(self, path: str):
        at, root = self.path(path), path.split("/", 3)[:3] if "://" in path else path.split("/", 1)[:1]
        system = self.systems.get(tuple(root)) or self.systems.setdefault(tuple(root), at.getFileSystem(self.conf))
        return system.open(at)

    def first_line(self, path: str) -> str | None:
        stream = self(path)
        try:
            codec = None if path.lower().endswith(".csv") else self.codecs.getCodec(self.path(path))
            if codec is None:
                line = stream.readLine()  # each byte as a character
                return None if line is None else line.encode("latin-1").decode("utf-8")
            io = self.jvm.java.io
            return io.BufferedReader(io.InputStreamReader(codec.createInputStream(stream), "UTF-8")).readLine()
        finally:
            stream.close()

    def begins_with(self, path: str, number: int) -> bool:
        stream = self(path)
        try:
            return stream.readInt() == number
        finally:
            stream.close()


def _each(found: list[File], ask, at_once: int = 32) -> list:
    """``ask`` of each file, many at once: it is waiting for the file system, not work."""
    with ThreadPoolExecutor(max(1, min(at_once, len(found)))) as pool:
        return list(pool.map(ask, found))


def are_parquet(spark: SparkSession, found: list[File]) -> list[bool]:
    """For each file whether its first bytes are those of a Parquet file, whatever its name."""
    opener = _Opener(spark)
    return _each(found, lambda f: f.size >= 12 and opener.begins_with(f.path, int.from_bytes(b"PAR1")))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def headers(spark: SparkSession, found: list[File]) -> dict[str, tuple[str, ...] | None]:
    """The column names of each CSV file by its path, None of a file without a line.

    No source of Spark stops after a file's first line, so these few bytes a file are
    asked of the file system itself.
    """
    opener = _Opener(spark)

    def names(file: File) -> tuple[str, ...] | None:
        line = opener.first_line(file.path) if file.size else None
        return tuple(next(csv.reader([line.lstrip("\ufeff")]))) if line else None

    return dict(zip((f.path for f in found), _each(found, names)))


def date_of(name: str) -> str | None:
    """The first date in a name."""
    found = _DATE.search(name)
    return found[0] if found else None


def in_order(found: list[File]) -> list[File]:
    """By name, as rows of an earlier file come first; files of one name by folder."""
    return sorted(found, key=lambda f: (f.name, f.path))


def _may_hold_states(name: str) -> bool:
    """CSV files that are neither registries nor whitelists nor outputs, dated or not."""
    low = name.lower()
    return low.endswith(".csv") and not any(x in low for x in ("aircraftdatabase", "conventionalga", "sorted", "filtered"))


def state_files(names: list[str]) -> list[str]:
    """Of file names, in order, those of raw states: dated CSV files that are neither registries nor whitelists nor outputs."""
    return sorted(n for n in names if _may_hold_states(n) and date_of(n) is not None)


def _state_candidates(spark: SparkSession, path: str, but: str | None) -> list[File]:
    left_out = {f.path for f in list_files(spark, but)} if but else set()
    return [f for f in in_order(list_files(spark, path)) if _may_hold_states(f.name) and f.path not in left_out]


def discover_states(spark: SparkSession, path: str, but: str | None = None) -> list[File]:
    """Raw state files of a folder and those in it, but for the file ``but`` (a whitelist); those without a line count as well, for their day."""
    return [f for f in _state_candidates(spark, path, but) if date_of(f.name)]


STATE_FILES = "path string, name string, size long, date string, columns array<string>, problem string"


def state_file_table(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """What there is to read, a row a file: ``path, name, size, date, columns, problem``, in the order of reading.

    ``problem`` is why a file isn't read (``undated``, ``empty``) or can't be
    (``no icao24``, ``no time``); null of all others.
    """
    found = _state_candidates(spark, path, but)
    dated = [f for f in found if date_of(f.name)]
    columns, rows = headers(spark, dated), []
    for f in found:
        names, problem = columns.get(f.path), None
        if date_of(f.name) is None:
            problem = "undated"
        elif names is None:
            problem = "empty"
        elif "icao24" not in names:
            problem = "no icao24"
        elif not {"time", "lastposupdate"} & set(names):
            problem = "no time"
        rows.append((f.path, f.name, f.size, date_of(f.name), list(names) if names else None, problem))
    return spark.createDataFrame(rows, STATE_FILES)


def default_paths(dt_s: float = 10.0, root: str | None = None) -> dict[str, str]:
    """Where each step reads and writes if no path is given: below ``root``, or $DRIFTLINE_DATA, or ``data``."""
    from driftline.functions.text import spacing_tag

    root = (root or os.environ.get("DRIFTLINE_DATA") or "data").rstrip("/")
    return {
        "registry": f"{root}/raw/aircraftDatabase*.csv",
        "raw": f"{root}/raw",
        "whitelist": f"{root}/whitelist",
        "states": f"{root}/states",
        "segments": f"{root}/segments",
        "out": f"{root}/resampled",
        "trajectories": f"{root}/resampled/{spacing_tag(dt_s)}/trajectories",
        "figures": f"{root}/figures/{spacing_tag(dt_s)}",
    }
