"""What the operators share: reading tables and writing intermediate ones."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in every contract of this subpackage. ``bytes.split()`` splits on the same six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Only a session of one machine (master ``local``) may lack it; then a temporary folder
    is set. On a cluster no folder of one machine would do, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Within, Python workers get so many rows at once: rows with texts are wide, and both sides hold a batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def new_path(spark: SparkSession, label: str) -> str:
    """A path for an intermediate table, in a folder of the application."""
    return f"{shared_dir(spark)}/driftline/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-{label}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    This cuts the lineage, so that later steps neither repeat the work before it nor
    lose it with an executor, and it fixes what is not a pure function of the rows
    (such as ``monotonically_increasing_id``). The reread table also has a known size,
    by which Spark can choose or avoid a broadcast.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system it is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote, once all that was computed from it is written itself."""
    for table in tables:
        delete_path(table.sparkSession, table.written_to)


def discard_all(spark: SparkSession) -> None:
    """Delete all intermediate tables of the application; the results of its queries can't be read after that."""
    delete_path(spark, f"{shared_dir(spark)}/driftline/{spark.sparkContext.applicationId}")


def free_name(columns: list[str], stem: str) -> str:
    """``stem``, or that with lines after it, so that no column has the name."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def ascii_lower(column):
    """Lower-case A-Z only; other letters stay.

    Texts of ASCII alone take the fast path of ``lower``.
    """
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(
        F.translate(column, ASCII_UPPER, ASCII_LOWER)
    )


#: A full stop or comma after an ASCII letter, before white space or the end. A pattern that begins with the character itself is searched for fast.
_STOPS = [(re.compile(rf"{c}(?<=[A-Za-z]{c})(?=\s|\Z)", re.ASCII), f" {c[-1]}") for c in (r"\.", ",")]


def set_off_stops(text: str) -> str:
    """Put a space before full stops and commas that end a word, so that fewer different chunks are left.

    For tokenizers that part letters from punctuation and drop white space, it is the same text.
    """
    for stop, apart in _STOPS:
        text = stop.sub(apart, text)
    return text


_SPACE = re.compile("[ \t\n\r]")
#: Characters of a text that is worked on at once where parts between white space are independent.
PART_CHARS = 1 << 20


def at_spaces(text: str, size: int | None = None) -> Iterator[str]:
    """A text in parts of about ``size`` characters or little more, cut before white space."""
    at, size = 0, size or PART_CHARS
    while len(text) - at > size and (found := _SPACE.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class Recent:
    """Results by key, of those asked for lately: two generations of at most ``most`` keys and those of one call.

    When the young generation is full it becomes the old one; what is asked for again is
    young again, and what is not goes with the old one. So memory is bounded, and keys
    that come often stay. ``young`` is a plain dictionary, which sets compare with fast.
    """

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that have to be computed and put into ``young``; the others are there until the next call."""
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        new = keys.difference(self.young)
        known = {k for k in new if k in self.old}  # intersection() would go through all of a dictionary
        self.young.update((k, self.old[k]) for k in known)
        return list(new - known)
