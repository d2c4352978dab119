"""Compression of vectors to codes: a codebook for each part, searched through a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import discard, materialise, read_table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Components are whole numbers of so many to the unit.
SCALE = 256
#: Bits of a coordinate's cell.
CELL_BITS = 3
#: Whole components from here on could overflow the sums of squares.
LARGEST = 1 << 28
#: Vectors that a task compares with the codebooks at once.
_ROWS = 2048


def usable_vectors(table: DataFrame, vector: str = "embedding", parts: int = PARTS) -> DataFrame:
    """The rows whose vector is there, has only finite components, and is as long as most are.

    The length is that of most usable rows (the longer of equals), among the multiples of
    ``parts``.
    """
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.where(v.isNotNull() & finite)
    sizes = rows.groupBy(F.size(v).alias("size")).agg(F.count(F.lit(1)).alias("n")).where(f"size > 0 AND size % {parts} = 0")
    most = sizes.agg(F.max(F.struct("n", "size")).alias("x")).first().x
    return rows.where(F.size(v) == (most.size if most else 0))


def whole_numbers(column: pa.ListArray, scale: int = SCALE) -> np.ndarray:
    """Rows of components, scaled and rounded down."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.floor(flat * scale)
    if len(found) and np.abs(found).max() >= LARGEST:
        raise ArithmeticError(f"a component is beyond {LARGEST // scale}")
    return found.astype(np.int64).reshape(len(column), -1)


@dataclass(frozen=True)
class ApproximationFile:
    """The entries of one codebook with each coordinate quantised to a cell of few bits.

    ``cells`` has for each entry and coordinate the number of its cell, ``low`` and
    ``high`` for each coordinate and cell the least and greatest entry in it.
    """

    entries: np.ndarray
    cells: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray, bits: int = CELL_BITS) -> ApproximationFile:
        n, size = entries.shape
        many = 1 << bits
        cells = np.zeros((n, size), np.int64)
        low, high = np.zeros((size, many), np.int64), np.zeros((size, many), np.int64)
        for k in range(size):  # cells of about equally many entries; equal coordinates share one
            ordered = np.sort(entries[:, k])
            bounds = np.unique(ordered[np.arange(1, many) * n // many])
            cells[:, k] = np.searchsorted(bounds, entries[:, k], "right")
            for c in np.unique(cells[:, k]):
                inside = entries[cells[:, k] == c, k]
                low[k, c], high[k, c] = inside.min(), inside.max()
        return cls(entries, cells, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each query the entry of least squared distance, the lower of equals, that distance; and how many entries were refined.

        For a query, two small tables by coordinate and cell bound its distance to any
        coordinate in the cell; summed along an entry's cells they bound the distance to
        the entry. Only entries whose lower bound isn't above the least upper bound are
        compared exactly, in whole numbers.
        """
        below, above = self.low[None] - queries[:, :, None], queries[:, :, None] - self.high[None]
        nearest = np.square(np.maximum(np.maximum(below, above), 0))
        farthest = np.square(np.maximum(np.abs(below), np.abs(above)))
        lower, upper = np.zeros((len(queries), len(self.entries)), np.int64), np.zeros((len(queries), len(self.entries)), np.int64)
        for k in range(queries.shape[1]):
            lower += nearest[:, k, self.cells[:, k]]
            upper += farthest[:, k, self.cells[:, k]]
        row, entry = np.nonzero(lower <= upper.min(axis=1, keepdims=True))
        distance = np.square(queries[row] - self.entries[entry]).sum(axis=1)
        # candidates stand by row, and in a row by entry: the first of the least is taken
        begins = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(distance, begins) if len(begins) else distance
        hit = np.flatnonzero(distance == np.repeat(least, np.diff(np.append(begins, len(row)))))
        first = hit[np.diff(row[hit], prepend=-1) > 0]
        return entry[first], distance[first], len(row)


class Codebooks:
    """For each part of a vector its entries, as an array by part, entry and position."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS):
        self.entries = entries
        self.files = [ApproximationFile.of(x, bits) for x in entries]

    def digest(self) -> str:
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part of each vector."""
        shaped = vectors.reshape(len(vectors), len(self.files), -1)
        found = [f.nearest(shaped[:, p]) for p, f in enumerate(self.files)]
        return np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)

    def moved(self, totals: dict[tuple[int, int, int], tuple[int, int]]) -> Codebooks:
        """Each entry at the floored mean of its parts; ``totals`` has sum and count by part, entry and position. Unused entries stay."""
        entries = self.entries.copy()
        for (part, entry, at), (total, n) in totals.items():
            entries[part, entry, at] = total // n
        return Codebooks(entries)


def _vectors(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, _ROWS):
            part = batch.slice(k, _ROWS)
            yield part, whole_numbers(part.column(column))


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors of the least ids; equal ids by their vectors, rows without an id after all others."""
    order = (F.col("vec_id").asc_nulls_last(), "vector")
    found = rows.orderBy(*order).limit(entries).toArrow()  # ``entries`` rows, each task sends so many at most
    if not found.num_rows:
        return None
    vectors = np.concatenate([whole_numbers(c) for c in found.column("vector").chunks])
    return Codebooks(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2).copy())


def part_totals(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``part, entry, at, total, n``: sums and counts by nearest entry, added up in each task first."""
    shape = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for _, vectors in _vectors(batches, 0):
            codes, _ = books.assign(vectors)
            shaped = vectors.reshape(len(vectors), shape[0], -1)
            for p in range(shape[0]):
                np.add.at(totals[p], codes[:, p], shaped[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=shape[1])
        part, entry, at = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, shape))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, entry, at, totals[part, entry, at], counts[part, entry])], names=["part", "entry", "at", "total", "n"])

    sums = rows.select("vector").mapInArrow(run, "part long, entry long, at long, total long, n long")
    return sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def train_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks over ``vec_id, vector``: from the first vectors on, so many rounds of assignment and mean over all rows.

    The driver holds the codebooks alone, whose size is ``entries`` vectors.
    """
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books else 0):
        found = part_totals(rows, books).collect()  # a row for each coordinate of a used entry
        books = books.moved({(r.part, r.entry, r["at"]): (r.total, r.n) for r in found})
    return books


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` for each row: an entry of each part, as two hex digits, and the squared distances in all."""
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, vectors in _vectors(batches, 2):
            codes, distances = books.assign(vectors)
            text = [bytes(c).hex() for c in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text), pa.array(distances.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "vector").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress_vectors(
    table: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each usable row.

    Rows are read in the precision they have; components become ``floor(256 * x)``. A null
    vector, a null or non-finite component, or a length that isn't that of most rows drops
    the row. Rows without an id are encoded and are never among the first; repeated rows
    come out as often as they go in, and equal distances go to the lower entry. With
    fewer rows than ``entries`` there are as many entries; an empty table gives no rows.
    Errors of a label add up before they are shuffled, and null labels are one. Other
    columns are not read. A component of over a million (2^28 / 256) raises
    ``ArithmeticError``, as sums of squares would overflow. At most 256 entries fit a code.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits for an entry")
    spark = table.sparkSession
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    rows = materialise(usable_vectors(rows, "vector", parts), "vectors")
    books = train_codebooks(rows, parts, entries, rounds)
    if books is None:
        kinds = dict(rows.dtypes)
        return spark.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    found = materialise(encoded(rows, books), "codes")
    discard(rows)
    by_label = found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = found.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(read_table(spark, sf_dir, "embeddings"))


def _round_sql(k: int, last: bool = False) -> str:
    """SQL for assignment to the entries ``book{k}``, and from it the next entries."""
    assigned = f"""near{k} AS (
  SELECT n, p, e, d FROM (
    SELECT n, p, e, d, row_number() OVER (PARTITION BY n, p ORDER BY d, e) AS r FROM (
      SELECT x.n, x.p, b.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) AS d FROM cut x JOIN book{k} b ON x.p = b.p)
  ) WHERE r = 1
)"""
    if last:
        return assigned
    return f"""{assigned}, moved{k} AS (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT x.p, near{k}.e, i, CAST(floor(CAST(sum(x.v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM near{k} JOIN cut x ON near{k}.n = x.n AND near{k}.p = x.p, size, range(1, width + 1) r(i) GROUP BY x.p, near{k}.e, i
  ) GROUP BY p, e
), book{k + 1} AS (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN moved{k} m ON b.p = m.p AND b.e = m.e
)"""


OP11_SQL = f"""
WITH usable AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS n, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0
), size AS (
  SELECT max(len(v)) // {PARTS} AS width FROM usable
), cut AS (
  SELECT n, p, v[p * width + 1:(p + 1) * width] AS v FROM usable, size, range({PARTS}) r(p)
), book0 AS (
  SELECT p, n - 1 AS e, v FROM cut WHERE n <= {ENTRIES}
), {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2, last=True)}, codes AS (
  SELECT n, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY n
), books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
), labels AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM usable JOIN codes USING (n) GROUP BY label
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM usable JOIN codes USING (n) JOIN labels ON usable.label IS NOT DISTINCT FROM labels.label, books
"""
