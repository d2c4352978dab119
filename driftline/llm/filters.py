"""Bitmaps of hashed values, by which rows that cannot take part in a join stay out of its shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 16 MB, whatever the size of the corpus.
FILTER_BITS = 1 << 27


def place_of(column: str, bits: int) -> Column:
    """1 to ``bits``; of bucket k are 32,768 * (k - 1) + 1 to 32,768 * k."""
    return (F.pmod(F.xxhash64(column), F.lit(bits)) + 1).alias("place")


def bitmap_of(rows: DataFrame, column: str) -> tuple[int, dict[int, bytes]]:
    """A bit for the hash of each value; the number of bits follows the rows, up to ``FILTER_BITS``."""
    n, bits = rows.select(F.approx_count_distinct(column)).first()[0], 1 << 20
    while bits < FILTER_BITS and bits < 12 * n:
        bits *= 2
    made = rows.select(place_of(column, bits)).groupBy(F.expr("bitmap_bucket_number(place)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bitmap"))
    return bits, {r.k: bytes(r.bitmap) for r in made.collect()}  # bits / 32768 rows of 4 KB at most


def membership(shared, bits: int):
    """Whether the filter has each row of a batch, whose last column is the ``place``."""
    empty = bytes(4096)
    table = np.concatenate([np.frombuffer(shared.value.get(k + 1, empty), np.uint8) for k in range(bits >> 15)])

    def run(batch: pa.RecordBatch) -> np.ndarray:
        bit = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False) - 1
        return (table[bit >> 3] >> (bit & 7)) & 1 == 1

    return run


def passing(rows: DataFrame, column: str, found: tuple[int, dict[int, bytes]], pack: str | None = None) -> DataFrame:
    """The rows whose ``column`` the filter has, and few others; the binary column ``pack``, if any, compressed."""
    bits, bitmaps = found
    shared = rows.sparkSession.sparkContext.broadcast(bitmaps)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has, compress = membership(shared, bits), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            kept = batch.filter(pa.array(has(batch)))
            columns = kept.columns[:-1]
            if pack:
                k = names.index(pack)
                columns[k] = pa.array([compress(x.as_py() or b"") for x in columns[k]], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("*", place_of(column, bits)).mapInArrow(run, ", ".join(f"{n} {kind}" for n, kind in rows.dtypes))
