"""Token ids as Parquet lists in document order, for selective reading of ids and of their figures."""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftline.llm.bpe import byte_symbols, word_pieces
from driftline.llm.common import PART_CHARS, Recent, at_spaces, new_path, read_table, set_off_stops

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Rows that are encoded at once.
_ROWS = 256
#: Chunks of one generation that a worker remembers.
REMEMBERED = 500_000
#: Texts with one of these go to the library whole; each is looked for by itself, which is faster than a class of characters.
_ODD = ("<|", *"\x1c\x1d\x1e\x1f\u03a3")
#: ASCII letters and then other signs, which are two pieces; an apostrophe may stand inside a piece.
_WITH_SIGNS = re.compile(r"([a-z]+)([!-&(-/:-@\[-`{-~]+)")
#: A row group holds about so many bytes; a reader of a few documents touches few of them.
ROW_GROUP_BYTES = 16 << 20
#: Pages are small, so that the page index leads to the pages that hold the wanted rows.
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1024


class Encoder:
    """The library, asked once for each chunk between white space and not again while it is remembered.

    No token of a vocabulary with ``word_pieces`` reaches over white space, nor does its
    normalisation, so the ids of a text are those of its chunks in order. A text that may
    hold a special token, or a control character that only ``str.split`` takes for white
    space, goes to the library whole; with any other vocabulary every text does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.symbols = byte_symbols()
        self.known = Recent(REMEMBERED)
        with open(path, encoding="utf-8") as f:
            self.by_chunks = word_pieces(json.load(f))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("i", x.ids).tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask(self, chunks: list[str]) -> dict[str, bytes]:
        """Chunks of letters alone are one piece, and those of letters before signs two, which the library's merges can take at once."""
        tokens, symbols = self.library.model.tokenize, self.symbols
        out = {}
        for x in chunks:
            if x.isalpha() and x.islower():
                piece = x if x.isascii() else "".join([symbols[b] for b in x.encode()])
                out[x] = array("i", [t.id for t in tokens(piece)]).tobytes()
            elif found := _WITH_SIGNS.fullmatch(x):
                out[x] = array("i", [t.id for piece in found.groups() for t in tokens(piece)]).tobytes()
        rest = [x for x in chunks if x not in out]
        out.update(zip(rest, self._whole(rest)))
        return out

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """The chunks of the normalised text, full stops and commas apart."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return set_off_stops(text.lower()).split()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not self.by_chunks:
            return self._whole(texts)
        return [b"".join(map(self._parts, at_spaces(x))) for x in texts] if any(len(x) > PART_CHARS for x in texts) else self._several(texts)

    def _parts(self, text: str) -> bytes:
        return self._several([text])[0]

    def _several(self, texts: list[str]) -> list[bytes]:
        split = [[x] if any(c in x for c in _ODD) else self._chunks(x) for x in texts]
        new = self.known.missing(set().union(*split))  # this may begin a new generation
        known = self.known.young
        known.update(self._ask(new))
        return [b"".join(map(known.__getitem__, chunks)) for chunks in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str, end_id: int | None = END_ID, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, part, start_in_part, n_tokens, ids`` in ascending ``doc_id`` order.

    The rows of ``part`` k stand before those of part k + 1. ``start_in_part`` counts the
    ids of the rows before in the same part. Rows with one id are ordered by their text,
    so a repeated task gives the same. Null texts count as empty; a null id ranks first;
    an empty table has no rows; a very long text is encoded in parts; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, start, tail = encoder(path), 0, b"" if end_id is None else np.array([end_id], "<i4").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(k, _ROWS)
                ids = [x + tail for x in ask([x or "" for x in rows.column(2).to_pylist()])]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        pa.array(start + ends[:-1]),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<i4"))),
                    ],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return ordered.select("doc_id", F.spark_partition_id().alias("part"), "text").mapInArrow(
        run, f"doc_id {kind}, part int, start_in_part long, n_tokens long, ids array<int>"
    )


def write_store(encoded: DataFrame, path: str) -> None:
    """Write encoded rows as they stand: a file for each part.

    Ids, of which a vocabulary has few, are dictionary encoded; ``doc_id`` and the
    figures, which ascend or vary little, are delta encoded. Statistics and the page
    index are by row group and page, whose sizes are set here.
    """
    writer = encoded.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.writer.version", "PARQUET_2_0")
    for column in ("doc_id", "part", "start_in_part", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.option("compression", "zstd").parquet(path)


def read_store(spark: SparkSession, path: str, columns: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and the asked columns of a store.

    The starts come from the figures alone: one row for each part is summed up and sent
    to the tasks, so the broadcast has as many rows as the store has files. Ids are
    read only where asked for; a filter on ``doc_id`` reaches the page index.
    """
    stored = spark.read.parquet(path)
    ends = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = ends.selectExpr("part", "coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before")
    found = stored.join(F.broadcast(before), "part")
    return found.select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), *columns)


def ids_crc32(store: DataFrame) -> DataFrame:
    """The rows with ``ids_crc32`` in place of ``ids``: over the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            values, ends = np.asarray(lists.values).astype("<u4", copy=False), np.asarray(lists.offsets)
            sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=[*batch.schema.names[:-1], "ids_crc32"])

    others = [c for c in store.columns if c != "ids"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in store.select(*others).schema)
    return store.select(*others, "ids").mapInArrow(run, f"{kinds}, ids_crc32 long")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_store(encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)), path)
    return ids_crc32(read_store(spark, path))
