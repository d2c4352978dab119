"""Byte-pair encoding by a queue of merge ranks over a linked list of symbols, and decoding."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import PART_CHARS, Recent, at_spaces, read_table, set_off_stops

VOCABULARY = "word_bpe_49k.json"
#: Encoded chunks of one generation that a worker remembers.
_REMEMBERED = 200_000
#: Bytes of texts whose results are held before they go back to Spark.
_BATCH_BYTES = 8 << 20
#: Characters that ``str.split`` takes for white space and the vocabulary's own pattern does not.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


@lru_cache(maxsize=1)
def _classes() -> dict[str, str]:
    r"""Ranges of letters and numbers for ``\p{L}`` and ``\p{N}``, of the characters that ``unicodedata`` knows.

    The ``regex`` module may know a later Unicode, whose new letters the library takes for others. Code points that
    Python does not know as characters are no letters here.
    """
    kinds = "".join(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1))
    return {rf"\p{{{k}}}": "".join(f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in re.finditer(f"{k}+", kinds)) for k in "LN"}


# How a vocabulary of lower-case word pieces normalises and splits.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def word_pieces(spec: dict) -> bool:
    """Whether a tokenizer file is of the kind that is encoded here: NFC, lower case, pieces that end with white space at the latest."""
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    model = spec["model"]
    return (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and split[0].get("pattern") == {"Regex": _SPLIT}
        and [x.get("type") for x in split] == ["Split", "ByteLevel"]
        and not split[1]["add_prefix_space"]
        and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
        and not (model["dropout"] or model["unk_token"] or model["continuing_subword_prefix"] or model["byte_fallback"] or model["ignore_merges"])
        and not spec.get("post_processor")
        and not spec.get("decoder")
    )


class Vocabulary:
    """A vocabulary file: normalisation, splitting, merges and strings of ids. Files of another kind are an error."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not word_pieces(spec):
            raise ValueError(f"{path} doesn't normalise and split as is done here")
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [s for _, s in sorted((i, s) for s, i in (self.ids | self.special).items())]
        self.end = model["end_of_word_suffix"] or ""
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + self.end] for s in symbols]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"|\p{N}|", r"|[\p{N}]|")
        for name, ranges in _classes().items():
            pattern = pattern.replace(name, ranges)
        self.pieces = regex.compile(pattern).findall
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.encoded: Recent = Recent(_REMEMBERED)

    def merge(self, symbols: list[int]) -> list[int]:
        """Join adjacent symbols by ascending rank, leftmost first, until no pair has a rank.

        The queue holds a pair once for each time it came up; an entry whose two
        symbols no longer stand there is skipped.
        """
        n, pairs = len(symbols), self.pairs
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(*pairs[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
        heapify(queue)
        while queue:
            _, joined, i, a, b = heappop(queue)
            j = following[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = joined, -1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                if found := pairs.get((joined, symbols[k])):
                    heappush(queue, (*found, i, joined, symbols[k]))
            h = before[i]
            if h >= 0 and (found := pairs.get((symbols[h], joined))):
                heappush(queue, (*found, h, symbols[h], joined))
        return [s for s in symbols if s >= 0]

    def _chunk(self, chunk: str) -> bytes:
        """Ids as little-endian 32-bit integers of a text without white space; letters alone are one piece."""
        out: list[int] = []
        for piece in (chunk,) if chunk.isalpha() else self.pieces(chunk):
            raw = piece.encode("utf-8", "surrogatepass")
            out += self.merge([*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]])
        return array("i", out).tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # the library lower-cases letter by letter
        text = text.lower()
        if _ODD_SPACE.search(text):
            return self._chunk(text)
        chunks = set_off_stops(text).split()
        new, known = self.encoded.missing(set(chunks)), self.encoded.young
        for chunk in new:
            known[chunk] = self._chunk(chunk)
        return b"".join(map(known.__getitem__, chunks))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if len(text) > PART_CHARS:
            return b"".join(map(self._part, at_spaces(text)))
        return self._part(text)

    def _part(self, text: str) -> bytes:
        if "<|" not in text:
            return self._plain(text)
        parts = filter(None, self.specials.split(text))
        return b"".join(array("i", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in parts)

    def decode(self, ids: Iterable[int]) -> str:
        """The strings of ids, joined as the library does for a vocabulary without a decoder: by one space."""
        return " ".join(map(self.strings.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def bpe_encode_decode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, ids, decoded`` for each row: token ids of the whole text and the text they decode to.

    Null and empty texts have no ids and decode to an empty text. Repeated rows come out
    as often as they go in; null ids stay null; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)

        def batch_of(keys: pa.Array, ids: list[bytes], decoded: list[str]) -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            return pa.RecordBatch.from_arrays([keys, lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

        for batch in batches:
            done, held, ids, decoded = 0, 0, [], []
            for k, value in enumerate(batch.column(1)):
                ids.append(known.encode(value.as_py() or ""))
                decoded.append(known.decode(memoryview(ids[-1]).cast("i")))
                held += len(ids[-1]) + len(decoded[-1])
                if held >= _BATCH_BYTES:
                    yield batch_of(batch.column(0).slice(done, k + 1 - done), ids, decoded)
                    done, held, ids, decoded = k + 1, 0, [], []
            if ids:
                yield batch_of(batch.column(0).slice(done), ids, decoded)

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
