"""Words of many texts at once, as positions and hashes in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of texts that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 512 << 10
#: A longer text is worked on in parts of so many bytes, so that arrays don't grow with it.
LONG_BYTES = 1 << 20
#: Hashes of longer words are taken from their bytes alone and not from running sums, for which equal sums can be made up.
LONG_WORD = 64

#: The six bytes of white space that part words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_BYTES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a one-to-one mapping)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: For each base, its powers and those of its inverse; they grow with the longest part of a text, or chunk of texts.
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        up, down = np.full(n + n // 4, base, np.uint64), np.full(n + n // 4, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[base] = (np.cumprod(up), np.cumprod(down))
    return _POWERS[base][0][:n], _POWERS[base][1][:n]


def _ranges(values: np.ndarray, base: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Polynomial hash of each range of ``values``, from running sums."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts])


class Texts:
    """Some texts: their bytes, where each begins, and their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        self.inside = inside = ~space[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cut = offsets[(offsets > 0) & (offsets < len(data))]
        before[cut] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[cut - 1] = False
        self.stops = np.flatnonzero(inside & ~after) + 1
        #: Of text k, words first[k] to first[k + 1].
        self.first = np.searchsorted(self.starts, offsets)

    def _hashed(self, stops: np.ndarray) -> np.ndarray:
        long = np.flatnonzero(stops - self.starts > LONG_WORD)
        if not len(long):
            return _ranges(_BYTES[self.data], _BYTE_BASE, self.starts, stops)
        kept, before = np.ones(len(self.data), bool), np.zeros(len(stops) + 1, np.int64)
        for k in long:  # one byte stands for such a word in the sums
            kept[self.starts[k] + 1 : stops[k]] = False
        before[long + 1] = (stops - self.starts)[long] - 1
        before = np.cumsum(before)
        out = _ranges(_BYTES[self.data[kept]], _BYTE_BASE, self.starts - before[:-1], stops - before[1:])
        for k in long:
            out[k] = xxhash.xxh3_64_intdigest(self.data[self.starts[k] : stops[k]])
        return out

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return self._hashed(self.stops)

    def prefix_hashes(self, n_bytes: int) -> np.ndarray:
        """A hash of each word's first ``n_bytes`` bytes, or of all of a shorter one."""
        return self._hashed(np.minimum(self.stops, self.starts + n_bytes))

    def whole(self, n: int) -> np.ndarray:
        """For each word, whether it and the ``n - 1`` after it are in one text."""
        return np.arange(len(self.starts)) + n <= np.repeat(self.first[1:], np.diff(self.first))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The words with one space after each, and where each begins, and at last the end."""
        at = np.concatenate([[0], np.cumsum(self.stops - self.starts + 1)])
        out, mask = np.full(at[-1], 32, np.uint8), np.ones(at[-1], bool)
        mask[at[1:] - 1] = False
        out[mask] = self.data[self.inside]
        return out, at

    def text_of_words(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def sums(self, wanted: np.ndarray) -> np.ndarray:
        """For each text, how many of its bytes are ``wanted`` (a table of 256 truth values)."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(wanted[self.data], out=total[1:])
        return np.diff(total[self.offsets])


class LongText:
    """A text that is read in parts of whole words."""

    def __init__(self, data: np.ndarray, space: np.ndarray = SPACE):
        self.data, self.space = data, space

    def parts(self, overlap: int, size: int | None = None) -> Iterator[tuple[int, int, Texts]]:
        """Number of the first word of each part, how many words are its own, and its words, ``overlap`` of the next part's included."""
        least, data = size or LONG_BYTES, self.data
        at, word, size = 0, 0, least
        while at < len(data):
            end = min(at + size, len(data))
            while end < len(data) and not (cut := self.space[data[end : end + 65536]]).any():
                end = min(end + 65536, len(data))
            if end < len(data):
                end += int(cut.argmax())
            found = Texts(data[at:end], np.array([0, end - at]), self.space)
            own = len(found.starts) - (overlap if end < len(data) else 0)
            if own <= 0 and end < len(data):  # a few words fill the part
                size *= 2
                continue
            yield word, own, found
            if end >= len(data):
                return
            at, word, size = at + int(found.starts[own]) if overlap else end, word + own, least


def parts_of(data: bytes, overlap: int = 0) -> Iterator[tuple[int, int, Texts]]:
    """As ``LongText.parts``; a text that isn't long is one part."""
    array = np.frombuffer(data, np.uint8)
    if len(array) > LONG_BYTES:
        yield from LongText(array).parts(overlap)
    else:
        found = Texts(array, np.array([0, len(array)]))
        yield 0, len(found.starts), found


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each word on, and whether those lie in one text."""
    whole = np.zeros(len(hashes), bool)
    if len(hashes) < n:
        return np.zeros(len(hashes), np.uint64), whole
    starts = np.arange(len(hashes) - n + 1)
    out = np.zeros(len(hashes), np.uint64)
    out[: len(starts)] = _ranges(hashes, _WORD_BASE, starts, starts + n)
    ends = np.repeat(first[1:], np.diff(first))
    whole[: len(starts)] = starts + n <= ends[: len(starts)]
    return out, whole


def texts(
    column: pa.Array, chunk_bytes: int = CHUNK_BYTES, space: np.ndarray = SPACE, letters: np.ndarray | None = None
) -> Iterator[tuple[int, int, Texts | LongText]]:
    """Rows a to b of a binary column, so many at once as fit a chunk, or one long text; null counts as empty.

    ``space`` has what parts words, ``letters`` the byte that each byte is read as.
    """
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32 if column.type == pa.binary() else np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk_bytes, "right")) - 1)
        b = min(b, len(column))
        part = data[offsets[a] : offsets[b]]
        part = part if letters is None else letters[part]
        if len(part) > max(LONG_BYTES, chunk_bytes):
            yield a, b, LongText(part, space)
        else:
            yield a, b, Texts(part, (offsets[a : b + 1] - offsets[a]).astype(np.int64), space)
        a = b
