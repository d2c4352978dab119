"""Jaccard join of documents by their n-grams, as a blocked product of the incidence matrix with its transpose."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import discard, materialise, read_table, small_batches
from driftline.llm.components import component_of
from driftline.llm.filters import bitmap_of, passing
from driftline.llm.words import LongText, Texts, mixed, texts, windows

SHINGLE_WORDS = 5
#: Least share of the union that two sets have in common, in hundredths.
PERCENT = 80
#: Column blocks of the incidence matrix in the exact product: ranges of the n-grams' hashes.
COLUMN_BLOCKS = 8
#: N-grams of the rows that are multiplied with one row at once.
ROW_BLOCK = 1 << 16
#: A frequent n-gram is in so many different documents at least; more where the corpus is so large that a filter wouldn't hold them all.
FREQUENT = 16
#: Bits of the two filters of n-grams: those that two documents may have, and the frequent ones. 34 MB, whatever the size of the corpus.
TWICE_BITS, OFTEN_BITS = 28, 24
#: Rows of a column's largest group that what is outside it is multiplied with before any pairs across groups are.
LEADERS = 8
#: Column blocks of a set's parities: 64 to a long.
PARITIES = 512
#: N-grams that a task sorts at once to count them.
_HELD = 1 << 22
#: Digests of sets that a task remembers, to send what copies share once.
REMEMBERED = 100_000
#: Rows that a task turns into Python objects at once.
_ROWS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Seen:
    """Whether a key came before, among the last ``most`` to twice as many."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.young, self.old = most, set(), set()

    def __call__(self, key: bytes) -> bool:
        found = key in self.young or key in self.old
        if len(self.young) >= self.most:
            self.young, self.old = set(), self.young
        self.young.add(key)
        return found


def _whole_sequence(found: Texts, first: int, n: int) -> np.ndarray:
    """The hash of a text of ``n`` words, too few for a window: it is none of a window, nor of another number of words."""
    values, _ = windows(found.hashes()[first : first + n], np.array([0, n]), n)
    return mixed(values[:1] ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64))


def gram_sets(column: pa.Array, shingle_words: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct 64-bit hashes of the n-grams of each text of a binary column, A-Z in lower case."""
    n = shingle_words
    for a, b, found in texts(column, letters=_LOWER):
        if isinstance(found, LongText):
            parts = [np.zeros(0, np.uint64)]
            for word, own, part in found.parts(n - 1):
                if word == 0 and 0 < len(part.starts) < n:  # the whole text
                    parts.append(_whole_sequence(part, 0, len(part.starts)))
                values, whole = windows(part.hashes(), part.first, n)
                parts.append(np.unique(values[:own][whole[:own]]))
            yield a, np.unique(np.concatenate(parts))
            continue
        values, _ = windows(found.hashes(), found.first, n)
        first = found.first.tolist()
        for k in range(b - a):
            begin, words = first[k], first[k + 1] - first[k]
            if words >= n:
                yield a + k, np.unique(values[begin : begin + words - n + 1])
            else:
                yield a + k, _whole_sequence(found, begin, words) if words else np.zeros(0, np.uint64)


def _digest(grams: np.ndarray) -> bytes:
    return blake2b(grams.tobytes(), digest_size=16).digest()


def least_share(size: int, percent: int = PERCENT) -> int:
    """N-grams of a set of this size that any set has which it links with."""
    return -(-percent * size // 100)


def least_overlap(size: int | np.ndarray, other: int | np.ndarray, percent: int = PERCENT) -> int | np.ndarray:
    """N-grams that two sets of these sizes have in common if they link."""
    return -(-percent * (size + other) // (100 + percent))


def _pack(names: np.ndarray, counts: np.ndarray, compress) -> bytes:
    """Sorted 32-bit names by their differences, and counts up to 255, compressed."""
    steps = np.diff(names, prepend=np.uint32(0)).astype("<u4")
    return compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes())


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 5
    planes = np.frombuffer(data, np.uint8)
    steps = np.ascontiguousarray(planes[: 4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32), planes[4 * n :].astype(np.int64)


def frequency_levels(texts_: DataFrame, shingle_words: int = SHINGLE_WORDS, remembered: int = REMEMBERED) -> list[np.ndarray]:
    """Two bitmaps over the leading bits of an n-gram's hash: in two documents or more, and in many.

    N-grams are counted by the first 32 bits and more of their hash, sorted and packed
    by each task, and dealt by leading bits, so that every task counts a range of hashes.
    Copies of a set count once in a task. Two n-grams that share a bit are both taken for
    the more frequent: an order of the columns need only be the same for all documents.
    """
    total = texts_.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(OFTEN_BITS - 4, max(8, int(np.ceil(np.log2(max(total / 5 / _HELD, 1))))))
    frequent = max(FREQUENT, total // 5 >> (OFTEN_BITS - 3))

    def sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress, seen, held, size = zstandard.ZstdCompressor(level=1).compress, _Seen(remembered), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            names, counts = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
            bucket = (names >> np.uint64(32)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(names))
            packed = [_pack(names[x:y].astype(np.uint32), counts[x:y], compress) for x, y in zip(cuts[:-1], cuts[1:])]
            for k in range(0, len(packed), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts[k : min(k + 1024, len(packed))]]), pa.array(packed[k : k + 1024], pa.binary())], names=["bucket", "packed"])

        for batch in batches:
            for _, grams in gram_sets(batch.column(0), shingle_words):
                if len(grams) and not seen(_digest(grams)):
                    held.append(grams)
                    size += len(grams)
                    if size >= _HELD:
                        yield from flush()
                        held, size = [], 0
        if held:
            yield from flush()

    def count(key: tuple, table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        found = [_unpack(unpack(x.as_py())) for x in table.column("packed")]
        names, counts = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        order = np.argsort(names, kind="stable")
        names, counts = names[order], counts[order]
        begins = np.flatnonzero(np.diff(names.astype(np.int64), prepend=-1))
        names, counts = names[begins], np.add.reduceat(counts, begins)
        maps = []
        for least, map_bits in ((2, TWICE_BITS), (frequent, OFTEN_BITS)):
            flags = np.zeros(1 << map_bits - bits, bool)
            flags[names[counts >= least] >> np.uint32(32 - map_bits + bits)] = True
            maps.append(np.packbits(flags, bitorder="little").tobytes())
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "twice": pa.array([maps[0]], pa.binary()), "often": pa.array([maps[1]], pa.binary())})

    packed = texts_.select("text").mapInArrow(sort_out, "bucket long, packed binary")
    found = packed.groupBy("bucket").applyInArrow(count, "bucket long, twice binary, often binary")
    maps = [np.zeros(1 << b >> 3, np.uint8) for b in (TWICE_BITS, OFTEN_BITS)]
    for row in found.toLocalIterator():  # of the size of the filters in all
        for each, data in zip(maps, (row.twice, row.often)):
            each[row.bucket * len(data) : (row.bucket + 1) * len(data)] = np.frombuffer(data, np.uint8)
    return maps


def _classes(grams: np.ndarray, maps: list[np.ndarray]) -> np.ndarray:
    """0 for n-grams that one document has, 1 for others, 2 for frequent ones."""
    found = np.zeros(len(grams), np.uint8)
    for each in maps:
        at = grams >> np.uint64(64 - (len(each) * 8).bit_length() + 1)
        found += (each[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return found


def parities(grams: np.ndarray, blocks: int = PARITIES) -> np.ndarray:
    """For each of many column blocks whether it has an odd number of the n-grams, as longs.

    Blocks in which two sets differ hold an n-gram that only one of them has, at the least.
    """
    odd = np.bincount((grams >> np.uint64(7)) & np.uint64(blocks - 1), minlength=blocks) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def incidence(keyed: DataFrame, maps: list[np.ndarray], shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, remembered: int = REMEMBERED) -> DataFrame:
    """``doc_id, tid, key, n, grams, at, odd`` for each row: a digest of its set, the set's size, its rarest n-grams with their places, and parities.

    N-grams are ordered by their frequency class and hash. Of two sets that link, the
    first that they share stands among the first ``n - ceil(0.8 n) + 1`` of either, so
    only those columns of the incidence matrix are sent, and of them only those that
    another document may have. Copies that a task has met have null there.
    """
    shared = keyed.sparkSession.sparkContext.broadcast(maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, maps = _Seen(remembered), shared.value
        for batch in batches:
            keys, sizes, grams_of, at_of, odd_of = [], [], [], [], []
            for _, grams in gram_sets(batch.column(2), shingle_words):
                key = _digest(grams) if len(grams) else None
                keys.append(key)
                sizes.append(len(grams))
                if key is None or seen(key):
                    grams_of.append(None)
                    at_of.append(None)
                    odd_of.append(None)
                    continue
                kinds = _classes(grams, maps)
                order = np.argsort(kinds, kind="stable")[: len(grams) - least_share(len(grams), percent) + 1]
                at = np.flatnonzero(kinds[order])
                grams_of.append(grams[order[at]].view(np.int64))
                at_of.append(at)
                odd_of.append(parities(grams))
            columns = [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(grams_of, pa.list_(pa.int64())), pa.array(at_of, pa.list_(pa.int64())), pa.array(odd_of, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tid", "key", "n", "grams", "at", "odd"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.select("doc_id", "tid", "text").mapInArrow(run, f"doc_id {kind}, tid long, key binary, n long, grams array<long>, at array<long>, odd array<long>")


def may_link(n: Column, at: Column, other_n: Column, other_at: Column, percent: int = PERCENT) -> Column:
    """Whether sets can link whose first common n-gram is at these places: by their sizes, and by what follows in the smaller rest."""
    fit = F.greatest(n, other_n) * percent <= F.least(n, other_n) * 100
    left = F.least(n - at, other_n - other_at)
    return fit & (left * (100 + percent) >= (n + other_n) * percent)


def near_parities(n: Column, odd: Column, other_n: Column, other_odd: Column, percent: int = PERCENT) -> Column:
    """Whether no more blocks differ in their parities than n-grams that two sets that link may have alone."""
    differ = sum((F.bit_count(odd[k].bitwiseXOR(other_odd[k])) for k in range(PARITIES // 64)), F.lit(0))
    total = n + other_n
    return differ <= total - 2 * F.ceil(percent * total / (100 + percent))


def linked_rows(row: np.ndarray, others: list[np.ndarray], percent: int = PERCENT, blocks: int = COLUMN_BLOCKS) -> np.ndarray:
    """One row of the product with a block of rows: which of ``others`` share enough with ``row``.

    Overlaps are added up column block by column block. After each, rows are discarded
    whose overlap can't reach the bound that the sizes set, with all that is left of them.
    """
    sizes = np.array([len(x) for x in others])
    bound = least_overlap(len(row), sizes, percent)
    columns, owner = np.concatenate(others), np.repeat(np.arange(len(others)), sizes)
    edges = np.array([2**64 // blocks * k for k in range(1, blocks)], np.uint64)
    cuts, block_of = np.concatenate([[0], np.searchsorted(row, edges), [len(row)]]), np.searchsorted(edges, columns, "right")
    got, left, left_row = np.zeros(len(others), np.int64), sizes.copy(), len(row)
    alive = np.minimum(left, left_row) >= bound
    for k in range(blocks):
        mine = row[cuts[k] : cuts[k + 1]]
        here = (block_of == k) & alive[owner]
        theirs, of = columns[here], owner[here]
        if len(mine):
            at = np.searchsorted(mine, theirs)
            hit = mine[np.minimum(at, len(mine) - 1)] == theirs
            got += np.bincount(of[hit], minlength=len(others))
        left -= np.bincount(of, minlength=len(others))
        left_row -= len(mine)
        alive &= got + np.minimum(left, left_row) >= bound
    return alive


def _product(batches: Iterator[pa.RecordBatch], shingle_words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links ``a, b`` of rows ``a, b, packed`` that stand by ``a``: first the text of ``a`` itself, then those it may link with."""
    unpack, row, held, size = zstandard.ZstdDecompressor().decompress, None, [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held and row is not None:
            found = linked_rows(row[1], [x[1] for x in held], percent)
            b = [held[k][0] for k in np.flatnonzero(found)]
            if b:
                yield pa.RecordBatch.from_arrays([pa.array([row[0]] * len(b), pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    for batch in (batch.slice(k, _ROWS) for batch in batches for k in range(0, batch.num_rows, _ROWS)):
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        plain = pa.array([unpack(x.as_py()) if x.as_py() else b"" for x in batch.column(2)], pa.large_binary())
        for k, grams in gram_sets(plain, shingle_words):
            if _digest(grams) != (b[k] or a[k]):
                continue  # of another row that shares the id
            if row is None or row[0] != a[k] or size >= ROW_BLOCK:
                yield from flush()
                held, size = [], 0
            if b[k] is None:
                row = (a[k], grams)
            elif row is not None and row[0] == a[k]:
                held.append((b[k], grams))
                size += len(grams)
    yield from flush()


def verified(pairs: DataFrame, sets: DataFrame, keyed: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs`` (``a, b, n_b``; written) of sets that link, by the exact product over all their columns.

    The texts wanted are read from the corpus, compressed, and dealt by ``a`` so that one
    row of the matrix meets blocks of others; a row with many others is sent to several
    tasks. ``sets`` has for each key the id and text hash of one of its rows.
    """
    spark = keyed.sparkSession
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(sets, "key").select("key", "tid", "doc_id")
    wanted = materialise(wanted, "wanted")
    with small_batches(spark, 256):
        packed = passing(keyed.select("doc_id", "tid", "text"), "tid", bitmap_of(wanted, "tid"), pack="text")
        of_set = wanted.withColumnsRenamed({"tid": "_tid", "doc_id": "_id"})
        found = packed.join(of_set, (F.col("tid") == F.col("_tid")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("key", "text")
        found = materialise(found, "wanted-texts")
        shares = pairs.groupBy("a").agg(F.floor(F.sum("n_b") / ROW_BLOCK + F.count(F.lit(1)) / 128 + 1).cast("int").alias("parts"))
        shares = materialise(shares, "shares")
        dealt = pairs.join(shares, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
        firsts = shares.select("a", F.lit(None).cast("binary").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        rows = firsts.join(found, F.col("a") == F.col("key")).union(dealt.join(found, F.col("b") == F.col("key")))
        rows = rows.select("a", "part", "b", "text").repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        run = lambda batches: _product(batches, shingle_words, percent)
        links = materialise(rows.select("a", "b", "text").mapInArrow(run, "a binary, b binary").distinct(), "links")
    discard(wanted, found, shares)
    return links


def jaccard_links(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, remembered: int = REMEMBERED) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, key, n`` and verified links ``a, b`` of keys, whose components are those of all links.

    Rows of equal sets have one key, and keys take part in the product once. For each
    column of the incidence matrix, all its documents are first multiplied with one of
    them, the least that any other may link with there; what this links is known to be
    together. What is then outside a column's largest group is multiplied with some rows
    of that, and at last every pair that shares a column and isn't together yet. So near
    copies by the thousand are multiplied with a few of them each, while no pair that
    could bring two groups together is left out.
    """
    hashed = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(hashed).alias("tid"), hashed.alias("text"))
    with small_batches(keyed.sparkSession):
        maps = frequency_levels(keyed, shingle_words, remembered)
        rows = materialise(incidence(keyed, maps, shingle_words, percent, remembered), "incidence")
    sets = rows.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("doc_id", "tid")).alias("x"), F.max("odd").alias("odd")).select("key", "x.doc_id", "x.tid", "odd")
    sets = materialise(sets, "sets")
    entries = rows.where("size(grams) > 0").select("key", "n", F.explode(F.arrays_zip("grams", "at")).alias("x")).select(F.col("x.grams").alias("gram"), "key", "n", "x.at")
    # a column counts only where a document stands that could be the smaller of a linked pair
    able = (F.col("n") - F.col("at")) * (100 + percent) >= 2 * percent * F.col("n")
    columns = entries.groupBy("gram").agg(F.min(F.struct((~able).alias("unable"), "key", "n", "at")).alias("first"), F.min("key").alias("low"), F.max("key").alias("high"))
    columns = columns.where("low <> high AND NOT first.unable").select("gram", F.col("first.key").alias("a"), F.col("first.n").alias("n_a"), F.col("first.at").alias("at_a"))
    columns = materialise(columns, "columns")
    named = entries.withColumnsRenamed({"key": "b", "n": "n_b", "at": "at_b"})
    held = materialise(named.join(columns, "gram"), "held")
    bounds = lambda: (F.col("a") != F.col("b")) & may_link(F.col("n_a"), F.col("at_a"), F.col("n_b"), F.col("at_b"), percent)
    pairs = materialise(held.where(bounds()).select("a", "b", "n_b").distinct(), "pairs")
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = verified(pairs, sets, keyed, shingle_words, percent)
    for last in (False, True):
        apart, largest = _apart(held, component_of(links)[0], sets.select("key", "odd"))
        outside = apart.join(largest, "gram").where(F.col("component") != F.col("largest"))
        if last:
            # every pair across components has an end outside the column's largest one
            other = apart.select("gram", *[F.col(c).alias(f"{c}_a") for c in ("n", "at", "component", "odd")], F.col("b").alias("a"))
        else:
            least = [F.min(F.struct(F.xxhash64(F.lit(k), "b").alias("h"), F.col("b").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("odd").alias("odd_a"))).alias(f"least{k}") for k in range(LEADERS)]
            leaders = apart.join(largest, "gram").where(F.col("component") == F.col("largest")).groupBy("gram", "largest").agg(*least)
            each = F.explode(F.array_distinct(F.array(*[f"least{k}" for k in range(LEADERS)]))).alias("x")
            other = materialise(leaders.select("gram", F.col("largest").alias("component_a"), each).select("gram", "component_a", "x.a", "x.n_a", "x.at_a", "x.odd_a"), "leaders")
        near = near_parities(F.col("n_a"), F.col("odd_a"), F.col("n_b"), F.col("odd"), percent)
        met = outside.withColumnsRenamed({"n": "n_b", "at": "at_b"}).join(other, "gram").where((F.col("component") != F.col("component_a")) & bounds() & near)
        swap = F.col("a") > F.col("b")
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b")).distinct()
        pairs = materialise(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        tried, links = tried.union(pairs.select("a", "b")), links.union(verified(pairs, sets, keyed, shingle_words, percent))
    discard(columns, held)
    return rows, links


def _apart(held: DataFrame, together: DataFrame, odd: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries of columns whose documents aren't all together yet, with their ``component`` and parities; and the ``largest`` of each such column."""
    entries = held.select("gram", "b", F.col("n_b").alias("n"), F.col("at_b").alias("at")).join(together, F.col("b") == F.col("node"), "left")
    entries = entries.select("gram", "b", "n", "at", F.coalesce("component", "b").alias("component"))
    several = entries.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("gram")
    apart = entries.join(materialise(several, "several"), "gram", "left_semi").distinct()
    apart = materialise(apart.join(odd, F.col("b") == F.col("key")).drop("key"), "apart")
    counts = apart.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("many"))
    return apart, materialise(counts.groupBy("gram").agg(F.max_by("component", F.struct("many", "component")).alias("largest")), "largest")


def near_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, remembered: int = REMEMBERED) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row.

    A document's set are its distinct runs of ``shingle_words`` words, A-Z in lower case;
    with fewer words the whole sequence. Two documents link where the intersection of
    their sets is at least ``percent`` hundredths of the union; ``component_id`` is the
    smallest id reachable. Null and empty texts have no set and are alone. Rows that
    repeat, or share a set, are one in the product and come out as often as they go in.
    Null ids are no component's smallest unless it has no other. A very long text is
    read in parts; its set alone is held whole. An empty table gives no rows; other
    columns are not read. N-grams are told apart by 64-bit hashes, sets by 128-bit digests.
    """
    rows, links = jaccard_links(docs, text, id_col, shingle_words, percent, remembered)
    together, _ = component_of(links)
    sets = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    known = sets.join(together, F.col("key") == F.col("node"), "left").select("key", F.coalesce("component", "key").alias("component"), "least")
    known = materialise(known, "known")
    least = materialise(known.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    of_set = materialise(known.join(least, "component").select("key", "component_id"), "components")
    joined = rows.where("key IS NOT NULL").select("doc_id", "n", "key").join(of_set, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("key IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return joined.union(alone)


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(read_table(spark, sf_dir, "documents"))


_SETS_SQL = r"""
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), sizes AS (
  SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN shingles ON w.doc_id = shingles.doc_id GROUP BY w.doc_id
)"""

#: Components by repeated least ids: of a link's ends, both take the lesser, until nothing changes.
OP13_SQL = f"""
WITH RECURSIVE {_SETS_SQL}, links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
  ) JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * common >= {PERCENT} * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT sizes.doc_id, CAST(n AS BIGINT) AS n_shingles, component_id FROM sizes JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON doc_id = a
"""
