"""Incremental removal of repeated passages by a log-structured index of window fingerprints."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import delete_path, discard, materialise, new_path, read_table, small_batches
from driftline.llm.filters import bitmap_of, membership, passing, place_of
from driftline.llm.words import LongText, Texts, parts_of, texts, windows

WINDOW_WORDS = 20
#: Words of an anchor. Of the anchors inside a window the one of least hash is indexed.
ANCHOR_WORDS = 8
#: Batches that a whole table is given to the index in, by ascending id.
BATCHES = 2
#: Runs that are kept apart before two are merged.
MOST_RUNS = 1
#: Places that a task remembers, to tell repeats on the spot; what it forgets is told after a shuffle.
REMEMBERED = 60_000
#: Rows that a task turns into Python objects at once.
_ROWS = 64

# A place in a document is one integer: 31 bits of the first word's number, 4 of how many windows start from there on,
# 2 of what is known of them, and 26 of a hash, by which rows that share an id are told apart.
_START, _COUNT, _KIND, _TAG = 32, 28, 26, (1 << 26) - 1
#: What is known of windows: they start earlier as well; they do but for some; of those, one that doesn't.
REPEATED, PERHAPS, FIRST = 0, 1, 2


def _tag(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) & _TAG


def _anchors(found: Texts, own: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the anchor, first window and number of windows for each anchor of the windows of some texts.

    The windows that have one anchor follow each other. Two equal windows have the same
    anchor at the same place, whatever surrounds them. Only windows that start with one
    of the first ``own`` words are taken.
    """
    grams, _ = windows(found.hashes(), found.first, ANCHOR_WORDS)
    least, reach, most = np.arange(len(grams)), 1, WINDOW_WORDS - ANCHOR_WORDS + 1
    while reach < most and len(least):  # least[k] is the leftmost least of the ``reach`` grams from k on
        step = min(reach, most - reach)
        left, right = least[:-step], least[step:]
        least, reach = np.where(grams[left] <= grams[right], left, right), reach + step
    at = np.flatnonzero(found.whole(WINDOW_WORDS)[:own])
    anchor = least[at]
    begins = np.flatnonzero(np.diff(anchor, prepend=-1))
    return grams[anchor[begins]], at[begins], np.diff(np.append(begins, len(at)))


def _digests(found: Texts, first: np.ndarray, n_words: np.ndarray) -> list[bytes]:
    """128-bit BLAKE2b digests of words ``first`` to ``first + n_words``, joined by one space."""
    joined, begins = found.joined()
    view, a, b = memoryview(joined), begins[first].tolist(), (begins[first + n_words] - 1).tolist()
    return [blake2b(view[x:y], digest_size=16).digest() for x, y in zip(a, b)]


def _two_longs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


class _Places:
    """The earliest place met so far of each digest, of at most ``most`` recent digests in each of two generations."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def is_later(self, digest: bytes, place: tuple[int, int]) -> bool:
        known = self.young.get(digest) or self.old.get(digest)
        if known is not None and known < place:
            place = known
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[digest] = place
        return place is known


def _keyed(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))


def posting_rows(docs: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """``key, span, doc, at, later`` for each anchor of the windows of each text.

    ``key`` is the anchor's hash, ``span`` a digest of all words of the windows that have
    it, ``at`` the place of the first of them. ``later`` rows are those of which the task
    has met the same earlier: nothing else need be known of them, so a passage that
    most documents have is one row a task, or some, in the shuffles that follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Places(remembered)
        for batch in batches:
            ids = batch.column(0)
            ordered = [-(2**63) - 1 if x is None else x for x in ids.to_pylist()]

            def rows(found: Texts, a: int, tags: np.ndarray, own: int | None = None, word: int = 0) -> pa.RecordBatch:
                key, first, n = _anchors(found, own)
                owner = np.searchsorted(found.first, first, "right") - 1
                starts = first - found.first[owner] + word
                digests = _digests(found, first, n + WINDOW_WORDS - 1)
                at = starts << _START | n << _COUNT | tags[owner]
                later = [seen.is_later(d, (ordered[a + k], s)) for d, k, s in zip(digests, owner.tolist(), starts.tolist())]
                columns = [pa.array(key.view(np.int64)), pa.array(_two_longs(digests)[:, 0].copy()), ids.take(pa.array(a + owner)), pa.array(at), pa.array(later, pa.bool_())]
                return pa.RecordBatch.from_arrays(columns, names=["key", "span", "doc", "at", "later"])

            for a, _, found in texts(batch.column(1)):
                if isinstance(found, LongText):
                    tag = np.array([_tag(found.data)])
                    for word, own, part in found.parts(WINDOW_WORDS - 1):
                        yield rows(part, a, tag, own, word)
                else:
                    cut = found.offsets
                    yield rows(found, a, np.array([_tag(found.data[x:y]) for x, y in zip(cut[:-1], cut[1:])], np.int64))

    return docs.mapInArrow(run, "key long, span long, doc long, at long, later boolean")


def _windows_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``w1, w2, doc, start, at`` of the windows at the given places of packed texts: their digests, and places for ``FIRST``."""
    unpack = zstandard.ZstdDecompressor().decompress
    slices = (batch.slice(k, _ROWS) for batch in batches for k in range(0, batch.num_rows, _ROWS))
    for batch in slices:
        for row, doc in enumerate(batch.column(0).to_pylist()):
            packed, places = batch.column(1)[row].as_py(), np.array(batch.column(2)[row].as_py(), np.int64)
            data = unpack(packed) if packed else b""
            places = places[places & _TAG == _tag(data)]
            n = places >> _COUNT & 15
            starts = np.unique(np.repeat(places >> _START, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            for word, own, found in parts_of(data, WINDOW_WORDS - 1):
                inside = starts[(starts >= word) & (starts < word + own)]
                inside = inside[inside - word + WINDOW_WORDS <= len(found.starts)]
                if not len(inside):
                    continue
                digests = _two_longs(_digests(found, inside - word, np.full(len(inside), WINDOW_WORDS)))
                at = inside << _START | 1 << _COUNT | FIRST << _KIND | digests[:, 0] & _TAG
                columns = [*(pa.array(digests[:, k].copy()) for k in (0, 1)), pa.array([doc] * len(inside), pa.int64()), pa.array(inside), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "doc", "start", "at"])


@dataclass
class FingerprintIndex:
    """Sorted, immutable runs of the anchors of all batches so far, and the places where they stand, in a folder.

    A run is a table of the distinct anchors of a batch, in buckets by anchor and sorted
    in each, so that a new batch is merge-joined with all runs without moving history.
    Places of anchors that a batch shares with history, or has twice, are verified on the
    words: first all windows of an anchor at once, by a digest of their words; then
    the windows of anchors whose surroundings differ, one by one. Beyond ``most_runs``
    the two youngest runs are merged, likewise in place. Files are written once; the newest
    manifest names those that count, so an index can be opened again by its folder.
    Texts stay where they are: ``append`` is given the earlier ones.
    """

    spark: SparkSession
    path: str
    most_runs: int = MOST_RUNS
    remembered: int = REMEMBERED
    buckets: int = 0
    generation: int = 0
    highest: int | None = None
    names: list[str] = field(default_factory=list)
    merged: int = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str, **options) -> FingerprintIndex:
        """The index of a folder as its newest manifest has it."""
        found = max((json.loads(r.value) for r in spark.read.text(f"{path}/manifest-*").collect()), key=lambda m: m["generation"])
        return cls(spark, path, **options, **found)

    def _commit(self) -> None:
        self.generation += 1
        state = {k: getattr(self, k) for k in ("buckets", "generation", "highest", "names")}
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(f"{self.path}/manifest-{self.generation:09d}")

    def run(self, name: str) -> DataFrame:
        """``key, n`` of a run: its anchors and how often they came."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS driftline_run_{name} (key BIGINT, n BIGINT) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}/run-{name}'"
        )
        return self.spark.table(f"driftline_run_{name}")

    def places(self, name: str) -> DataFrame:
        return self.spark.read.schema("key long, span long, doc long, at long, later boolean").parquet(f"{self.path}/places-{name}")

    def _write_run(self, counts: DataFrame, name: str) -> DataFrame:
        writer = counts.select("key", "n").write.format("parquet").option("path", f"{self.path}/run-{name}")
        writer.bucketBy(self.buckets, "key").sortBy("key").saveAsTable(f"driftline_run_{name}")
        return self.run(name)

    def close(self) -> None:
        """Forget the names of the runs' tables; the folder stays."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS driftline_run_{name}")

    def compact(self) -> None:
        """Merge the two youngest runs by a merge join: counts of equal anchors add up; places that said all they had to say go."""
        a, b = self.names[-2:]
        name = uuid.uuid4().hex
        counts = self.run(a).hint("merge").join(self.run(b).withColumnRenamed("n", "more"), "key", "full")
        self._write_run(counts.select("key", (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n")), name)
        self.places(a).union(self.places(b)).where("NOT later").write.parquet(f"{self.path}/places-{name}")
        self.names[-2:] = [name]
        self.merged += 1
        self._commit()
        for old in (a, b):
            self.spark.sql(f"DROP TABLE IF EXISTS driftline_run_{old}")
            delete_path(self.spark, f"{self.path}/run-{old}")
            delete_path(self.spark, f"{self.path}/places-{old}")

    def repeated(self, run: DataFrame) -> DataFrame:
        """``key, met`` of the anchors that ``run`` has twice or shares with history: one merge join for each run."""
        joined = run.withColumn("past", F.lit(0).cast("long"))
        for k, name in enumerate(self.names):
            joined = joined.join(self.run(name).withColumnRenamed("n", f"n{k}").hint("merge"), "key", "left")
            joined = joined.withColumn("past", F.col("past") + F.coalesce(f"n{k}", F.lit(0))).drop(f"n{k}")
        return joined.where("n + past > 1").selectExpr("key", "past > 0 AS met")

    def append(self, docs: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
        """Add a batch ``doc, text`` whose ids are above those of all before; ``doc, marks`` of its repeated windows.

        ``earlier`` has the texts of the batches before, whose windows are read where an
        anchor is in common.
        """
        low, high = docs.agg(F.min("doc"), F.max("doc")).first()
        if self.highest is not None and low is not None and low <= self.highest:
            raise ValueError("ids have to be above those of the batches before")
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = uuid.uuid4().hex
        posting_rows(docs, self.remembered).write.parquet(f"{self.path}/places-{name}")
        batch = self.places(name)
        fresh = batch.where("NOT later").drop("later")
        run = self._write_run(fresh.groupBy("key").agg(F.count(F.lit(1)).alias("n")), name)
        repeated = materialise(self.repeated(run), "repeated")
        # an anchor that passes the filter by chance is alone below, and does no harm
        places = passing(fresh, "key", bitmap_of(repeated, "key")).withColumn("is_new", F.lit(True))
        met = bitmap_of(repeated.where("met"), "key") if self.names else None
        for old in self.names:
            past = passing(self.places(old).where("NOT later").drop("later"), "key", met)
            places = places.union(past.withColumn("is_new", F.lit(False)))
        # of places with equal words around one anchor all but the earliest are settled; a task has sent one of them, or some
        same = Window.partitionBy("key", "span").orderBy(F.col("doc").asc_nulls_first(), F.shiftright("at", _START))
        ranked = materialise(places.withColumn("nth", F.rank().over(same)), "ranked")
        first = ranked.where("nth = 1")
        several = first.groupBy("key").agg(F.min("span").alias("low"), F.max("span").alias("high")).where("low <> high").select("key")
        several = materialise(several, "several")  # so that the join below can part a hot anchor's places
        unsure = materialise(first.join(several, "key", "left_semi").select("doc", "at", "is_new"), "unsure")
        by_doc = unsure.groupBy("doc").agg(F.collect_list("at").alias("places"))
        every = docs if earlier is None else docs.union(earlier)
        packed = passing(every, "doc", bitmap_of(unsure, "doc"), pack="text")
        of_doc = packed.join(by_doc.withColumnRenamed("doc", "_doc"), F.col("doc").eqNullSafe(F.col("_doc"))).select("doc", "text", "places")
        seen = of_doc.mapInArrow(_windows_at, "w1 long, w2 long, doc long, start long, at long")
        earliest = seen.groupBy("w1", "w2").agg(F.min(F.struct("doc", "start", "at")).alias("x")).select("x.doc", "x.at")
        if self.names:  # history's own windows were judged before; without a highest id it has null ids alone
            earliest = earliest.where("doc IS NOT NULL" if self.highest is None else F.col("doc") > self.highest)
        marks = ranked.where("nth > 1 AND is_new").select("doc", "at").union(batch.where("later").select("doc", "at"))
        marks = marks.union(unsure.where("is_new").select("doc", F.col("at").bitwiseOR(F.lit(PERHAPS << _KIND)))).union(earliest)
        found = materialise(marks.groupBy("doc").agg(F.collect_list("at").alias("marks")), "marks")
        discard(repeated, ranked, several, unsure)
        self.names.append(name)
        self.highest = high if self.highest is None else max(self.highest, high if high is not None else self.highest)
        self._commit()
        while len(self.names) > self.most_runs:
            self.compact()
        return found


def removed_words(data: bytes, marks: np.ndarray) -> np.ndarray:
    """Whether each word goes, as far as any does: it is covered by a window that starts earlier as well."""
    kind, starts = marks >> _KIND & 3, marks >> _START
    own = marks[(kind != FIRST) & (marks & _TAG == _tag(data))]
    if not len(own):
        return np.zeros(0, bool)
    a, n = own >> _START, own >> _COUNT & 15
    edges = np.zeros(int((a + n).max()) + WINDOW_WORDS, np.int64)
    np.add.at(edges, a, 1)
    np.add.at(edges, a + n, -1)
    windows_gone = np.cumsum(edges) > 0
    first = np.unique(starts[kind == FIRST])
    first = first[first < len(windows_gone)]
    if len(own) == np.count_nonzero(kind != FIRST):  # no other row shares the id and has marks, so all are this row's
        windows_gone[first] = False
    elif len(first):
        tags = {}
        for m in marks[kind == FIRST].tolist():
            tags.setdefault(m >> _START, set()).add(m & _TAG)
        for word, mine, found in parts_of(data, WINDOW_WORDS - 1):
            inside = first[(first >= word) & (first < word + mine)]
            inside = inside[inside - word + WINDOW_WORDS <= len(found.starts)]
            if len(inside):
                digests = _two_longs(_digests(found, inside - word, np.full(len(inside), WINDOW_WORDS)))[:, 0] & _TAG
                windows_gone[[s for s, d in zip(inside.tolist(), digests.tolist()) if d in tags[s]]] = False
    at = np.flatnonzero(windows_gone)
    edges = np.zeros(len(windows_gone) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW_WORDS, -1)
    return np.cumsum(edges) > 0


def remove_words(data: bytes, marks: np.ndarray) -> tuple[int, int, bytes]:
    """Words, words removed, and the kept words joined by one space; a very long text is read in parts."""
    gone = removed_words(data, marks) if len(marks) else np.zeros(0, bool)
    if not gone.any() and len(data) <= 1 << 20:
        words = data.split()
        return len(words), 0, b" ".join(words)
    n_words, n_removed, kept = 0, 0, []
    for word, own, found in parts_of(data):
        here = np.zeros(own, bool)
        known = gone[word : word + own]
        here[: len(known)] = known
        joined, begins = found.joined()
        if own > here.sum():
            kept.append(joined[np.repeat(~here, np.diff(begins))].tobytes()[:-1])
        n_words, n_removed = n_words + own, n_removed + int(here.sum())
    return n_words, n_removed, b" ".join(kept)


def _batches_of(batches: Iterator[tuple[list, Iterator[tuple[bytes, np.ndarray]]]]) -> Iterator[pa.RecordBatch]:
    """Rows for ids and, to each, its text and marks; some at a time."""
    for ids, pairs in batches:
        out, held = [], 0
        for doc, (data, marks) in zip(ids, pairs):
            out.append((doc, *remove_words(data, marks)))
            held += len(out[-1][3])
            if held > 8 << 20:
                yield _rows(out)
                out, held = [], 0
        if out:
            yield _rows(out)


_CLEANED = "doc long, n_words long, n_removed long, kept string"


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed texts without the words that their marks tell."""
    unpack = zstandard.ZstdDecompressor().decompress
    slices = (batch.slice(k, _ROWS) for batch in batches for k in range(0, batch.num_rows, _ROWS))
    pairs = lambda x: ((unpack(t.as_py()), np.array(m.as_py() or (), np.int64)) for t, m in zip(x.column(1), x.column(2)))
    yield from _batches_of((x.column(0).to_pylist(), pairs(x)) for x in slices)


def _untouched(docs: DataFrame, found: tuple[int, dict[int, bytes]]) -> DataFrame:
    """The texts whose ids the filter hasn't, which so have no marks."""
    bits, bitmaps = found
    shared, none = docs.sparkSession.sparkContext.broadcast(bitmaps), np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = membership(shared, bits)
        slices = (batch.slice(k, _ROWS) for batch in batches for k in range(0, batch.num_rows, _ROWS))
        kept = (x.filter(pa.array(~has(x))) for x in slices)
        yield from _batches_of((x.column(0).to_pylist(), ((t.as_py() or b"", none) for t in x.column(1))) for x in kept)

    return docs.select("doc", "text", place_of("doc", bits)).mapInArrow(run, _CLEANED)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    doc, words, removed, kept = zip(*out)
    kept = pa.array(kept, pa.binary()).cast(pa.string(), safe=False)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), kept], names=["doc", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", batches: int = BATCHES, most_runs: int = MOST_RUNS, remembered: int = REMEMBERED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for each row: the text without words of windows that also start earlier.

    Earlier is a smaller id, or the same id and an earlier start; windows are judged on
    the input. Ids are integers. A null text has no words. A null id comes before all
    others. Rows that share an id are judged as one document: a window that starts at the
    same word in several of them is not removed for that. A very long text is read in
    parts. Other columns are not read.
    """
    spark, keyed = docs.sparkSession, _keyed(docs, text, id_col)
    low, high = keyed.agg(F.min("doc"), F.max("doc")).first()
    bounds = [] if low is None else [low + (high - low + 1) * k // batches for k in range(1, batches)]
    index, starts = FingerprintIndex(spark, new_path(spark, "index"), most_runs, remembered), None
    with small_batches(spark):
        for a, b in zip([None, *bounds], [*bounds, None]):
            part = keyed if a is None else keyed.where(F.col("doc") >= a)
            part = part if b is None else part.where((F.col("doc") < b) | F.col("doc").isNull())
            before = None if a is None else keyed.where((F.col("doc") < a) | F.col("doc").isNull())
            found = index.append(part, before)
            starts = found if starts is None else starts.union(found)
    index.close()
    touched = bitmap_of(starts, "doc")
    starts = starts.withColumnRenamed("doc", "_doc")
    packed = passing(keyed, "doc", touched, pack="text").join(starts, F.col("doc").eqNullSafe(F.col("_doc")), "left").select("doc", "text", "marks")
    out = packed.mapInArrow(_cleaned, _CLEANED).union(_untouched(keyed, touched))
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept")


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20
), later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, rank() OVER (PARTITION BY array_to_string(ws[s:s + 19], ' ') ORDER BY doc_id, s) AS nth FROM starts) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, s + unnest(range(20)) AS i FROM later
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text, count(*) AS n FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
