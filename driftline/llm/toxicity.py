"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import materialise, read_table
from driftline.llm.words import LongText, Texts, texts

#: Labelled rows that the classifier is fitted on: at most so many of either label, of texts up to so many bytes.
TOXIC_ROWS, CLEAN_ROWS, TRAIN_BYTES = 1500, 2500, 16384
#: Scores from here on are predicted 1. Thresholds by language are moved to this score.
PREDICT_FROM = 0.3
BUCKETS = 1 << 14
DIMENSIONS = 12
FILTERS = {1: 12, 2: 6, 3: 6}
EPOCHS, LEAST_STEPS, BATCH_ROWS, RATE, SEED = 5, 320, 48, 0.02, 7
#: Every so many rows of the sample calibrate instead of train.
CALIBRATE_EVERY = 4
_CHUNK_BYTES = 512 << 10

#: What parts words here: all ASCII but letters and digits; letters are read in lower case.
_SPACE = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes of a word's prefixes that have embeddings beside the word's own.
_PREFIXES = (4, 6, 8)
_PARTS = 1 + len(_PREFIXES)


def _buckets(found: Texts) -> np.ndarray:
    """For each word, the rows of its parts in the embedding table."""
    hashes = [found.hashes(), *map(found.prefix_hashes, _PREFIXES)]
    return np.stack([(h % np.uint64(BUCKETS)).astype(np.int32) + k * BUCKETS for k, h in enumerate(hashes)], axis=1)


@dataclass
class Model:
    """Embeddings, filters by width, the last layer, and the languages with their thresholds."""

    embeddings: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    last: np.ndarray
    bias: float
    languages: np.ndarray
    shifts: np.ndarray

    def padded(self, buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors with a text's words followed by zeros, as many as the widest filter needs, and where texts begin."""
        pad, n = max(FILTERS), np.diff(first)
        begins = np.concatenate([[0], np.cumsum(n + pad)])
        vectors = np.zeros((begins[-1], DIMENSIONS), np.float32)
        at = np.arange(len(buckets)) + np.repeat(pad * np.arange(len(n)), n)
        total = self.embeddings[buckets[:, 0]]
        for k in range(1, _PARTS):
            total = total + self.embeddings[buckets[:, k]]
        vectors[at] = total
        return vectors, begins

    def activations(self, vectors: np.ndarray) -> np.ndarray:
        """Of each filter at each place; the last places of the array, which are padding, lack the wider ones."""
        out = []
        for width, weights in self.filters.items():
            made = np.tile(self.biases[width], (len(vectors), 1))
            for k in range(width):
                made[: len(vectors) - k] += vectors[k:] @ weights[k]
            out.append(made)
        return np.concatenate(out, axis=1)

    def pooled(self, buckets: np.ndarray, first: np.ndarray, places: int | None = None) -> np.ndarray:
        """For each text, each filter's highest activation; at the first ``places`` of a single text, if given."""
        vectors, begins = self.padded(buckets, first)
        # places from a text's first to the one after its last word; what starts later would reach into the next text
        ends = begins[1:] - max(FILTERS) + 1 if places is None else begins[:-1] + places
        cuts = np.stack([begins[:-1], ends], axis=1).ravel()
        return np.maximum(np.maximum.reduceat(self.activations(vectors), cuts, axis=0)[::2], 0)

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(buckets, first) @ self.last + self.bias

    def language_sums(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each text and language, the log-likelihood of its words."""
        total = np.zeros((len(buckets) + 1, self.languages.shape[1]))
        np.cumsum(self.languages[buckets[:, 0]], axis=0, out=total[1:])
        return total[first[1:]] - total[first[:-1]]

    def language(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The likeliest language of each text by its words; of a text without words the first."""
        return self.language_sums(buckets, first).argmax(axis=1)

    def scores(self, found: Texts | LongText) -> np.ndarray:
        """0 to 1, moved so that the threshold of the text's language comes to ``PREDICT_FROM``; a long text is pooled over its parts."""
        if isinstance(found, LongText):
            best, sums = None, 0
            for _, own, part in found.parts(max(FILTERS) - 1):
                buckets, n = _buckets(part), len(part.starts)
                here = self.pooled(buckets, np.array([0, n]), own if own < n else None)
                best = here if best is None else np.maximum(best, here)
                sums = sums + self.language_sums(buckets[:own], np.array([0, own]))
            moved = best @ self.last + self.bias + self.shifts[sums.argmax(axis=1)]
        else:
            buckets = _buckets(found)
            moved = self.logits(buckets, found.first) + self.shifts[self.language(buckets, found.first)]
        return 1 / (1 + np.exp(-np.clip(moved, -30, 30)))


def _language_table(rows: list[np.ndarray], langs: list[int], n: int) -> np.ndarray:
    counts = np.full((BUCKETS, n), 0.1)
    for buckets, lang in zip(rows, langs):
        np.add.at(counts, (np.unique(buckets[:, 0]), lang), 1)
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit from which predictions have the best F1, between the two rows that it parts."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    k = int(f1.argmax())
    low = logits[order[k + 1]] if k + 1 < len(order) else logits[order[k]] - 1
    return float((logits[order[k]] + low) / 2)


def fit(data: list[bytes], labels: np.ndarray, langs: list[str | None], seed: int = SEED) -> Model | None:
    """A model of labelled texts; none if the training rows lack one of the labels."""
    parsed = [Texts(_LETTERS[np.frombuffer(x, np.uint8)], np.array([0, len(x)]), _SPACE) for x in data]
    rows = [_buckets(x) for x in parsed]
    test = np.arange(len(rows)) % CALIBRATE_EVERY == 0
    train = np.flatnonzero(~test)
    if len(set(labels[train].tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    names = sorted({x or "" for x in langs})
    codes = [names.index(x or "") for x in langs]
    m = Model(
        rng.normal(0, 0.1, (_PARTS * BUCKETS, DIMENSIONS)).astype(np.float32),
        {w: rng.normal(0, 0.5 / w, (w, DIMENSIONS, n)).astype(np.float32) for w, n in FILTERS.items()},
        {w: np.zeros(n, np.float32) for w, n in FILTERS.items()},
        rng.normal(0.5, 0.1, sum(FILTERS.values())).astype(np.float32),
        -1.0,
        _language_table([rows[k] for k in train], [codes[k] for k in train], len(names)),
        np.zeros(len(names)),
    )
    squares = {}

    def step(name, values, gradient, at=None):
        """Adagrad, on some rows of a table if ``at`` is given."""
        total = squares.setdefault(name, np.full_like(values, 1e-6))
        if at is None:
            total += gradient**2
            values -= RATE * gradient / np.sqrt(total)
        else:
            total[at] += gradient**2
            values[at] -= RATE * gradient / np.sqrt(total[at])

    bias = np.array([m.bias], np.float32)
    batches = max(1, len(train) // BATCH_ROWS)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // batches))):
        for part in np.array_split(rng.permutation(train), batches):
            buckets = np.concatenate([rows[k] for k in part])
            first = np.concatenate([[0], np.cumsum([len(rows[k]) for k in part])])
            vectors, begins = m.padded(buckets, first)
            made = m.activations(vectors)
            where = np.stack([a + made[a : b - max(FILTERS) + 1].argmax(axis=0) for a, b in zip(begins[:-1], begins[1:])])
            pooled = np.maximum(np.take_along_axis(made, where, axis=0), 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ m.last + bias[0], -30, 30)))
            error = ((p - labels[part]) / len(part)).astype(np.float32)
            back = error[:, None] * m.last * (pooled > 0)
            step("last", m.last, pooled.T @ error)
            step("bias", bias, np.array([error.sum()], np.float32))
            d_vectors, begin = np.zeros_like(vectors), 0
            for width, n in FILTERS.items():
                at, g = where[:, begin : begin + n], back[:, begin : begin + n]
                begin += n
                d_filter = np.zeros_like(m.filters[width])
                for k in range(width):
                    place = np.minimum(at + k, len(vectors) - 1)
                    d_filter[k] = np.einsum("bnd,bn->dn", vectors[place], g)
                    np.add.at(d_vectors, place.ravel(), (g[:, :, None] * m.filters[width][k].T[None]).reshape(-1, DIMENSIONS))
                step(("filter", width), m.filters[width], d_filter)
                step(("bias", width), m.biases[width], g.sum(axis=0))
            words = np.arange(len(buckets)) + np.repeat(max(FILTERS) * np.arange(len(part)), np.diff(first))
            used = np.flatnonzero(np.abs(d_vectors[words]).sum(axis=1))
            targets, gradient = buckets[used].ravel(), np.repeat(d_vectors[words[used]], _PARTS, axis=0)
            at, inverse = np.unique(targets, return_inverse=True)
            summed = np.zeros((len(at), DIMENSIONS), np.float32)
            np.add.at(summed, inverse, gradient)
            step("embeddings", m.embeddings, summed, at)
    m.bias = float(bias[0])
    goal = np.log(PREDICT_FROM / (1 - PREDICT_FROM))
    logits = np.array([m.logits(r, np.array([0, len(r)]))[0] for r in rows])
    guess = np.array([m.language(r, np.array([0, len(r)]))[0] for r in rows])
    for k in range(len(names)):
        own = test & (guess == k)
        own = own if labels[own].sum() >= 5 else test if labels[test].sum() else ~test
        m.shifts[k] = goal - _threshold(logits[own], labels[own])
    return m


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", id_col: str = "doc_id", lang: str = "lang") -> DataFrame:
    """``text, lang, toxic`` of a bounded sample: the ids of least hash, of those whose rows ``train`` allows.

    Of several rows of an id the one of least text is taken, and of several labels the
    highest, so the sample is the same in any order of the rows.
    """
    known = labels.where(train & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("toxic"))
    texts_of = docs.where(train).select(F.col(id_col).alias("_id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("text"))
    texts_of = texts_of.where(F.octet_length("text") <= TRAIN_BYTES)
    order = [F.xxhash64("_id"), F.col("_id")]
    ids = texts_of.select("_id").join(known, "_id").distinct()
    ids = materialise(ids, "labelled")
    chosen = ids.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS).union(ids.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    chosen = materialise(chosen, "chosen")  # at most TOXIC_ROWS + CLEAN_ROWS rows
    least = texts_of.join(F.broadcast(chosen), "_id").groupBy("_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("x"))
    return least.orderBy(*order).select("x.text", "x.lang", "toxic")


def train_toxicity(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", id_col: str = "doc_id", lang: str = "lang") -> Model | None:
    rows = labelled_sample(docs, labels, train, text, id_col, lang).collect()
    return fit([bytes(r.text) for r in rows], np.array([r.toxic for r in rows], np.int64), [r.lang for r in rows])


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text", columns: tuple[str, ...] = ("doc_id",), score: str = "score") -> DataFrame:
    """``columns`` of each row and ``score``, of the whole text alone. Without a model it is 0.

    A null text counts as empty, and an empty one is scored like any other. Equal texts
    have equal scores; repeated rows come out as often as they go in; a very long text is
    read in parts; an empty table gives no rows.
    """
    shared, n = docs.sparkSession.sparkContext.broadcast(model), len(columns)
    names = [f"c{k}" for k in range(n + 1)]  # whatever the columns are called

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a, b, found in texts(batch.column(n), _CHUNK_BYTES, _SPACE, _LETTERS):
                scores = np.zeros(b - a) if known is None else known.scores(found).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:n]), pa.array(scores)], names=names)

    source = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(columns, names)], F.col(text).cast("binary").alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.drop("text").schema)
    return source.mapInArrow(run, f"{kinds}, {names[-1]} double").toDF(*columns, score)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are not learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"), ~held_out())
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
