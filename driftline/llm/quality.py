"""Quality rules: plain counts, and robust multivariate outliers by the minimum covariance determinant."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import discard, materialise, read_table
from driftline.llm.words import SPACE, LongText, Texts, parts_of, texts, windows

SYMBOLS = b"#*$%&|<>"
REPEAT_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: Share of a group's rows whose covariance has the least determinant.
SUBSET = 0.75
#: By how much the covariance of that share of a normal law's rows, in 5 dimensions, falls short of the law's: 0.75 over
#: the chance that a chi-square variable of 7 degrees of freedom is below the 0.75 quantile of one of 5.
CONSISTENCY = 1.4121
#: First subsets by group, each of one row more than there are features; steps that all of them take; how many go on.
STARTS, FIRST_STEPS, FINALISTS = 8, 2, 2
#: Fall of a determinant's logarithm that counts as one.
LEAST_FALL = 1e-6
#: Groups of fewer rows are judged with the small groups of their language.
LEAST_ROWS = 50
#: Steps of a feature to the unit; sums of whole numbers come out the same in any order.
_GRID = 256
#: Steps of a counting error's variance to the square of a feature's step.
_FINE = 256
#: Squared distance that one row in 1,000 of a normal law exceeds: the 0.999 quantile of chi-square with 5 degrees of freedom.
CHI2_LIMIT = 20.515
FEATURES = ("words", "letters_a_word", "symbols_a_word", "repeated_lines", "repeated_words")
#: Variance of each feature that counting alone makes, over 1 / words, or 1 / lines: roots of counts over an exposure have
#: 1 / 4, whatever the rate; repeated words come by windows of eight; the logarithm of a count has 1.
_ERRORS = (1.0, 0.25, 0.25, 0.25, 0.25 * REPEAT_WORDS)
_BY_LINES = 3


def text_statistics(docs: DataFrame, text: str = "text", id_col: str = "doc_id", carry: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``doc_id``, the columns of ``carry``, and counts over the whole text; a null text has no words, a very long one is read in parts."""
    symbols, letters = np.zeros(256, bool), np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    letters[:128] = letters[192:] = True  # a code point's first byte

    def counts_of(found: Texts) -> list[np.ndarray]:
        return [np.diff(found.first), found.sums(letters & ~SPACE), found.sums(symbols)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, found in texts(batch.column(batch.num_columns - 1)):
                if isinstance(found, LongText):
                    counts = [np.sum(x, axis=0) for x in zip(*(counts_of(part) for _, _, part in found.parts(0)))]
                    whole = found.data.tobytes()
                    counts += [np.array([x]) for x in (repeated_lines(whole), repeated_words(whole), filled_lines(whole))]
                else:
                    whole = [found.data[x:y].tobytes() for x, y in zip(found.offsets[:-1], found.offsets[1:])]
                    repeated = np.zeros(b - a, np.int64)
                    for k in _with_repeats(found):
                        repeated[k] = repeated_words(whole[k])
                    counts = [*counts_of(found), np.array([repeated_lines(x) for x in whole]), repeated, np.array([filled_lines(x) for x in whole])]
                rest = [c.slice(a, b - a) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c.astype(np.int64)) for c in counts)], names=names)

    source = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text).cast("binary").alias("text"))
    names = ["doc_id", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in source.drop("text").schema]
    return source.mapInArrow(run, ", ".join([*kinds, *(f"{n} long" for n in names[len(kinds) :])]))


def _with_repeats(found: Texts) -> np.ndarray:
    """Numbers of the texts that may have a window twice: two hashes of it are equal."""
    hashes, _ = windows(found.hashes(), found.first, REPEAT_WORDS)
    whole, owner = found.whole(REPEAT_WORDS), found.text_of_words()
    keys = (hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[whole]
    order = np.argsort(keys)
    equal = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    return np.unique(owner[whole][order[equal]])


def repeated_words(text: bytes, n: int = REPEAT_WORDS) -> int:
    """Words in windows of ``n`` words that a text has twice or more, the first of them included.

    Eight bytes a window tell those whose hash comes twice; only of these are the words
    looked at, a few at a time.
    """
    hashes = []
    for _, own, part in parts_of(text, n - 1):
        values, _ = windows(part.hashes(), part.first, n)
        hashes.append(values[part.whole(n)][:own])
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    twice = np.zeros(len(hashes), bool)
    equal = ordered[1:] == ordered[:-1]
    twice[1:] |= equal
    twice[:-1] |= equal
    asked = np.sort(order[twice])  # windows whose hash comes twice
    digests = []
    for word, own, part in parts_of(text, n - 1):
        here = asked[(asked >= word) & (asked < word + own)] - word
        if len(here):
            joined, at = part.joined()
            view = memoryview(joined)
            digests += [blake2b(view[x:y], digest_size=16).digest() for x, y in zip(at[here].tolist(), (at[here + n] - 1).tolist())]
    times = Counter(digests)
    starts = asked[[times[d] > 1 for d in digests]] if digests else asked
    # windows overlap: of each, the words after the end of the one before it count
    return int(np.minimum(np.diff(starts), n).sum()) + n if len(starts) else 0


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) == 1 or len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if x.split(None, 1)]
    return len(lines) - len(set(lines))


def filled_lines(text: bytes) -> int:
    """Lines with a word."""
    return sum(1 for x in text.split(b"\n") if x and not x.isspace())


def _features() -> list[Column]:
    """Transformed statistics on a grid, in the order of ``FEATURES``, and the counting errors by words and by lines."""
    n, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    found = [
        F.log1p("n_words"),
        F.sqrt(F.least(F.col("word_chars") / n, F.lit(64.0))),
        F.sqrt(F.least(F.col("n_symbols") / n, F.lit(64.0))),
        F.sqrt(F.col("n_dup_lines") / lines),
        F.sqrt(F.col("n_repeat_words") / n),
    ]
    errors = [F.round(_GRID**2 * _FINE / x).cast("long") for x in (n, lines)]
    return [F.round(x * _GRID).cast("long").alias(f"x{k}") for k, x in enumerate(found)] + [errors[0].alias("e0"), errors[1].alias("e1")]


_X = [f"x{k}" for k in range(len(FEATURES))]
_E = ["e0", "e1"]
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i, len(_X))]
_GROUP = ["g_lang", "g_source"]
_PARAMETERS = ["logdet", "start", "centre", "spread", "error", "inverse"]


def _error(k: int, by_words, by_lines):
    """Variance of feature k by counting, on the features' grid."""
    return (by_lines if k == _BY_LINES else by_words) * (_ERRORS[k] / _FINE)


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by keys of which any may be null; those of ``right`` go."""
    right = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
    on = same[0]
    for x in same[1:]:
        on = on & x
    return left.join(right, on, how).drop(*(f"r_{k}" for k in keys))


def _inverted(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre, covariance and its determinant from the sums of each subset; every row is one subset.

    The covariance is that of the features and, in the diagonal, the mean of the rows'
    counting errors and the error of the grid, without which features that nowhere
    differ would leave no determinant.
    """
    size = len(_X)
    for table in tables:
        found = {name: [] for name in _PARAMETERS if name != "start"}
        for row in table.to_dict("records"):
            n = float(row["n"])
            centre = np.array([row[f"s{k}"] for k in range(size)], float) / n
            spread = np.zeros((size, size))
            for i, j in _PAIRS:
                # whole numbers of any size: the difference isn't lost in rounding
                spread[i, j] = spread[j, i] = (int(row[f"p{i}_{j}"]) * int(row["n"]) - int(row[f"s{i}"]) * int(row[f"s{j}"])) / n**2
            error = np.array([_error(k, row["t0"] / n, row["t1"] / n) for k in range(size)])
            whole = spread + np.diag(error + 1 / 12)
            for name, value in (("centre", centre), ("spread", spread.ravel()), ("error", error), ("inverse", np.linalg.inv(whole).ravel())):
                found[name].append(value)
            found["logdet"].append(np.linalg.slogdet(whole)[1])
        yield table[[*_GROUP, "start"]].assign(**found)


def _fitted(rows: DataFrame, label: str) -> DataFrame:
    """Parameters of each group and start, from sums that are added up before the shuffle."""
    sums = [F.sum(x).alias(f"s{k}") for k, x in enumerate(_X)] + [F.sum(x).alias(f"t{k}") for k, x in enumerate(_E)]
    products = [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p{i}_{j}") for i, j in _PAIRS]
    moments = rows.groupBy(*_GROUP, "start").agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    arrays = ", ".join(f"{name} array<double>" for name in ("centre", "spread", "error", "inverse"))
    return materialise(moments.mapInPandas(_inverted, f"g_lang string, g_source string, start int, logdet double, {arrays}"), label)


def _first_subsets(fit: DataFrame) -> DataFrame:
    """For each group and start as many rows as there are features and one, by hashes of what they count.

    Equal rows have equal hashes, so copies are no likelier to be taken than other rows.
    """
    slots = len(_X) + 1
    tried = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(STARTS - 1))).alias("start"))
    tried = tried.withColumn("h", F.xxhash64("start", *_X, *_E)).withColumn("slot", F.pmod("h", F.lit(slots)))
    taken = tried.groupBy(*_GROUP, "start", "slot").agg(F.min_by(F.struct(*_X, *_E), "h").alias("row"))
    return taken.select(*_GROUP, "start", "row.*")


def _distance() -> Column:
    """Squared Mahalanobis distance that is to be expected of a row, its counting errors included, on a logarithmic grid."""
    size, total = len(_X), F.lit(0.0)
    for i, j in _PAIRS:
        term = F.col("inverse")[i * size + j] * (F.col(_X[i]) - F.col("centre")[i]) * (F.col(_X[j]) - F.col("centre")[j])
        total = total + (term if i == j else 2.0 * term)
    for k in range(size):
        total = total + F.col("inverse")[k * size + k] * _error(k, F.col("e0"), F.col("e1"))
    return F.round(256 * F.log1p(F.greatest(total, F.lit(0.0)))).cast("int").alias("d")


def _concentrated(fit: DataFrame, parameters: DataFrame, label: str) -> DataFrame:
    """The parameters that the nearest rows by the given ones have: their determinant is less, or the same."""
    at = _same(fit, parameters.select(*_GROUP, "start", "centre", "inverse"), _GROUP).select(*_GROUP, "start", *_X, *_E, _distance())
    # distances have few values on their grid, which bounds what a task holds
    limits = materialise(at.groupBy(*_GROUP, "start").agg(F.percentile("d", SUBSET).alias("limit")), f"limits-{label}")
    return _fitted(_same(at, limits, [*_GROUP, "start"]).where("d <= limit"), f"parameters-{label}")


def least_determinant(fit: DataFrame) -> DataFrame:
    """Parameters of each group's ``SUBSET`` of rows with the least determinant that a search finds.

    ``STARTS`` subsets by group take ``FIRST_STEPS`` concentration steps; the best ``FINALISTS`` go
    on until a step lessens the determinant no more, and the least of these is taken.
    Every step is over all rows. What the driver reads is whether any group goes on.
    """
    tried = _fitted(_first_subsets(fit), "starts")
    for k in range(FIRST_STEPS):
        tried = _concentrated(fit, tried, f"first-{k}")
    ranked = tried.groupBy(*_GROUP).agg(F.slice(F.sort_array(F.collect_list(F.struct(*_PARAMETERS))), 1, FINALISTS).alias("best"))
    active, ended, k = materialise(ranked.select(*_GROUP, F.inline("best")), "finalists"), [], 0
    while not active.isEmpty():
        step = _concentrated(fit, active, f"step-{k}")
        falls = F.col("logdet") < F.col("before") - LEAST_FALL
        both = _same(step, active.select(*_GROUP, "start", F.col("logdet").alias("before")), [*_GROUP, "start"]).where(falls).drop("before")
        going = materialise(both, f"going-{k}")
        kept = going.select(*_GROUP, "start", F.lit(True).alias("goes"))
        ended.append(_same(active, kept, [*_GROUP, "start"], "left").where("goes IS NULL").drop("goes"))
        active, k = going, k + 1
    found = active
    for table in ended:
        found = found.unionByName(table)
    best = found.groupBy(*_GROUP).agg(F.min(F.struct(*_PARAMETERS)).alias("best"))
    return materialise(best.select(*_GROUP, "best.*"), "best")


def _judge(batch: pa.RecordBatch, n_out: int) -> pa.RecordBatch:
    """The first ``n_out`` columns, the distance, and the feature that by itself is farthest off."""
    size, n = len(_X), batch.num_rows
    distance, far = np.full(n, np.nan), np.zeros(n, np.int64)
    known = np.flatnonzero(batch.column("centre").is_valid().to_numpy(zero_copy_only=False))
    if len(known):
        taken = batch.take(pa.array(known))
        numbers = lambda name: taken.column(name).to_numpy(zero_copy_only=False).astype(float)
        arrays = lambda name, *shape: taken.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, *shape)
        off = np.column_stack([numbers(x) for x in _X]) - arrays("centre", size)
        own = np.column_stack([_error(k, numbers("e0"), numbers("e1")) for k in range(size)])
        errors = np.maximum(own, arrays("error", size)) + 1 / 12
        spread = CONSISTENCY * arrays("spread", size, size) + errors[:, :, None] * np.eye(size)
        distance[known] = np.einsum("ij,ijk,ik->i", off, np.linalg.inv(spread), off)
        far[known] = (off**2 / np.diagonal(spread, axis1=1, axis2=2)).argmax(axis=1)
    unknown = np.isnan(distance)
    names = pa.array(np.array(FEATURES, object)[far], pa.string(), mask=unknown)
    columns = [*batch.columns[:n_out], pa.array(distance, mask=unknown), names]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:n_out], "distance", "far_in"])


def robust_outliers(statistics: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows with ``base_failed``, ``distance``, ``far_in`` and ``kept``; columns of these names are replaced.

    ``statistics`` has the counts of ``text_statistics``. Rows that pass the base rules are
    fitted by language and source (``least_determinant``), where a null is a group, and
    groups of fewer than ``LEAST_ROWS`` rows are fitted together by language. A row's covariance is
    that of its group's nearest rows, made consistent with a normal law, and in the
    diagonal the row's counting errors where they exceed its group's. Rows beyond the limit
    of the chi-square law are rejected; ``far_in`` names the feature that is farthest off
    by itself. Where a group's rows don't differ in a feature, errors of counting alone are the
    scale, so a few symbols or a repeated line reject nothing.

    Copies and ties count as often as they come, equal rows get equal verdicts, and an empty table
    gives no rows. Very long texts matter only in ``text_statistics``. Only sums and quantiles of
    groups are gathered. Other columns may have any names and are passed on.
    """
    rows = statistics.drop("base_failed", "distance", "far_in", "kept")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    names = ["_row", "base_failed"]
    groups = [F.col(lang).cast("string").alias("g_lang"), F.col(source).cast("string").alias("g_source")]
    counted = materialise(rows.select(F.struct("*").alias("_row"), failed.alias("base_failed"), *groups, *_features()), "features")
    counts = counted.where("NOT base_failed").groupBy(*_GROUP).agg((F.count(F.lit(1)) < LEAST_ROWS).alias("small"))
    pooled = F.when(~F.col("small"), F.concat(F.lit("="), F.coalesce(F.col("g_source"), F.lit("\0"))))
    grouped = materialise(_same(counted, counts, _GROUP, "left").withColumn("g_source", pooled).drop("small"), "groups")
    discard(counted)
    best = least_determinant(grouped.where("NOT base_failed").select(*_GROUP, *_X, *_E))
    parameters = best.select(*_GROUP, "centre", "spread", "error", F.lit(False).alias("fits"))
    judged = _same(grouped.withColumn("fits", F.col("base_failed")), parameters, [*_GROUP, "fits"], "left")
    kinds = grouped.select(*names).schema.add("distance", "double").add("far_in", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _judge(batch, len(names))

    found = judged.select(*names, *_X, *_E, "centre", "spread", "error").mapInArrow(run, kinds)
    return found.select("_row.*", *kinds.names[1:]).withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= CHI2_LIMIT))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = robust_outliers(text_statistics(read_table(spark, sf_dir, "documents")))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", F.round("distance", 6).alias("distance"), "far_in")
