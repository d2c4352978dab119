"""Importance resampling towards a target: bucket arrays of n-grams, a gain for each bucket, Gumbel top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import ascii_lower, discard, materialise, read_table

#: Words: runs of digits, lower-case letters and everything beyond ASCII.
FEATURE_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10


def _runs(words: str, n: int) -> str:
    """SQL for all runs of ``n`` words, joined by one space."""
    if n == 1:
        return words
    return f"transform(sequence(1, greatest(size({words}) - {n - 1}, 0), 1), k -> array_join(slice({words}, k, {n}), ' '))"


def bucket_arrays(docs: DataFrame, text: str = "text", carry: tuple[Column, ...] = (), n_grams: tuple[int, int] = (1, 1), buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``carry``, ``n_words``, and ``buckets``: the bucket of each run of words of each text, repeats included.

    All by higher-order functions over the text's own array, a row in and a row out. A
    null text has no words.
    """
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(FEATURE_WORDS), F.lit(0))
    split = docs.select(*carry, words.alias("_words"))
    few = "CASE WHEN size(_words) < {n} THEN array() ELSE {runs} END"
    parts = [_runs("_words", n) if n == 1 else few.format(n=n, runs=_runs("_words", n)) for n in range(n_grams[0], n_grams[1] + 1)]
    runs = parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"
    hashed = F.expr(f"transform({runs}, w -> cast(crc32(cast(w AS BINARY)) % {buckets} AS INT))")
    return split.select(*split.columns[:-1], F.size("_words").cast("long").alias("n_words"), hashed.alias("buckets"))


def bucket_counts(rows: DataFrame) -> DataFrame:
    """``bucket, n`` over all rows; each task sends a row for each bucket at most."""
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For each bucket the logarithm of how much likelier the target has it, in thousandths; a table of ``buckets`` rows, whatever the corpus."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    found = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    whole = Window.partitionBy()  # ``buckets`` rows
    totals = found.withColumns({"all_s": F.sum("s").over(whole), "all_t": F.sum("t").over(whole)})
    d = lambda c, more: F.col(c).cast("double") + F.lit(float(more))
    gain = F.floor(1000 * F.ln(d("t", 1) * d("all_s", buckets) / (d("s", 1) * d("all_t", buckets))))
    return [r.gain for r in totals.select("bucket", gain.alias("gain")).orderBy("bucket").collect()]


def _floored_mean(total: Column, n: Column) -> Column:
    """``total / n`` rounded down, 0 where ``n`` is; in whole numbers."""
    return F.when(n > 0, F.call_function("div", total - F.pmod(total, n), n)).otherwise(F.lit(0).cast("long"))


def weights(rows: DataFrame, gain: list[int]) -> DataFrame:
    """The rows of ``bucket_arrays`` with ``n_features`` and ``weight``, the floored mean of their buckets' gains.

    The gains are one literal array of the plan (a constant is folded into it once), so a
    row is scored where it stands: nothing is exploded, joined or shuffled.
    """
    literal = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda acc, b: acc + F.element_at(literal, b + 1))
    n = F.size("buckets").cast("long")
    return rows.withColumns({"n_features": n, "weight": _floored_mean(total, n)}).drop("buckets")


def gumbel(id_col: str, seed: int = SEED) -> Column:
    """Seeded noise of a row, in thousandths: the same in every run. A null id counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def _rank_top(rows: DataFrame, most: int) -> DataFrame:
    """The rows with ``rank``, from 1 on by falling ``score``, rising ``doc_id``; null beyond ``most``.

    Rows are counted by score, of which there are some ten thousand at any size; running
    sums tell the score that the last drawn row has. Only rows of that score or better
    are sorted, by ranges of score and id, so no task holds a score's rows, and a row's
    rank is its place in its range and the sizes of the ranges before.
    """
    able = F.col("eligible")
    by_score = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy().orderBy(F.col("score").desc()))
    last = by_score.withColumn("before", upto - F.col("n")).where(F.col("before") < most).agg(F.min("score")).first()[0]
    none = F.lit(None).cast("long")
    if last is None:
        return rows.withColumn("rank", none)
    inside = able & (F.col("score") >= last)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.col("weight")]
    dealt = rows.where(inside).repartitionByRange(*order).sortWithinPartitions(*order)
    # the number of the partition and, in its lower 33 bits, that of the row in it
    placed = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy().orderBy("_part")) - F.col("_n")  # a row for each partition
    ranked = placed.join(sizes.select("_part", before.alias("_before")), part == F.col("_part"))
    rank = F.col("_before") + nth + 1
    ranked = ranked.select(*rows.columns, F.when(rank <= most, rank).alias("rank"))
    return ranked.union(rows.where(~inside).withColumn("rank", none))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, n_grams: tuple[int, int] = (1, 1), buckets: int = BUCKETS,
    seed: int = SEED, least_words: int = LEAST_WORDS, text: str = "text", id_col: str = "doc_id", target_text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for each row of ``docs``, drawn towards the texts of ``target``.

    A feature is a run of ``n_grams`` words, a bucket its CRC-32; a document's weight is
    the floored mean of its buckets' gains. Of the documents with ``least_words`` words or
    more the given percentage with the highest weight plus Gumbel noise is drawn, which
    is sampling without replacement in proportion to the exponentials of the weights.

    Null and empty texts have no features and weight 0. A null id is noise of an empty
    text and comes first among ties. Rows that share an id have one noise; of those equal
    in score the one of fewer features ranks first, and rows equal in all take
    neighbouring ranks. An empty corpus gives no rows, an empty target is even over
    the buckets. A text of any length is one row, its array in memory. Other columns are
    not read, whatever their names.
    """
    rows = materialise(bucket_arrays(docs, text, (F.col(id_col).alias("doc_id"),), n_grams, buckets), "buckets")
    wanted = bucket_counts(bucket_arrays(target, target_text, (), n_grams, buckets))
    gain = gains(bucket_counts(rows), wanted, buckets)
    scored = weights(rows, gain).select("doc_id", "n_features", "weight", (F.col("weight") + gumbel("doc_id", seed)).alias("score"), (F.col("n_words") >= least_words).alias("eligible"))
    scored = materialise(scored, "scores")
    discard(rows)
    n = scored.where("eligible").count()
    return _rank_top(scored, percent * n // 100).drop("eligible")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _crc_step(value: str) -> str:
    return f"(CASE WHEN {value} & 1 = 1 THEN xor({value} >> 1, 3988292384) ELSE {value} >> 1 END)"


#: The polynomial's table for CRC-32 is made from its rule, eight steps a byte.
OP12_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT range AS byte, CAST(range AS BIGINT) AS v, 0 AS k FROM range(256)
  UNION ALL SELECT byte, {_crc_step("v")}, k + 1 FROM steps WHERE k < 8
), tab AS (
  SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), vocabulary AS (
  SELECT DISTINCT w FROM (SELECT unnest(ws) AS w FROM d UNION ALL SELECT unnest(ws) FROM b)
), bytes AS (
  SELECT w, list_transform(range(1, octet_length(encode(w)) + 1), lambda k: CAST('0x' || hex(encode(w))[2 * k - 1:2 * k] AS BIGINT)) AS xs FROM vocabulary
), hashed AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), xs), lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295) % {BUCKETS} AS bucket FROM bytes, tab
), dw AS (
  SELECT doc_id, unnest(ws) AS w FROM d
), s AS (
  SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM (SELECT unnest(ws) AS w FROM b) JOIN hashed USING (w) GROUP BY bucket
), g AS (
  SELECT range AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT sum(n) FROM s) + {BUCKETS}.0::DOUBLE)
    / ((coalesce(s.n, 0) + 1.0::DOUBLE) * (coalesce((SELECT sum(n) FROM t), 0) + {BUCKETS}.0::DOUBLE)))) AS BIGINT) AS gain
  FROM range({BUCKETS}) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range
), of_doc AS (
  SELECT doc_id, sum(gain) AS total FROM dw JOIN hashed USING (w) JOIN g USING (bucket) GROUP BY doc_id
), weighed AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_features,
    CASE WHEN len(ws) = 0 THEN 0 ELSE CAST((total - ((total % len(ws)) + len(ws)) % len(ws)) // len(ws) AS BIGINT) END AS weight
  FROM d LEFT JOIN of_doc ON d.doc_id = of_doc.doc_id
), scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM weighed
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= {LEAST_WORDS}
)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT {PERCENT} * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked ON scored.doc_id = ranked.doc_id
"""
