"""Exact percentiles by counting: no task holds all values, and no sketch rounds them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins to a power of e, and the scale from which on they are logarithmic.
_BINS, _SCALE = 4096, 1000.0


def weighted_counts(rows: DataFrame, by: Sequence[str], channels: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``by``, ``channel``, ``value``, ``n``: for each value of each channel the sum of its weights; null values and weights are left out.

    One pass over the rows whatever the number of channels, with partial sums before the
    shuffle, which deals by value, so that no group is gathered.
    """
    return _entries(rows, by, channels).groupBy(*by, "channel", "value").agg(F.sum("n").alias("n"))


def _entries(rows: DataFrame, by: Sequence[str], channels: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``by``, ``channel``, ``value``, ``n``: a row for each channel that a row has."""
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), v.cast("double").alias("value"), w.cast("long").alias("n")) for c, (v, w) in channels.items()])
    kept = F.filter(entries, lambda x: x["value"].isNotNull() & x["n"].isNotNull())
    return rows.select(*by, F.explode(kept).alias("x")).select(*by, "x.channel", (F.col("x.value") + 0.0).alias("value"), "x.n")


def value_counts(rows: DataFrame, by: Sequence[str], channels: Mapping[str, Column]) -> DataFrame:
    """As above, where each row weighs one."""
    return weighted_counts(rows, by, {c: (v, F.lit(1)) for c, v in channels.items()})


def _bin(value: str = "value") -> Column:
    """A number that never falls where the value rises."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value) * _SCALE) * _BINS)


def at_ranks(rows: DataFrame, by: str, value: str, tie: str, wanted: Callable[[Column], Column]) -> DataFrame:
    """The rows of each group at the ranks that ``wanted`` gives for its size, from 0 on, by ``value`` and then ``tie``; with ``rank`` and ``total``.

    Rows are counted in bins of values, and only those of bins that hold a wanted rank are sorted.
    """
    binned = rows.withColumn("_bin", _bin(value))
    counts = binned.groupBy(by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(by).orderBy("_bin"))
    counts = counts.withColumns({"total": F.sum("_n").over(Window.partitionBy(by)), "_before": upto - F.col("_n")})
    counts = counts.withColumn("_wanted", F.filter(wanted(F.col("total")), lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n"))))
    held = counts.where(F.size("_wanted") > 0).select(F.col(by).alias("_by"), F.col("_bin").alias("_of"), "_before", "total", "_wanted")
    near = binned.join(held, F.col(by).eqNullSafe(F.col("_by")) & F.col("_bin").eqNullSafe(F.col("_of")))
    order = Window.partitionBy(by, "_bin").orderBy(value, tie)
    ranked = near.withColumn("rank", F.col("_before") + F.row_number().over(order) - 1).where(F.array_contains("_wanted", F.col("rank")))
    return ranked.select(*rows.columns, "rank", "total")


def percentiles(counts: DataFrame, by: Sequence[str], wanted: Mapping[str, Sequence[float]]) -> DataFrame:
    """``by``, ``channel``, ``p``, ``x``: percentiles of ``value_counts``, between neighbours by linear interpolation.

    Values are counted in bins, whose number doesn't grow with the rows; running sums
    over a group's bins tell those that hold the wanted ranks, and only the values in
    these are sorted. The shuffle of ``counts`` serves both.
    """
    keys = [*by, "channel"]
    # no condition here that could sink below the counts' shuffle, or it would be done once for each use
    binned = counts.withColumn("bin", _bin())
    return _at_ranks_of(binned, keys, _holding(binned.groupBy(*keys, "bin").agg(F.sum("n").alias("n")), keys, wanted))


def selected(rows: DataFrame, by: Sequence[str], channels: Mapping[str, Column], wanted: Mapping[str, Sequence[float]]) -> DataFrame:
    """The same from the rows themselves, in two reads: what is shuffled are counts of bins, and then the values of the few bins that hold a rank."""
    keys = [*by, "channel"]
    entries = _entries(rows, by, {c: (v, F.lit(1)) for c, v in channels.items()}).withColumn("bin", _bin())
    held = _holding(entries.groupBy(*keys, "bin").agg(F.sum("n").alias("n")), keys, wanted)
    same = F.col("bin").eqNullSafe(F.col("_bin"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    near = entries.join(held.select(*[f"_{k}" for k in keys], "_bin").distinct(), same, "left_semi")
    return _at_ranks_of(near.groupBy(*keys, "bin", "value").agg(F.sum("n").alias("n")), keys, held)


def _holding(bins: DataFrame, keys: list[str], wanted: Mapping[str, Sequence[float]]) -> DataFrame:
    """Of counts by ``bin``, those that hold a wanted rank: ``_<key>``, ``_bin``, ``p``, ``at``, ``before``."""
    asked = F.lit(None).cast("array<double>")
    for channel, ps in wanted.items():
        asked = F.when(F.col("channel") == channel, F.array(*[F.lit(float(p)) for p in ps])).otherwise(asked)
    order = Window.partitionBy(*keys).orderBy("bin")
    bins = bins.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy(*keys))}).withColumn("p", F.explode(asked))
    bins = bins.withColumn("at", (F.col("total") - 1) * F.col("p"))
    held = bins.where((F.col("upto") > F.floor("at")) & (F.col("upto") - F.col("n") <= F.ceil("at")))
    # one bin for most wanted ranks, two where its neighbours lie in two
    return held.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bin").alias("_bin"), "p", "at", (F.col("upto") - F.col("n")).alias("before"))


def _at_ranks_of(binned: DataFrame, keys: list[str], held: DataFrame) -> DataFrame:
    """The values at the ranks of ``held``, from counts of values with their bins."""
    same = F.col("bin").eqNullSafe(F.col("_bin"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    near = binned.join(held, same).select(*keys, "p", "at", "bin", "before", "value", "n")
    inside = Window.partitionBy(*keys, "p", "bin").orderBy("value")
    ranked = near.withColumn("upto", F.col("before") + F.sum("n").over(inside))
    has = lambda rank: (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
    low, high = F.floor("at"), F.ceil("at")
    found = ranked.groupBy(*keys, "p", "at").agg(F.max(F.when(has(low), F.col("value"))).alias("a"), F.max(F.when(has(high), F.col("value"))).alias("b"))
    between = F.when(low == high, F.col("a")).otherwise((high - F.col("at")) * F.col("a") + (F.col("at") - low) * F.col("b"))
    return found.select(*keys, "p", between.alias("x"))


def medians(rows: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``median``; no row where there is no value."""
    found = selected(rows, by, {"value": value}, {"value": (0.5,)})
    return found.select(*by, F.col("x").alias("median"))


def beside(first: DataFrame, *others: DataFrame, on: str = "date") -> DataFrame:
    """Tables of one row a day side by side; 0 where a later one lacks a day.

    Null days meet too, and no condition on the day sinks below shuffles that are shared.
    """
    for other in others:
        first = first.join(other.withColumnRenamed(on, "_on"), F.col(on).eqNullSafe(F.col("_on")), "left").drop("_on")
    return first.fillna(0)
