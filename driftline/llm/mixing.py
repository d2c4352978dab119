"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import WORD_PATTERN, materialise, read_table

#: Weights of the sources in order, over and over.
WEIGHTS = (5, 2, 1)
#: No source, and so no document, is taken more often.
MOST_REPEATS = 3
#: Words of a block. Blocks cut through documents, so a mix can meet its targets closely.
BLOCK_WORDS = 16
#: Words of a shard, about; a source with more has more shards, so no window over one grows with the corpus.
SHARD_WORDS = 1 << 18
#: Shards whose quotas are found together: a source's blocks go to groups of so many shards, then to the shards of each group.
GROUP_SHARDS = 10_000
SEED = 20240501


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size, target`` for each source.

    Sources take the weights by code point, null last. All sizes together are shared by
    weight; a target stops at ``most_repeats`` times its source's size and the excess is
    shared by weight among the rest until none is above. So the sources whose limit is
    small for their weight stand at it, and the rest have one ratio of target to weight.
    Sorted by limit over weight, those at their limit come first: one running sum finds
    them. The windows here see one row for each source, not the documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ranked = totals.select("source", "source_size", weight.cast("double").alias("weight"))
    limit = F.col("source_size") * float(most_repeats)
    tie = [F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*tie).rowsBetween(0, Window.unboundedFollowing)
    shared = ranked.withColumn("limit", limit).withColumn(
        "ratio",  # if all before stand at their limit and this one and those after share what is left
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    )
    free = F.max(F.when(F.col("ratio") * F.col("weight") <= F.col("limit"), F.col("ratio"))).over(Window.partitionBy())
    return shared.select("source", "source_size", F.least("limit", F.coalesce(free * F.col("weight"), F.col("limit"))).alias("target"))


def apportion(weights: np.ndarray, seats: int) -> np.ndarray:
    """Integer seats by highest quotients weight / 1, / 3, / 5 and so on; among equal quotients the first weight wins.

    A party has floor(weight / d + 1/2) seats if all quotients over 2 / d are seated. The
    divisor is searched for that seats no more than there are, then the highest
    quotients take the few that are left.
    """
    weights = np.maximum(np.asarray(weights, float), 0)
    found = np.zeros(len(weights), np.int64)
    if seats <= 0 or weights.sum() <= 0:
        return found
    seated = lambda d: np.floor(weights / d + 0.5).astype(np.int64)
    low, high = weights.sum() / (seats + len(weights) + 1) / 2, weights.sum() * 4
    while seated(low).sum() <= seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if seated(middle).sum() <= seats else (middle, high)
    found = seated(high)
    for _ in range(seats - int(found.sum())):
        found[np.argmax(weights / (2 * found + 1))] += 1
    return found


def _source_quotas(seats: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = pd.concat(list(batches))
        if len(table):
            table = table.sort_values("source", na_position="last", kind="stable")
            yield table.assign(quota=apportion(table["target"].to_numpy(), seats))[["source", "source_size", "target", "quota"]]

    return run


def _shared_out(key: str):
    """Deal the ``quota`` that all rows of a table have to them by ``length``, in the order of ``key``, into ``part``."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(key, kind="stable")
        # no row takes more than MOST_REPEATS times its blocks: what is above goes to the others
        weights, left, part = table["length"].to_numpy(float), int(table["quota"].iloc[0]), np.zeros(len(table), np.int64)
        most = MOST_REPEATS * table["blocks"].to_numpy()
        while left > 0 and (weights > 0).any():
            part = np.minimum(part + apportion(weights, left), most)
            left, weights = int(table["quota"].iloc[0]) - int(part.sum()), np.where(part < most, weights, 0)
        return table.assign(part=part)

    return run


def coprime_step(start: int, blocks: int) -> int:
    """The first number from ``start`` on that has no factor in common with ``blocks``, so that multiples of it meet every block."""
    step = start % blocks or 1
    while math.gcd(step, blocks) > 1:
        step += 1
    return step


def _with_steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``step`` and ``shift`` of each shard's permutation of its block numbers: k goes to (k * step + shift) mod blocks."""
    for table in batches:
        yield table.assign(step=[coprime_step(a, b) for a, b in zip(table["step"], table["blocks"])])


def _shards(sizes: DataFrame, seed: int, block_words: int, shard_words: int) -> tuple[DataFrame, DataFrame]:
    """``tape``: each row with its shard and the place of its first word in it; ``quotas``: blocks that each shard gives."""
    total = sizes.agg(F.sum("size")).first()[0] or 0
    by_source = source_targets(sizes).repartition(1).mapInPandas(
        _source_quotas(round(total / block_words)), "source string, source_size long, target double, quota long"
    )
    by_source = materialise(by_source, "source-quotas").withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    shards = F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / F.lit(shard_words))
    dealt = sizes.join(by_source.select("_source", shards.alias("shards")), same)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "digest"), "shards")).drop("_source", "shards")
    at = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), "doc_id", "digest"), "doc_id", "digest", "size")
    start = F.coalesce(F.sum("size").over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tape = materialise(dealt.withColumn("start", start), "tape")
    lengths = tape.groupBy("source", "shard").agg(F.sum("size").alias("length"))
    blocks = F.greatest(F.round(F.col("length") / F.lit(block_words)).cast("long"), F.lit(1))
    lengths = materialise(lengths.select("source", "shard", F.floor(F.col("shard") / GROUP_SHARDS).alias("group"), "length", blocks.alias("blocks")), "lengths")
    groups = lengths.groupBy("source", "group").agg(F.sum("length").alias("length"), F.sum("blocks").alias("blocks"))
    groups = groups.join(by_source, same).drop("_source", "source_size", "target")
    groups = groups.groupBy("source").applyInPandas(_shared_out("group"), "source string, group long, length long, blocks long, quota long, part long")
    groups = materialise(groups.select("source", "group", F.col("part").alias("quota")), "group-quotas")
    of_group = F.struct("source", "group").eqNullSafe(F.struct("_source", "_group"))
    shares = lengths.join(groups.withColumnsRenamed({"source": "_source", "group": "_group"}), of_group).drop("_source", "_group")
    shares = shares.groupBy("source", "group").applyInPandas(
        _shared_out("shard"), "source string, shard long, group long, length long, blocks long, quota long, part long"
    )
    steps = shares.select("source", "shard", "length", "blocks", F.col("part").alias("quota"), F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), "blocks").alias("step"))
    steps = steps.mapInPandas(_with_steps, "source string, shard long, length long, blocks long, quota long, step long")
    quotas = steps.join(by_source.select("_source", "source_size", "target"), same).drop("_source")
    return tape, materialise(quotas, "shard-quotas").withColumnsRenamed({"source": "_source", "shard": "_shard"})


def _taken(docs: DataFrame, text: str, id_col: str, source: str, seed: int, block_words: int, shard_words: int) -> DataFrame:
    """``doc_id, source, digest, size, shard, source_size, target, taken`` for each row."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"), text_digest(text, seed).alias("digest"), words.alias("size"))
    tape, quotas = _shards(materialise(sizes, "sizes"), seed, block_words, shard_words)
    found = tape.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    # block k is the words [k * length div blocks, (k + 1) * length div blocks) of the tape; a word w of it has
    # k = (w * blocks + blocks - 1) div length at most, and the permutation is k -> (k * step + shift) mod blocks
    shift = f"pmod(xxhash64({seed + 2}, _source, _shard), blocks)"
    words = "greatest(0, least(start + size, ((k + 1) * length) div blocks) - greatest(start, (k * length) div blocks))"
    chosen = f"(CASE WHEN pmod(k * step + {shift}, blocks) < quota % blocks THEN 1 ELSE 0 END)"
    blocks = "sequence((start * blocks) div length, least(blocks - 1, ((start + size) * blocks) div length))"
    taken = f"CASE WHEN size = 0 THEN 0L ELSE size * (quota div blocks) + aggregate({blocks}, 0L, (a, k) -> a + {words} * {chosen}) END"
    return found.select("doc_id", "source", "digest", "size", "shard", "source_size", "target", F.expr(taken).alias("taken"))


def mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row.

    The documents of a source are dealt to shards by a hash of id and text, and in each
    shard they form a tape in the order of a seeded hash, cut into blocks of equal length
    to one word. Blocks are apportioned to the sources by their targets, then to groups
    of shards by their length, then to the shards of a group. A shard with b blocks and
    quota q takes every block q div b times and q mod b of them once more, chosen by a
    seeded permutation of their numbers. ``taken`` adds up the words of a document that
    lie in taken blocks, repeats counted, so it is at most ``MOST_REPEATS`` times the
    size, and reruns agree.

    Null texts have no words; a null source is a source of its own, last in order;
    repeated rows and null ids are rows like any other; an empty table gives no rows. A
    text of any length lies in as many blocks as it fills. Other columns are not read.
    """
    return _taken(docs, text, id_col, source, seed, block_words, shard_words).select("doc_id", "size", "source_size", "target", "taken")


def whole_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", seed: int = SEED, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, digest, copies``: how often a mix of whole documents has each; ``digest`` is ``text_digest`` of the text.

    Within a shard, by ascending size, the shares of documents that the mix takes are
    added up, and a document has as many copies as whole numbers its share steps over.
    Sums of copies and of shares so never differ by one or more, and a shard's words
    differ from what the mix takes by less than two of its longest documents. A text
    without words, which no mix takes, stays once. Rows equal in id and text are one.
    """
    found = _taken(docs, text, id_col, source, seed, BLOCK_WORDS, shard_words).where("size > 0")
    order = Window.partitionBy("source", "shard").orderBy("size", F.xxhash64(F.lit(seed + 3), "doc_id", "digest"), "doc_id", "digest", "taken")
    # shares in units of 2^-20: sums of whole numbers don't depend on their order
    share = F.round(F.col("taken") / F.col("size") * F.lit(1 << 20)).cast("long")
    offset = F.pmod(F.xxhash64(F.lit(seed + 4), "source", "shard"), F.lit(1 << 20))
    sums = found.select("doc_id", "digest", "source", "shard", share.alias("share"), (F.sum(share).over(order) + offset).alias("upto"))
    copies = sums.select("doc_id", "digest", F.expr("(upto div 1048576) - ((upto - share) div 1048576)").alias("copies"))
    return copies.groupBy("doc_id", "digest").agg(F.max("copies").alias("copies"))


def text_digest(text: str = "text", seed: int = SEED):
    return F.xxhash64(F.lit(seed), F.col(text))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
