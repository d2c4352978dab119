"""Position reports of whitelisted aircraft."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.sources.folders import written

#: A whitelist of up to so many keys is sent to all tasks; a registry of all aircraft has some hundred thousand.
BROADCAST_KEYS = 2_000_000


def normal_id(column: str = "icao24") -> Column:
    return F.lower(F.trim(F.col(column)))


def whitelist_keys(registry: DataFrame) -> DataFrame:
    """Distinct keys in lower case; blanks and nulls are none."""
    return registry.select(normal_id().alias("icao24")).where("icao24 <> ''").distinct()


#: Bits of the filter for each key, up to a filter of 32 MB; a filter's blocks of 32,768 bits are rows of a small table.
_BITS_PER_KEY, _MOST_BITS, _BLOCK = 16, 1 << 28, 1 << 15


def _bits(key: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a key, and its two bits there."""
    h = F.xxhash64(key)
    return F.pmod(h, F.lit(blocks)).cast("int"), F.array(*[F.pmod(F.xxhash64(F.lit(k), key), F.lit(_BLOCK)).cast("int") for k in (1, 2)])


def key_filter(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """A Bloom filter of the keys: rows ``block, bitmap`` of 4 KB each, and how many blocks there may be."""
    blocks = max(1, min(_MOST_BITS, n * _BITS_PER_KEY) // _BLOCK)
    block, bits = _bits(F.col("icao24"), blocks)
    each = keys.select(block.alias("block"), F.explode(bits).alias("bit"))
    return each.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bitmap")), blocks


def passing(states: DataFrame, found: tuple[DataFrame, int]) -> DataFrame:
    """The reports whose id the filter has, and one in a hundred or so of the others; nothing is shuffled."""
    table, blocks = found
    block, bits = _bits(normal_id(), blocks)
    marked = states.withColumns({"_block": block, "_bits": bits})
    joined = marked.join(F.broadcast(table.withColumnRenamed("block", "_of")), F.col("_block") == F.col("_of"))  # 32 MB at most
    byte = lambda bit: F.conv(F.hex(F.substring("bitmap", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    has = lambda k: F.call_function("shiftright", byte(F.col("_bits")[k]), F.col("_bits")[k].bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1
    return joined.where(has(0) & has(1)).select(*states.columns)


def of_whitelist(states: DataFrame, keys: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """The reports whose id is on the whitelist, ids as they were.

    The keys are written and counted at once. Up to ``most`` of them are sent to all
    tasks. Beyond that both sides are shuffled and skewed keys split; a filter of bounded
    size keeps nearly all reports that aren't on the list out of the shuffle.
    """
    keys = written(keys.select("icao24"), "keys")
    n = keys.count()
    listed = keys.select(F.col("icao24").alias("_key"))
    if n <= most:
        return states.join(F.broadcast(listed), normal_id() == F.col("_key"), "left_semi")
    return passing(states, key_filter(keys, n)).join(listed.hint("merge"), normal_id() == F.col("_key"), "left_semi")


def day_summary(states: DataFrame) -> DataFrame:
    """Reports and distinct aircraft for each day."""
    return states.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(normal_id()).alias("aircraft"))
