"""Exact deduplication by deterministic block naming, with DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import ascii_lower, materialise, read_table

#: Bytes of a block. Most texts fit one; a text of n bytes takes log2(n / BLOCK_BYTES) rounds of pair naming.
BLOCK_BYTES = 8192


def _blocks(text_bytes: str, block_bytes: int) -> str:
    """SQL for the array of fixed-size blocks of a binary column; an empty text has one empty block."""
    last = f"greatest(0, cast((octet_length({text_bytes}) - 1) div {block_bytes} as int))"
    return f"transform(sequence(0, {last}), p -> substring({text_bytes}, p * {block_bytes} + 1, {block_bytes}))"


def _address(block: str, seed: int) -> str:
    """SQL for two 64-bit hashes, by which a block's name is looked up."""
    return f"named_struct('h1', xxhash64({2 * seed}, {block}), 'h2', xxhash64({2 * seed + 1}, {block}))"


def _name_sorted(distinct: DataFrame, key: list[str]) -> DataFrame:
    """Integer names: rows of each partition sorted by their bytes and numbered."""
    return distinct.sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(texts: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """A name for each distinct block, and the seed of the addresses under which the names stand.

    Blocks are made distinct and sorted by their bytes, so that two blocks have one
    name only if they are equal. Names are looked up by address; that no two distinct
    blocks share an address is checked over all of them, and if two did, another seed
    would be taken. So no identity rests on a hash being free of collisions.
    """
    blocks = texts.select(F.explode(F.expr(_blocks("_bytes", block_bytes))).alias("block"))
    seed = 0
    while True:
        rows = blocks.select(F.expr(_address("block", seed)).alias("at"), "block").select("at.h1", "at.h2", "block")
        names = materialise(_name_sorted(rows.distinct(), ["block"]).select("h1", "h2", "name"), "block-names")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            return names, seed
        seed += 1


def block_identities(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, carry: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``n_blocks``, ``name``, and the columns of ``carry``.

    Two rows have the same (``n_blocks``, ``name``) exactly if their texts are equal.
    ``text`` is a string column without nulls; ``carry`` maps names to expressions over
    ``docs`` that are wanted beside the identity. Names of adjacent blocks are paired
    and named anew, level by level, until one name is left of each text; an odd block
    at the end is paired with -1, which is no name. Texts with the same number of
    blocks finish at the same level, whose names are one namespace.
    """
    texts = docs.select(F.col(text).cast("binary").alias("_bytes"))
    names, seed = _name_blocks(texts, block_bytes)
    addresses = f"transform({_blocks('_bytes', block_bytes)}, b -> {_address('b', seed)})"
    carried = list(carry or {})
    rows = materialise(
        docs.select(F.col(text).cast("binary").alias("_bytes"), *[e.alias(c) for c, e in (carry or {}).items()])
        .select(F.monotonically_increasing_id().alias("row"), F.expr(addresses).alias("at"), *carried)
        .select("row", F.size("at").alias("n_blocks"), "at", *carried),
        "rows",
    )
    named = rows.select("row", "n_blocks", F.posexplode("at").alias("pos", "at")).select("row", "n_blocks", "pos", "at.h1", "at.h2")
    named = named.join(names, ["h1", "h2"]).select("row", "n_blocks", "pos", "name")
    longest = rows.agg(F.max("n_blocks")).first()[0] or 1
    finished = [named.where("n_blocks = 1").select("row", "name")]
    left, level = named.where("n_blocks > 1").withColumn("left", F.col("n_blocks")), 0
    while longest > 1:
        longest, level = (longest + 1) // 2, level + 1
        pairs = left.groupBy("row", (F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"),
            F.max(F.expr("(left + 1) div 2").cast("int")).alias("left"),
        )
        pairs = materialise(pairs, f"pairs-{level}")
        pair_names = materialise(_name_sorted(pairs.select("first", "second").distinct(), ["first", "second"]), f"names-{level}")
        named = pairs.join(pair_names, ["first", "second"]).select("row", "pos", "name", "left")
        finished.append(named.where("left = 1").select("row", "name"))
        left = named.where("left > 1")
    roots = reduce(DataFrame.union, finished)
    return rows.select("row", "n_blocks", *carried).join(roots, "row")


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Groups of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256``, a row for each input row.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty.
    Of each group the row with the largest id stays; a null id ranks below all others.
    Rows repeated with the same id count separately in ``group_size`` and exactly one of
    them is kept. A text of any length is named by its blocks. An empty table gives an
    empty result. Further columns of ``docs`` are not read, whatever their names.
    """
    source = docs.select(F.col(id_col).alias("_id"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    found = block_identities(
        source, "_text", block_bytes, {"_id": F.col("_id"), "_sha": F.unhex(F.sha2(F.col("_text").cast("binary"), 256))}
    )
    found = materialise(found, "identities")
    groups = found.groupBy("n_blocks", "name").agg(
        F.max(F.struct("_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size")
    )
    groups = materialise(
        groups.where("group_size > 1").select(
            "n_blocks", "name", "group_size", F.col("top._id").alias("keep_id"), F.col("top.row").alias("keep_row")
        ),
        "groups",
    )
    return found.join(groups, ["n_blocks", "name"], "left").select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("keep_row").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n
  FROM documents
), g AS (
  SELECT n, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n
)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size, t.doc_id = g.keep_id AS kept, sha256(t.n) AS text_sha256
FROM t JOIN g ON t.n = g.n
"""
