"""Classification of a registry by rules."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.text import field
from driftline.operators.rules import HEX_ID, MILITARY, NEVER, RULES, TYPE_CODE, Rule
from driftline.sources.tables import require

COLUMNS = ("manufacturername", "model", "icaoaircrafttype", "icao24")


def _found(pattern: str, column: str = "_model") -> Column:
    return F.col(column).rlike(pattern) if pattern else F.lit(False)


def flags(registry: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with ``is_base``, ``is_strict`` (excluded), ``is_hex`` and ``is_kept``; each brand's pattern runs once a row."""
    require(registry.columns, *COLUMNS)
    fields = registry.withColumns({"_maker": field(F.col("manufacturername")), "_model": field(F.col("model")), "_type": field(F.col("icaoaircrafttype"))})
    branded = fields.withColumns({f"_{r.name}": _found(r.brand, "_maker") for r in rules})
    own = {r.name: F.col(f"_{r.name}") for r in rules}
    base = reduce(or_, [own[r.name] & _found(r.keep) & ~_found(r.drop) for r in rules]) & ~_found(NEVER)
    trusted = reduce(or_, [own[r.name] & _found(r.trusted) for r in rules if r.trusted])
    large = reduce(or_, [own[r.name] & _found(r.too_large) for r in rules if r.too_large])
    strict = _found(MILITARY) | (_found(TYPE_CODE, "_type") & ~trusted) | large
    out = branded.withColumns({"is_base": base, "is_strict": strict, "is_hex": F.trim(F.coalesce("icao24", F.lit(""))).rlike(HEX_ID)})
    return out.withColumn("is_kept", F.col("is_base") & ~F.col("is_strict") & F.col("is_hex")).select(*registry.columns, "is_base", "is_strict", "is_hex", "is_kept")


def whitelist(registry: DataFrame) -> DataFrame:
    """The registry rows of conventional light aircraft, with all their columns."""
    return flags(registry).where("is_kept").select(*registry.columns)


def funnel(registry: DataFrame) -> DataFrame:
    """One row: how many rows each step leaves or removes."""
    return flags(registry).agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if("is_base").alias("rows_base_match"),
        F.count_if(F.col("is_base") & F.col("is_strict")).alias("rows_removed_strict"),
        F.count_if(F.col("is_base") & ~F.col("is_strict") & ~F.col("is_hex")).alias("rows_removed_bad_icao24"),
        F.count_if("is_kept").alias("rows_kept"),
    )
