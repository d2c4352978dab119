"""Text fields as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The texts that mean a missing value in CSV files.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"
)


def missing_to_null(column: Column) -> Column:
    return F.when(~column.isin(*MISSING), column)


def nan_to_null(column: Column) -> Column:
    """A null never passes a comparison, as NaN doesn't in numpy; Spark's NaN exceeds every number."""
    return F.when(~F.isnan(column), column)


def field(column: Column) -> Column:
    """Upper case without outer blanks; a null is empty."""
    return F.trim(F.upper(F.coalesce(column, F.lit(""))))


def callsign(column: Column) -> Column:
    """A real callsign, or null for a blank or a word for none."""
    kept = F.trim(column)
    return F.when(~F.lower(kept).isin("", "nan", "none"), kept)


def flag(column: Column) -> Column:
    """True for true and 1 in any spelling; all else, null too, is False."""
    return F.coalesce(F.lower(F.trim(column.cast("string"))).isin("true", "1", "1.0"), F.lit(False))


def spacing_tag(dt_s: float) -> str:
    """10 to 10s, 2.5 to 2p5s."""
    return f"{dt_s:g}".replace(".", "p") + "s"
