"""Column helpers: month key, sentinels, row fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sentinel for a missing string, marker for a failed lookup,
# fingerprint separator.
UNSPECIFIED = "UNSP"
TO_BE_DEFINED = "TBD"
FINGERPRINT_SEP = "||"


def month_key(date_text: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """``yyyyMM`` of a date held as text; NULL when the text is no date."""
    c = F.col(date_text) if isinstance(date_text, str) else date_text
    return F.date_format(F.try_to_date(c, fmt), "yyyyMM")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_sentinel(df: DataFrame, value: str = UNSPECIFIED) -> DataFrame:
    """NULL -> sentinel on string columns only (other types untouched)."""
    return df.fillna(value, subset=string_columns(df))


def lookup_marker(c: Column | str) -> Column:
    """Value a failed lookup leaves behind: the sentinel stays, all else TBD."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == UNSPECIFIED, F.lit(UNSPECIFIED)).otherwise(F.lit(TO_BE_DEFINED))


def fingerprint(cols: list[str]) -> Column:
    """SHA-256 hex of the columns cast to text and joined with ``||``.

    ``concat_ws`` skips NULLs, so fill sentinels first when NULL and an
    empty position must differ."""
    return F.sha2(F.concat_ws(FINGERPRINT_SEP, *[F.col(c).cast("string") for c in cols]), 256)
