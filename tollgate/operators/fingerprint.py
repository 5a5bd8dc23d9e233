"""Row fingerprints and fingerprint joins.

A fingerprint is the SHA-256 of all columns as text joined by ``||``.  It
identifies a row by content, so two frames can be matched without a key.
The joins shuffle on the 64-character hash, which spreads evenly; a run of
identical rows shares one hash, and AQE's skew handling splits that
partition of the probing side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.columns import fingerprint

HASH = "row_hash"


def with_fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.withColumn(HASH, fingerprint(cols or df.columns))


def fingerprint_anti(source: DataFrame, remove: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows of ``source`` whose fingerprint does not occur in ``remove``
    (both fingerprinted over ``cols``, default the source columns)."""
    cols = cols or source.columns
    drop = with_fingerprint(remove, cols).select(HASH).distinct()
    return with_fingerprint(source, cols).join(drop, HASH, "left_anti").drop(HASH)


def overlay_by_fingerprint(source: DataFrame, marked: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace rows of ``source`` by their marked version where one exists.

    ``marked`` holds rows *as they were* (for the fingerprint, in
    ``_orig`` form: column ``row_hash`` already computed on the original
    values) plus replacement values; a marked value wins, else the original
    (``coalesce``).  Of several marked rows per fingerprint the greatest as a
    whole stays, so the survivor is a row that existed and does not depend on
    task order.
    """
    cols = cols or source.columns
    rep = marked.groupBy(HASH).agg(F.max(F.struct(*cols)).alias("_tg_marked"))
    joined = with_fingerprint(source, cols).join(rep, HASH, "left")
    return joined.select(*[F.coalesce(F.col("_tg_marked")[c], F.col(c)).alias(c) for c in cols])
