"""Latest file version per month and the months a reload touches.

Extract file names embed ``yyyymmdd_hhmmss``, so the lexicographically
greatest name of a month is its newest delivery.  The newest file wins per
*whole month*; an older file still supplies months the newer one lacks.

The per-month table is an aggregate with one row per month.  Where the
caller derived the month with ``with_month`` it has at most 12 x 9999 keys
(``month_domain=True``) and is joined back by broadcast: the fact side is
never shuffled, and a month holding a third of all rows costs nothing extra.
For any other month column the join carries no hint.  The alternative
``max(file) OVER (PARTITION BY month)`` would sort every row of a hot month
inside one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.columns import month_key

MONTH = "posting_month"
FILE = "file_name"


def with_month(df: DataFrame, date_col: str = "posting_date", out: str = MONTH,
               fmt: str = "yyyyMMdd") -> DataFrame:
    return df.withColumn(out, month_key(date_col, fmt))


def latest_file_per_month(df: DataFrame, month_col: str = MONTH, file_col: str = FILE) -> DataFrame:
    """(month, latest file) — partial aggregation before the shuffle."""
    return df.groupBy(month_col).agg(F.max(file_col).alias(file_col))


def latest_version(df: DataFrame, month_col: str = MONTH, file_col: str = FILE,
                   month_domain: bool = False) -> DataFrame:
    """Rows of the newest file of their month.  Rows whose month is NULL
    drop out (NULL never equals NULL in the join).  ``month_domain`` states
    that ``month_col`` comes from ``with_month``."""
    latest = latest_file_per_month(df, month_col, file_col).filter(F.col(month_col).isNotNull())
    if month_domain:
        latest = F.broadcast(latest)
    return df.join(latest, [file_col, month_col], "inner").select(*df.columns)


def newest_files(df: DataFrame, month_col: str = MONTH, file_col: str = FILE) -> tuple[DataFrame, int]:
    """(month, newest file) as a small table and the number of rows without a
    month, from one aggregate.  For a ``month_col`` of ``with_month``: at most
    12 x 9999 months and the NULL one reach the driver."""
    found = df.groupBy(month_col).agg(F.max(file_col).alias(file_col), F.count(F.lit(1)).alias("n")).collect()
    schema = T.StructType([df.schema[month_col], df.schema[file_col]])
    known = [(r[month_col], r[file_col]) for r in found if r[month_col] is not None]
    return df.sparkSession.createDataFrame(known, schema), sum(r["n"] for r in found if r[month_col] is None)


def null_month_rows(df: DataFrame, month_col: str = MONTH) -> DataFrame:
    """Rows ``latest_version`` drops for lack of a month (for run metrics)."""
    return df.filter(F.col(month_col).isNull())


def reprocess_scope(current: DataFrame, incoming: DataFrame, scope_cols: list[str] | None = None) -> DataFrame:
    """Distinct scope keys present both in the current history and in the
    incoming batch.  Both sides are reduced to distinct keys (map-side
    partial distinct) before the semi join."""
    cols = scope_cols or [MONTH]
    inc = incoming.select(*cols).distinct()
    cur = current.select(*cols).distinct()
    return inc.join(cur, cols, "left_semi")
