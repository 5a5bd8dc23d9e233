"""Dense sequential row ids without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition funnels the whole
table through one task.  Instead:

1. range-partition and sort by the ordering key (a position tie-breaker lets
   the range partitioner split runs of identical rows, so one hot value
   cannot land in a single task);
2. write the ordered rows once as Parquet to the shared folder, each with the
   number of its partition and its position in it.  That fixes both for every
   later read and cuts the lineage (executor loss afterwards re-reads the
   files);
3. count the rows per partition from these two columns alone, and turn the
   counts into start offsets (one row per partition);
4. id = offset of the partition + position + 1, by a broadcast of the offsets.

Identical rows are indistinguishable, so which of them receives which id
does not change any result built on the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.staging import staged_path

_TIE, _PID, _POS, _OFF = "_tg_tie", "_tg_pid", "_tg_pos", "_tg_off"


def _order_exprs(cols: list[str | Column]) -> list[Column]:
    return [(F.col(f"`{c}`") if isinstance(c, str) else c).asc_nulls_first() for c in cols]


def stage_ordered(df: DataFrame, order: list[str | Column], path: str, num_partitions: int | None = None,
                  more: list[Column] | None = None) -> T.StructType:
    """Write ``df`` to ``path`` in ``order`` (NULLs first), with the partition
    and the position of each row; returns the schema without these two.

    ``more`` are columns computed row by row after the sort: range partitioning
    samples its input, so whatever comes before it runs twice."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    exprs = [*_order_exprs(order), F.col(_TIE).asc()]
    ordered = df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(n, *exprs).sortWithinPartitions(*exprs)
    rows = ordered.select(
        *[F.col(f"`{c}`") for c in df.columns], *(more or []), F.spark_partition_id().alias(_PID),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias(_POS))
    rows.write.parquet(path)
    return T.StructType(rows.schema.fields[:-2])


def read_numbered(spark: SparkSession, path: str, schema: T.StructType, id_col: str) -> DataFrame:
    """The staged rows with ``id_col`` = 1..n in their order."""
    whole = T.StructType([*schema.fields, T.StructField(_PID, T.IntegerType()), T.StructField(_POS, T.LongType())])
    rows = spark.read.schema(whole).parquet(path)
    # One row per partition of the sort, which its caller has set.
    counts = rows.groupBy(_PID).agg((F.max(_POS) + 1).alias("n")).orderBy(_PID).collect()
    offsets, start = [], 0
    for r in counts:
        offsets.append((r[_PID], start))
        start += r["n"]
    starts = spark.createDataFrame(offsets, f"{_PID} int, {_OFF} long")
    return rows.join(F.broadcast(starts), _PID).select(
        *[F.col(f"`{f.name}`") for f in schema], (F.col(_OFF) + F.col(_POS) + 1).alias(id_col))


def dense_row_numbers(df: DataFrame, order_cols: list[str] | None = None,
                      id_col: str = "row_num", num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = 1..n in ``order_cols`` order (all columns by default,
    NULLs first).  Returns a frame over a staged table, which is removed when
    the driver ends."""
    path = staged_path(df.sparkSession, "rowids")
    schema = stage_ordered(df, list(order_cols or df.columns), path, num_partitions)
    return read_numbered(df.sparkSession, path, schema, id_col)


def partitions_for(n_bytes: int, least: int = 1, target: int = 128 << 20) -> int:
    """Partitions that hold about ``target`` bytes of input each."""
    return max(least, -(-n_bytes // target))


def prefixed(prefix: str | int, number: Column) -> Column:
    """Row identity ``"<prefix>_<n>"``."""
    return F.concat(F.lit(f"{prefix}_"), number.cast("string"))


def row_ids(df: DataFrame, prefix: str | int, order_cols: list[str] | None = None,
            id_col: str = "row_id", num_partitions: int | None = None) -> DataFrame:
    """Row identity ``"<prefix>_<n>"`` with n dense from 1 in key order."""
    numbered = dense_row_numbers(df, order_cols, "_tg_rownum", num_partitions)
    return numbered.withColumn(id_col, prefixed(prefix, F.col("_tg_rownum"))).drop("_tg_rownum")
