"""Catalog tables from specs: defaults, comments, locations, partitions.

A table is Parquet at a location of its own, registered in Spark's catalog
with the spec's column comments and defaults.  Rows that name a subset of the
columns get the others' defaults from the catalog, at insert time; columns that
are added later read as their default in old rows.  The catalog does not check
NOT NULL for Parquet, so inserts do.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.sources import files
from tollgate.sources.schemas import COMMENT, DEFAULT

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


def _table(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"no table name: {name!r}")
    return ".".join(f"`{p}`" for p in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column(f: T.StructField, with_default: bool = True) -> str:
    out = f"`{f.name}` {f.dataType.simpleString()}"
    if with_default and DEFAULT in f.metadata:
        out += f" DEFAULT {f.metadata[DEFAULT]}"
    if f.metadata.get(COMMENT):
        out += f" COMMENT {_text(f.metadata[COMMENT])}"
    return out


def create_table(spark: SparkSession, name: str, spec: T.StructType, path: str, partition_by: list[str] = ()) -> None:
    """Create the table if it is not registered; its data stays at ``path``."""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(name)} ({', '.join(_column(f) for f in spec)}) "
              f"USING parquet{parts} LOCATION {_text(path)}")


def register_location(spark: SparkSession, name: str, path: str, partition_by: list[str] = (),
                      schema: T.StructType | None = None) -> DataFrame:
    """Register the Parquet data at ``path`` as ``name``, with its partitions.

    Registering again takes up new partitions and leaves the data alone; a
    name that stands for another location is refused.  The schema is read from
    the files where it is not given."""
    at = files.hadoop_path(spark, path)
    full = at[1].makeQualified(at[0]).toString()
    if spark.catalog.tableExists(name):
        known = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_table(name)}").collect() if r["col_name"] == "Location"]
        if not known or _plain(known[0]) != _plain(full):
            raise ValueError(f"{name} stands for {known}, not for {full}")
    else:
        create_table(spark, name, schema or spark.read.parquet(path).schema, full, partition_by)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {_table(name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _plain(location: str) -> str:
    return re.sub(r"^file:/+", "/", location.rstrip("/"))


def insert_rows(rows: DataFrame, name: str, spec: T.StructType) -> None:
    """Append rows that name some of the table's columns; the catalog fills
    the others.  A NULL in a NOT NULL column fails the job, and a NOT NULL
    column that is neither named nor has a default is refused."""
    spark = rows.sparkSession
    unknown = [c for c in rows.columns if c not in spec.names]
    lacking = [f.name for f in spec if not f.nullable and f.name not in rows.columns and DEFAULT not in f.metadata]
    if unknown or lacking:
        raise ValueError(f"{name}: unknown columns {unknown}, NOT NULL columns without a value {lacking}")
    checked = []
    for c in rows.columns:
        f, value = spec[c], F.col(f"`{c}`").cast(spec[c].dataType)
        if not f.nullable:
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"NOT NULL column {c} received NULL")).cast(f.dataType))
        checked.append(value.alias(c))
    view = f"_tg_insert_{uuid.uuid4().hex}"
    rows.select(*checked).createOrReplaceTempView(view)
    try:
        names = ", ".join(f"`{c}`" for c in rows.columns)
        spark.sql(f"INSERT INTO {_table(name)} ({names}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def evolve_table(spark: SparkSession, name: str, spec: T.StructType) -> None:
    """Bring a registered table to a newer spec: add its new columns with
    comments and defaults (old rows read as the default that a column was added
    with), set changed defaults and comments.  Data is not rewritten; columns
    are neither dropped nor retyped."""
    have = {f.name: f for f in spark.table(name).schema}
    fresh = [f for f in spec if f.name not in have]
    changed = [f"{f.name}: {have[f.name].dataType.simpleString()} to {f.dataType.simpleString()}" for f in spec
               if f.name in have and have[f.name].dataType.simpleString() != f.dataType.simpleString()]
    if changed:
        raise ValueError(f"{name}: types cannot change in the catalog: {'; '.join(changed)}")
    if fresh:
        spark.sql(f"ALTER TABLE {_table(name)} ADD COLUMNS ({', '.join(_column(f) for f in fresh)})")
    defaults = table_defaults(spark, name)
    for f in spec:
        if f.name in have:
            if f.metadata.get(DEFAULT) != defaults.get(f.name):
                change = f"SET DEFAULT {f.metadata[DEFAULT]}" if DEFAULT in f.metadata else "DROP DEFAULT"
                spark.sql(f"ALTER TABLE {_table(name)} ALTER COLUMN `{f.name}` {change}")
            if f.metadata.get(COMMENT) and f.metadata[COMMENT] != have[f.name].metadata.get(COMMENT):
                spark.sql(f"ALTER TABLE {_table(name)} ALTER COLUMN `{f.name}` COMMENT {_text(f.metadata[COMMENT])}")


def table_defaults(spark: SparkSession, name: str) -> dict[str, str]:
    """Column defaults as the catalog has them."""
    out, inside = {}, False
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_table(name)}").collect():
        if r["col_name"].startswith("#"):
            inside = r["col_name"] == "# Column Default Values"
        elif inside and r["col_name"]:
            out[r["col_name"]] = r["comment"]
    return out
