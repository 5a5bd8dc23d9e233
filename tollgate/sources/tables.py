"""Tables addressed by name or by path: registration and full reloads.

A reloaded table keeps its versions side by side::

    <path>/version=<n>/     one complete copy, published by a rename

Readers take the newest version.  A reload writes the next one aside and
renames it, so there is a whole table to read before, during and after, and
the source of a reload may be the table itself.  The version before is kept for
readers that are still at it; older ones are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tollgate.sources import files


def register_path(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Make the data at ``path`` (or its newest version) queryable as ``name``
    for this session (re-registering replaces the view, the data is untouched)."""
    newest = newest_version(spark, path)
    df = spark.read.format(fmt).load(f"{path.rstrip('/')}/version={newest}" if newest else path)
    df.createOrReplaceTempView(name)
    return df


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in files.entries(spark, path) if n.startswith("version="))


def newest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version; 0 before the first reload."""
    return max(_versions(spark, path), default=0)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest version."""
    newest = newest_version(spark, path)
    if not newest:
        raise LookupError(f"no table has been loaded at {path}")
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/version={newest}")


def reload_table(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2) -> int:
    """Replace the table's rows by ``df`` (truncate and reload) and return the
    new version.  ``keep`` versions stay (1 at least); a reload that fails
    leaves the table as it was.  Two reloads at once: the second to publish
    raises ``FileExistsError``."""
    spark, root = df.sparkSession, path.rstrip("/")
    version = newest_version(spark, root) + 1
    aside = f"{root}/_aside-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).save(aside)
        files.rename(spark, aside, f"{root}/version={version}")
    except BaseException:
        files.remove(spark, aside)
        raise
    files.remove(spark, *[f"{root}/version={n}" for n in _versions(spark, root)[:-max(keep, 1)]])
    return version
