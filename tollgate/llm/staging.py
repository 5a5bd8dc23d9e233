"""Tables an operator writes once and reads several times.

They live under the shared folder of ``spark.checkpoint.dir``: every executor
sees them, and a lost executor re-reads them instead of recomputing.  A run's
folder is removed when the driver's Python ends, or by ``release``.
"""

from __future__ import annotations

import atexit
import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tollgate.session import checkpoint_dir

_RUN = uuid.uuid4().hex
_SESSIONS: list[SparkSession] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path in the shared folder."""
    if not any(s is spark for s in _SESSIONS):
        _SESSIONS.append(spark)
    return f"{_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back with its schema."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialise`` that nothing reads any more: all that
    was made of them has been written."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._staged)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def workers_import_this(spark: SparkSession) -> None:
    """Let local Python workers import this package from where the driver has
    it; a cluster gets it with ``--py-files`` or an installed package."""
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


def release() -> None:
    """Remove what this driver's runs have staged; results that still read
    it must have been written before."""
    while _SESSIONS:
        spark = _SESSIONS.pop()
        try:
            jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
            path = jvm.org.apache.hadoop.fs.Path(_root(spark))
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session may be stopped already
            continue


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/staged-{_RUN}"


atexit.register(release)
