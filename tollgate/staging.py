"""Tables that a load writes once and reads several times.

They live in the shared folder of ``spark.checkpoint.dir``: every executor sees
them, and a lost executor re-reads them instead of recomputing.  Whoever stages
a table removes it; what is left goes when the driver's Python ends.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession

from tollgate.session import checkpoint_dir
from tollgate.sources import files

_LEFT: dict[str, SparkSession] = {}


def staged_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _LEFT[path] = spark
    return path


def unstage(spark: SparkSession, *paths: str) -> None:
    files.remove(spark, *paths)
    for path in paths:
        _LEFT.pop(path, None)


def _remove_left() -> None:
    for path, spark in list(_LEFT.items()):
        with contextlib.suppress(Exception):  # the session may be stopped already
            files.remove(spark, path)


atexit.register(_remove_left)
