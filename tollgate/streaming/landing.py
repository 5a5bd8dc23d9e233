"""The raw -> bronze load driven by Structured Streaming.

An extract may arrive as several part files over some time, and its gate needs
all of them.  So the stream does not read the parts: it watches for marker
files, ``<extract>.done``, which the sender writes when an extract is complete
(with any content; Spark does not see files without a byte).
Each trigger takes the markers that are new (the stream's checkpoint sees to it
that none is taken twice) and runs the batch load over exactly those extracts,
each gated as a whole.

Bronze history is kept by extract (``Warehouse(bronze_scope=["file_name"])``):
a trigger supersedes earlier deliveries of the same extract and nothing else.
The run id follows from the batch id, so a replayed trigger replaces its own
run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.rules import Rule
from tollgate.plans import loads as L
from tollgate.sources import delimited as DL

DONE = ".done"


def completed_extracts(spark: SparkSession, landing: str, archive: str | None = None,
                       max_files: int | None = None) -> DataFrame:
    """Stream of (file_name): extracts whose marker has arrived.  Markers are
    moved to ``archive`` after use where one is given; ``max_files`` bounds
    the extracts of one trigger."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", f"*{DONE}")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    name = F.regexp_extract(DL.decoded_path(), "([^/]+)" + DONE.replace(".", "[.]") + "$", 1)
    return reader.load(landing).select(name.alias("file_name"))


def start_bronze_stream(spark: SparkSession, wh: L.Warehouse, table: str, landing: str,
                        names: list[str], spec: DL.ReaderSpec, rules: list[Rule], process_id: int,
                        checkpoint: str, run_id_base: int = 0, available_now: bool = True,
                        archive: str | None = None, max_files: int | None = None, as_of=None):
    """Start the streaming bronze load; returns the StreamingQuery.  ``as_of``
    gives a run's stamp by batch id (default: now)."""
    if wh.bronze_scope != [DL.FILE]:
        raise ValueError("a streaming load needs Warehouse(bronze_scope=['file_name'])")

    def load(batch: DataFrame, batch_id: int) -> None:
        stamp = {"as_of": as_of(batch_id)} if as_of else {}
        run = L.RunInfo(run_id_base + batch_id + 1, process_id, **stamp)
        L.bronze_load(spark, wh, table, landing, names, spec, rules, run, apply_mask=bool(spec.mask), only=batch)

    writer = (completed_extracts(spark, landing, archive, max_files).writeStream
              .foreachBatch(load).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
