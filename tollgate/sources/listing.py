"""File listings as data: path, name, bytes and time of every file.

The listing is a scan of file metadata: no file is opened.  Names are checked
by their mask where the rows are, and only the chosen ones reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.filenames import mask_predicate, prefix_suffix_predicate
from tollgate.sources.delimited import ReaderSpec, entry_of

LISTING_SCHEMA = "path string, modified timestamp, bytes long"


def list_files(spark: SparkSession, folder: str, nested: bool = True) -> DataFrame:
    """path, entry (the name directly below ``folder``), name (of the file
    itself), bytes and modified of every file; hidden files (``_``, ``.``) are
    no extracts.  With ``nested`` files of all levels are listed."""
    reader = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    found = reader.load(folder).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    plain = F.regexp_replace("path", "^[a-zA-Z][a-zA-Z0-9+.-]*:(//)?", "")
    return found.select("path", entry_of(plain, folder).alias("entry"), F.element_at(F.split(plain, "/"), -1).alias("name"),
                        "bytes", "modified")


def list_extracts(spark: SparkSession, folder: str, spec: ReaderSpec, apply_mask: bool = True) -> DataFrame:
    """One row per extract that fits the spec: file_name, files, bytes,
    modified (of its newest file).  An extract is a file or a folder of part
    files directly below ``folder``."""
    keep = prefix_suffix_predicate("entry", spec.prefix, spec.extension)
    if apply_mask and spec.mask:
        keep &= mask_predicate("entry", spec.mask, spec.prefix, spec.extension)
    return list_files(spark, folder).filter(keep).groupBy(F.col("entry").alias("file_name")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))
