"""Delimited extracts: reader specs, scans, file selection, multi-file ingest.

An extract is a headerless delimited text file (tab, Latin-1 by default)
whose columns are all text and named by position.  All selected extracts
are read by **one** scan (not a driver loop of per-file scans); each row is
tagged with its extract's name from the file metadata column, so the file
acts as the batch key for the quality gate downstream.

An extract may be a single file or a folder of part files (as Spark writes
them); its name is the path entry directly below the landing folder.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.filenames import mask_predicate, prefix_suffix_predicate
from tollgate.sources import files

CORRUPT = "_corrupt_record"
FILE = "file_name"


@dataclass(frozen=True)
class ReaderSpec:
    """How to read one source's extracts (a row of the process table)."""
    delimiter: str = "\t"
    encoding: str = "ISO-8859-1"
    header: bool = False
    quote: str | None = None          # None = Spark's default quote (")
    extension: str = "txt"
    prefix: str = ""
    mask: str | None = None
    schema_name: str | None = None

    @classmethod
    def from_row(cls, row) -> "ReaderSpec":
        d = row.asDict() if hasattr(row, "asDict") else dict(row)
        return cls(delimiter=d.get("file_delimiter") or "\t",
                   encoding=d.get("file_encoding") or "ISO-8859-1",
                   header=bool(d.get("file_header") or False),
                   quote=d.get("file_quote"),
                   extension=d.get("file_extension") or "txt",
                   prefix=d.get("file_prefix") or "",
                   mask=d.get("file_mask"),
                   schema_name=d.get("schema_name"))

    def options(self) -> dict[str, str]:
        opts = {"sep": self.delimiter, "encoding": self.encoding,
                "header": str(self.header).lower(), "mode": "PERMISSIVE"}
        if self.quote is not None:
            opts["quote"] = self.quote
        return opts


def text_schema(names: list[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def scan_delimited(spark: SparkSession, paths: str | list[str], names: list[str],
                   spec: ReaderSpec = ReaderSpec(), flag_malformed: bool = False) -> DataFrame:
    """All-text scan with positional names.  Empty fields read as NULL;
    with ``flag_malformed`` rows of the wrong arity keep their raw text in
    ``_corrupt_record`` instead of failing the read."""
    schema = text_schema(names, flag_malformed)
    reader = spark.read.schema(schema).options(**spec.options())
    if flag_malformed:
        # a pruned read would not see that a line has more fields
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false")
    return reader.csv(paths if isinstance(paths, list) else [paths])


def write_delimited(df: DataFrame, path: str, spec: ReaderSpec = ReaderSpec(), by: list[str] | None = None,
                    part_rows: int = 0) -> None:
    """Write ``df`` as headerless delimited text (fixture and export helper),
    dealt into one folder per value of ``by``, in part files of at most
    ``part_rows`` rows (0: as many as come)."""
    w = df.write.mode("overwrite").option("sep", spec.delimiter) \
        .option("encoding", spec.encoding).option("header", str(spec.header).lower())
    if spec.quote is not None:
        w = w.option("quote", spec.quote)
    if part_rows:
        w = w.option("maxRecordsPerFile", part_rows)
    if by:
        w = w.partitionBy(*by)
    w.csv(path)


def undeal(spark: SparkSession, dealt: str, folder: str, col: str) -> list[str]:
    """Rename the folders ``<col>=<name>`` of a dealt write to entries
    ``<name>`` of ``folder``, remove what is left and return the names."""
    found = [n for n in files.entries(spark, dealt) if n.startswith(f"{col}=")]
    names = [unquote(n.removeprefix(f"{col}=")) for n in found]
    for old, name in zip(found, names):
        files.rename(spark, f"{dealt}/{old}", f"{folder}/{name}")
    files.remove(spark, dealt)
    return names


def list_entries(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries directly inside ``folder`` (a bounded listing on
    the driver, like any file-system listing)."""
    return files.entries(spark, folder)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below ``folder`` (from the file system's metadata)."""
    p, fs = files.hadoop_path(spark, folder)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def select_files(names: DataFrame, spec: ReaderSpec, name_col: str = "file_name",
                 apply_mask: bool = False) -> DataFrame:
    """Extract names matching prefix and extension case-insensitively (and
    the mask, when asked), sorted by name."""
    keep = prefix_suffix_predicate(name_col, spec.prefix, spec.extension)
    if apply_mask and spec.mask:
        keep = keep & mask_predicate(name_col, spec.mask, spec.prefix, spec.extension)
    return names.filter(keep).orderBy(name_col)


def extract_name(root: str):
    """Column: the landing-folder entry a row was read from.

    The path that Spark reports is URI-encoded (a blank is ``%20``, a per cent
    sign ``%25``), with ``+`` standing for itself."""
    return entry_of(decoded_path(), root)


def entry_of(path: Column, root: str) -> Column:
    """The entry directly below ``root`` that a path leads through."""
    folder = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//)?", "", root.rstrip("/"))
    return F.regexp_extract(path, re.escape(folder) + "/([^/]+)", 1)


def decoded_path():
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def ingest(spark: SparkSession, landing: str, names: list[str], spec: ReaderSpec = ReaderSpec(),
           file_col: str = "file_name", apply_mask: bool = False,
           flag_malformed: bool = False, loaded: DataFrame | None = None,
           only: DataFrame | None = None) -> DataFrame:
    """Select the landing folder's extracts by the spec and read them all in
    one scan, each row tagged with its extract name.  ``loaded`` (file_name)
    names extracts that are not read again, ``only`` (file_name) those that are
    read at all.

    The listing is the driver's, as for any scan of named files; which of its
    entries are new is an anti join against ``loaded``."""
    listing = spark.createDataFrame([(n,) for n in list_entries(spark, landing)], "file_name string")
    if loaded is not None:
        listing = listing.join(loaded.select("file_name"), "file_name", "left_anti")
    if only is not None:
        listing = listing.join(only.select("file_name").distinct(), "file_name", "left_semi")
    chosen = [r.file_name for r in select_files(listing, spec, apply_mask=apply_mask).collect()]
    if not chosen:
        return spark.createDataFrame([], text_schema(names, flag_malformed).add(file_col, T.StringType()))
    paths = [f"{landing.rstrip('/')}/{_escaped(n)}" for n in chosen]
    df = scan_delimited(spark, paths, names, spec, flag_malformed)
    return df.select("*", extract_name(landing).alias(file_col))


def _escaped(name: str) -> str:
    """A listed name as a literal in a path that Spark reads as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", name)
