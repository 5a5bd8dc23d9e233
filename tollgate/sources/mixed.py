"""Extracts of several formats in one scan.

Each source's reader settings are a control row: delimiter, quote, encoding,
header, and the columns by position.  All chosen extracts are read as lines by
one text scan; an extract's control row is found by its name (prefix,
extension, mask), and every line is parsed by its own row's settings.  There is
one parser per distinct setting in the plan, none per file.

Lines end at LF, CR or CRLF in every format, as in ``scan_delimited`` without
multi-line fields.  Blank lines are skipped.  In a source with headers a line
that names the columns in their order (case and blanks around names aside) is a
header, wherever it stands, as part files repeat it; ``header_missing`` lists
the extracts where none was found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.filenames import mask_predicate, prefix_suffix_predicate
from tollgate.sources import files
from tollgate.sources.delimited import CORRUPT, FILE, ReaderSpec, _escaped, extract_name

#: Encodings in which a line end is the one byte that the text scan looks for.
LINE_ENCODINGS = {"UTF-8", "US-ASCII", "ISO-8859-1"}
SOURCE = "source"
_LINE, _PARSED = "_tg_line", "_tg_parsed"


class AmbiguousSource(ValueError):
    """An extract's name fits several control rows."""


@dataclass(frozen=True)
class Source:
    """One control row: a name, how to read its extracts, their columns."""

    name: str
    spec: ReaderSpec
    columns: tuple[str, ...]

    def matches(self, file_col: str) -> Column:
        keep = prefix_suffix_predicate(file_col, self.spec.prefix, self.spec.extension)
        if self.spec.mask:
            keep &= mask_predicate(file_col, self.spec.mask, self.spec.prefix, self.spec.extension)
        return keep


def route(names: DataFrame, sources: list[Source], file_col: str = FILE) -> DataFrame:
    """(file, source number) of the extract names that fit a source; a name
    that fits several has the number -1."""
    hits = F.array_compact(F.array(*[F.when(s.matches(file_col), F.lit(i)) for i, s in enumerate(sources)]))
    return names.select(file_col, hits.alias("_hits")).filter(F.size("_hits") > 0).select(
        file_col, F.when(F.size("_hits") == 1, F.col("_hits")[0]).otherwise(F.lit(-1)).alias(SOURCE))


def _parsed(source: Source, columns: list[str]) -> Column:
    """The line parsed by one source's settings, as a struct of all columns."""
    spec = source.spec
    if spec.encoding.upper() not in LINE_ENCODINGS:
        raise ValueError(f"source {source.name}: lines of {spec.encoding} cannot be found in a mixed scan")
    line = F.col(_LINE)
    if spec.encoding.upper() != "UTF-8":
        line = F.decode(line.cast("binary"), spec.encoding)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*source.columns, CORRUPT)])
    options = {"sep": spec.delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if spec.quote is not None:
        options["quote"] = spec.quote
    names = F.lit(False)
    if spec.header:
        plain = [c.strip().lower() for c in source.columns]

        def is_header(p: Column) -> Column:
            got = F.array(*[F.lower(F.trim(p[c])) for c in source.columns])
            return F.coalesce(got == F.array(*[F.lit(c) for c in plain]), F.lit(False))
    else:
        def is_header(p: Column) -> Column:
            return names

    def aligned(p: Column) -> Column:
        return F.struct(is_header(p).alias("header"), p[CORRUPT].alias(CORRUPT), *[
            (p[c] if c in source.columns else F.lit(None).cast("string")).alias(c) for c in columns])

    # An array of one, so that the line is parsed once and not once per column.
    return F.transform(F.array(F.from_csv(line, schema.simpleString(), options)), aligned)[0]


def scan_mixed(spark: SparkSession, landing: str, sources: list[Source], file_col: str = FILE,
               flag_malformed: bool = False, keep_headers: bool = False) -> DataFrame:
    """All extracts of ``landing`` that fit one of the sources: every source's
    columns (NULL where a source lacks one), the extract's name and the
    source's.  With ``flag_malformed`` lines of the wrong arity keep their text."""
    columns = list(dict.fromkeys(c for s in sources for c in s.columns))
    listing = spark.createDataFrame([(n,) for n in files.entries(spark, landing)], f"{file_col} string")
    chosen = route(listing, sources, file_col).collect()  # of the listing, which the driver has
    if twice := sorted(r[file_col] for r in chosen if r[SOURCE] < 0):
        raise AmbiguousSource(f"these extracts fit several sources: {', '.join(twice)}")
    out_cols = [*columns, *([CORRUPT] if flag_malformed else [])]
    if not chosen:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in (*out_cols, file_col, SOURCE)])
        return spark.createDataFrame([], empty)
    paths = [f"{landing.rstrip('/')}/{_escaped(r[file_col])}" for r in chosen]
    numbers = F.broadcast(spark.createDataFrame([(r[file_col], r[SOURCE]) for r in chosen], "_tg_file string, _tg_source int"))
    lines = spark.read.text(paths).select(F.col("value").alias(_LINE), extract_name(landing).alias(file_col))
    lines = lines.filter(~F.col(_LINE).rlike(r"^[\x00-\x20]*$")).join(numbers, F.col(file_col) == F.col("_tg_file"))
    parsed = F.lit(None)
    for i, s in enumerate(sources):
        value = _parsed(s, columns)
        parsed = F.when(F.col("_tg_source") == i, value) if i == 0 else parsed.when(F.col("_tg_source") == i, value)
    named = F.element_at(F.array(*[F.lit(s.name) for s in sources]), F.col("_tg_source") + 1)
    rows = lines.select(parsed.alias(_PARSED), file_col, named.alias(SOURCE))
    extra = [F.col(f"{_PARSED}.header").alias("is_header")] if keep_headers else []
    if not keep_headers:
        rows = rows.filter(~F.col(f"{_PARSED}.header"))
    return rows.select(*[F.col(f"{_PARSED}.`{c}`").alias(c) for c in out_cols], *extra, file_col, SOURCE)


def header_missing(spark: SparkSession, landing: str, sources: list[Source], file_col: str = FILE) -> DataFrame:
    """Extracts of sources with headers in which no line names the columns."""
    with_headers = [s.name for s in sources if s.spec.header]
    seen = scan_mixed(spark, landing, sources, file_col, keep_headers=True).filter(F.col(SOURCE).isin(with_headers))
    return seen.groupBy(file_col, SOURCE).agg(F.bool_or("is_header").alias("_seen")).filter("not _seen").drop("_seen")


def sources_from_control(rows: list, columns_of) -> list[Source]:
    """Control rows (as ``ReaderSpec.from_row`` reads them, with a
    ``process_name``) as sources; ``columns_of`` gives a schema name's columns."""
    out = []
    for row in rows:
        spec = ReaderSpec.from_row(row)
        out.append(Source(str(row["process_name"]), spec, tuple(columns_of(spec.schema_name))))
    return out
