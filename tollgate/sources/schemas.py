"""Named schemas and table specs: registry, typed conformance, defaults,
alignment.

A table spec is a ``StructType`` whose field metadata carries the column
comment and an optional default SQL expression; nullability is the NOT NULL
constraint.  The same spec drives:

* ``apply_defaults``: add columns the frame lacks with their default (an
  insert naming a subset of columns), then check NOT NULL;
* ``align_to_schema``: re-order to the spec, add missing columns as typed
  NULLs, drop or keep extra ones (a column-list replacement);
* ``conform_typed``: convert text columns to the spec's types with the
  ``try_`` forms, reporting conversions that failed instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMENT, DEFAULT, FORMAT = "comment", "default", "format"
CONFORM_ERRORS = "conform_errors"


def field(name: str, dtype: T.DataType, nullable: bool = True, comment: str | None = None,
          default: str | None = None, fmt: str | None = None) -> T.StructField:
    meta = {}
    if comment:
        meta[COMMENT] = comment
    if default is not None:
        meta[DEFAULT] = default
    if fmt:
        meta[FORMAT] = fmt
    return T.StructField(name, dtype, nullable, meta)


def _raw(names: list[str]) -> T.StructType:
    return T.StructType([field(n, T.StringType()) for n in names])


def _with_lineage(s: T.StructType, file_col: str, row_col: str) -> T.StructType:
    return T.StructType(list(s.fields) + [field(file_col, T.StringType(), False),
                                          field(row_col, T.StringType())])


def _typed(names, dates, decimals, required, file_col, row_col, date_fmt="yyyyMMdd") -> T.StructType:
    out = []
    for n in names:
        if n in dates:
            out.append(field(n, T.DateType(), n not in required, fmt=date_fmt))
        elif n in decimals:
            out.append(field(n, decimals[n], n not in required))
        else:
            out.append(field(n, T.StringType(), n not in required))
    return _with_lineage(T.StructType(out), file_col, row_col)


LEDGER_TEXT = ["source_system", "company_code", "posting_date", "doc_type", "doc_number",
               "doc_line", "entry_date", "amount_lc", "vendor_code"]

SCHEMAS: dict[str, T.StructType] = {
    "ledger-raw": _raw(LEDGER_TEXT),
    "ledger-bronze": _with_lineage(_raw(LEDGER_TEXT), "file_name", "row_id"),
    "ledger-silver": _typed(LEDGER_TEXT, ["posting_date", "entry_date"],
                            {"amount_lc": T.DecimalType(25, 5), "doc_line": T.IntegerType()},
                            ["source_system", "company_code", "posting_date"], "file_name", "row_id"),
}


def get_schema(name: str) -> T.StructType:
    try:
        return SCHEMAS[name]
    except KeyError:
        raise ValueError(f"schema {name!r} is not defined") from None


def _convert(c: Column, f: T.StructField) -> Column:
    if isinstance(f.dataType, T.DateType):
        return F.try_to_date(c, f.metadata.get(FORMAT, "yyyy-MM-dd"))
    if isinstance(f.dataType, T.TimestampType):
        return F.try_to_timestamp(c, F.lit(f.metadata.get(FORMAT, "yyyy-MM-dd HH:mm:ss")))
    if isinstance(f.dataType, T.StringType):
        return c.cast("string")
    return c.try_cast(f.dataType)


def conform_typed(df: DataFrame, schema: T.StructType, errors_col: str = CONFORM_ERRORS) -> DataFrame:
    """Text -> the schema's types.  A non-NULL value that does not convert
    becomes NULL and its column is listed in ``conform_errors``; a NULL in a
    NOT NULL column is listed too.  Columns the frame lacks are NULL."""
    cols, problems = [], []
    for f in schema.fields:
        if f.name in df.columns:
            src = F.col(f.name)
            val = _convert(src, f)
            problems.append(F.when(src.isNotNull() & val.isNull(), F.lit(f.name)))
        else:
            val = F.lit(None).cast(f.dataType)
        if not f.nullable:
            problems.append(F.when(val.isNull() & (F.col(f.name).isNull() if f.name in df.columns
                                                   else F.lit(True)), F.lit(f.name)))
        cols.append(val.alias(f.name, metadata=f.metadata))
    return df.select(*cols, F.array_join(F.array_compact(F.array(*problems)), ",").alias(errors_col))


def apply_defaults(df: DataFrame, spec: T.StructType, check_not_null: bool = True) -> DataFrame:
    """Add the spec's columns the frame lacks (default expression or NULL),
    cast to the spec's types, order as the spec.  With ``check_not_null`` a
    NULL in a NOT NULL column fails the job when the data is evaluated."""
    cols = []
    for f in spec.fields:
        if f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        elif DEFAULT in f.metadata:
            c = F.expr(f.metadata[DEFAULT]).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if check_not_null and not f.nullable:
            c = F.when(c.isNotNull(), c).otherwise(
                F.raise_error(F.lit(f"NOT NULL column {f.name} received NULL")).cast(f.dataType))
        cols.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def align_to_schema(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Column list of ``schema`` in its order; missing columns as typed NULL;
    extra columns dropped (or appended with ``keep_extra``)."""
    cols = [(F.col(f.name).cast(f.dataType) if f.name in df.columns
             else F.lit(None).cast(f.dataType)).alias(f.name, metadata=f.metadata)
            for f in schema.fields]
    if keep_extra:
        names = set(schema.fieldNames())
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)
