"""File-name mask check as a Column predicate.

A mask such as ``{fileName}_{yyyymmdd}_{hhmmss}.{fileExtension}`` switches on
checks by the placeholders it contains; the checks always run in the fixed
order fileName, sourceSystem, yyyymmdd, hhmmss, fileExtension:

* fileName: the stem (text before the first dot) starts with ``prefix_``;
* sourceSystem: one ``_``-delimited token, any value;
* yyyymmdd: the next token is exactly 8 characters and a real date;
* hhmmss: the next token is exactly 6 characters and a real time;
* fileExtension: the text after the first dot equals the extension.

A token ends at the next ``_`` or at the end of the stem; tokens after the
last checked one are accepted.  Name, prefix and extension compare
lower-cased.  The shape is one ``rlike``; dates and times parse with
``try_to_date``/``try_to_timestamp`` — no UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder names recognised in masks.
FILE_NAME, SOURCE_SYSTEM, DATE, TIME, EXTENSION = (
    "fileName", "sourceSystem", "yyyymmdd", "hhmmss", "fileExtension")


def placeholders(mask: str) -> set[str]:
    return set(re.findall(r"\{(.*?)\}", mask))


def mask_predicate(name: Column | str, mask: str, prefix: str, extension: str) -> Column:
    """TRUE when the file name satisfies the mask."""
    col = F.lower(F.col(name) if isinstance(name, str) else name)
    prefix, extension = prefix.lower(), extension.lower()
    marks = placeholders(mask)
    stem = F.substring_index(col, ".", 1)
    ext = F.regexp_extract(col, r"(?s)^[^.]*[.](.*)$", 1)
    parts, groups, consumed = [], {}, False
    if FILE_NAME in marks or SOURCE_SYSTEM in marks:
        parts.append(re.escape(prefix))
        consumed = True
    if SOURCE_SYSTEM in marks:
        parts.append("_[^_]*")
    for mark, width in ((DATE, 8), (TIME, 6)):
        if mark in marks:
            parts.append(("_" if consumed else "[^_]*_") + f"([^_]{{{width}}})")
            groups[mark] = "".join(parts).count("(")
            consumed = True
    pattern = "^" + "".join(parts) + ("(?:_|$)" if groups else "")
    ok = stem.rlike(pattern) if parts else F.lit(True)
    if FILE_NAME in marks:
        ok = ok & stem.startswith(prefix + "_")
    if DATE in marks:
        tok = F.regexp_extract(stem, pattern, groups[DATE])
        ok = ok & F.try_to_date(tok, "yyyyMMdd").isNotNull()
    if TIME in marks:
        tok = F.regexp_extract(stem, pattern, groups[TIME])
        ok = ok & F.try_to_timestamp(tok, F.lit("HHmmss")).isNotNull()
    if EXTENSION in marks:
        ok = ok & (ext == F.lit(extension))
    return F.coalesce(ok, F.lit(False))


def prefix_suffix_predicate(name: Column | str, prefix: str, extension: str) -> Column:
    """Case-insensitive ``prefix`` start and ``.extension`` end."""
    col = F.lower(F.col(name) if isinstance(name, str) else name)
    return col.startswith(prefix.lower()) & col.endswith("." + extension.lower())
