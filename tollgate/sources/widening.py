"""Type changes of stored columns that lose nothing.

``widest(known, incoming)`` is the type that holds every value of both, or
None where there is none.  A column never becomes text because one delivery
brought text; text that is known takes any plain value as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits that hold every value of an integer type; narrow to wide.
_INTEGERS: dict[type, int] = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_EXACT_IN_DOUBLE = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)


class TypeChange(ValueError):
    """A column arrived with a type that the stored one cannot take."""


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """(digits before the point, digits after it)"""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_INTEGERS[type(t)], 0) if type(t) in _INTEGERS else None


def widest(known: T.DataType, incoming: T.DataType) -> T.DataType | None:
    """The type of a column that has held ``known`` and now gets ``incoming``."""
    if known == incoming or isinstance(incoming, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return incoming
    if type(known) in _INTEGERS and type(incoming) in _INTEGERS:
        return max(known, incoming, key=lambda t: _INTEGERS[type(t)])
    if T.DecimalType in (type(known), type(incoming)):
        a, b = _decimal(known), _decimal(incoming)
        if a and b:
            before, after = max(a[0], b[0]), max(a[1], b[1])
            if before + after <= 38:  # the widest decimal
                return T.DecimalType(before + after, after)
    pair = {type(known), type(incoming)}
    if T.DoubleType in pair and pair <= {T.DoubleType, *_EXACT_IN_DOUBLE}:
        return T.DoubleType()
    if T.FloatType in pair and pair <= {T.FloatType, T.ByteType, T.ShortType}:
        return T.FloatType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(known, T.StringType) and isinstance(incoming, T.AtomicType) and not isinstance(incoming, T.BinaryType):
        return known
    return _nested(known, incoming)


def _nested(known: T.DataType, incoming: T.DataType) -> T.DataType | None:
    if isinstance(known, T.ArrayType) and isinstance(incoming, T.ArrayType):
        element = widest(known.elementType, incoming.elementType)
        return element and T.ArrayType(element, True)
    if isinstance(known, T.MapType) and isinstance(incoming, T.MapType) and known.keyType == incoming.keyType:
        value = widest(known.valueType, incoming.valueType)
        return value and T.MapType(known.keyType, value, True)
    if isinstance(known, T.StructType) and isinstance(incoming, T.StructType) and known.names == incoming.names:
        fields = [widest(a.dataType, b.dataType) for a, b in zip(known, incoming, strict=True)]
        if all(fields):
            return T.StructType([T.StructField(f.name, t) for f, t in zip(known, fields, strict=True)])
    return None


def widened(known: T.StructType | None, incoming: T.StructType, fixed: list[str] = ()) -> T.StructType:
    """The table's columns after ``incoming``: known ones in their order with
    the widest types, new ones (nullable) at the end.  A change that no type
    holds, or any change of a ``fixed`` column, raises ``TypeChange``."""
    known = known or T.StructType()
    new = {f.name: f for f in incoming}
    fields, refused = [], []
    for f in known:
        wide = f.dataType
        if f.name in new and not same_type(f.dataType, new[f.name].dataType):
            wide = None if f.name in fixed else widest(f.dataType, new[f.name].dataType)
            if wide is None:
                refused.append(f"{f.name}: {f.dataType.simpleString()} to {new[f.name].dataType.simpleString()}")
        fields.append(T.StructField(f.name, wide or f.dataType, True, f.metadata))
    if refused:
        raise TypeChange("these columns cannot take the new type: " + "; ".join(refused))
    names = set(known.names)
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in incoming if f.name not in names])


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()


def as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of the narrower type as the wider one."""
    if same_type(have, want):
        return c
    if isinstance(want, T.StringType) and isinstance(have, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.cast(want)
