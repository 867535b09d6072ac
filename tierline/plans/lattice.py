"""Which type holds the values of two others without loss, and what becomes of a column when none does."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: Decimal digits of whole-number types, and whether a double holds all of their values.
WHOLE: dict[type, tuple[int, bool]] = {
    T.ByteType: (3, True), T.ShortType: (5, True), T.IntegerType: (10, True), T.LongType: (19, False),
}
WIDTH = tuple(WHOLE)
MOST_DIGITS = 38
SAME, WIDEN, TEXT, APART, REFUSE = "same", "widen", "as text", "keep apart", "refuse"


class SchemaConflict(Exception):
    """A column comes in a type that the stored one can't be widened to."""


def _decimal(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (WHOLE[type(kind)][0], 0) if type(kind) in WHOLE else None


def widest(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both without loss; None where there is none. Text holds only text."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if type(one) in WHOLE and type(other) in WHOLE:
        return max(one, other, key=lambda k: WIDTH.index(type(k)))
    floating = {type(one), type(other)} & {T.FloatType, T.DoubleType}
    if floating:
        rest = [k for k in (one, other) if not isinstance(k, (T.FloatType, T.DoubleType))]
        return T.DoubleType() if all(WHOLE.get(type(k), (0, False))[1] for k in rest) else None
    if (a := _decimal(one)) and (b := _decimal(other)):
        before, after = max(a[0], b[0]), max(a[1], b[1])
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else None
    if {type(one), type(other)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        element = widest(one.elementType, other.elementType)
        return element and T.ArrayType(element)
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        key, value = widest(one.keyType, other.keyType), widest(one.valueType, other.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return _fields(one, other)
    return None


def _fields(one: T.StructType, other: T.StructType) -> T.StructType | None:
    """All fields of both, those of ``one`` first; null fields where one lacks them."""
    theirs, kinds = {f.name: f.dataType for f in other.fields}, []
    for f in one.fields:
        kind = widest(f.dataType, theirs.pop(f.name, f.dataType))
        if kind is None:
            return None
        kinds.append(T.StructField(f.name, kind))
    return T.StructType([*kinds, *[T.StructField(f.name, f.dataType) for f in other.fields if f.name in theirs]])


def merged_schema(stored: T.StructType, fresh: T.StructType) -> T.StructType:
    """The columns of both, in types that hold the values of both. Raises ``SchemaConflict`` where a type can't widen."""
    known, fields = {f.name: f for f in fresh.fields}, []
    for f in stored.fields:
        other = known.pop(f.name, f).dataType
        kind = widest(f.dataType, other)
        if kind is None:
            raise SchemaConflict(f"column {f.name!r} is stored as {f.dataType.simpleString()} and comes as {other.simpleString()}")
        fields.append(T.StructField(f.name, kind))
    return T.StructType([*fields, *[f for f in fresh.fields if f.name in known]])


def declared(text: str) -> T.DataType:
    """The type that a variant's schema names; objects are structs."""
    return T.DataType.fromDDL(re.sub(r"(`[^`]*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", text))


def decide(seen: T.DataType, contract: T.DataType | None) -> str:
    """What becomes of a payload's values of a type where the contract has ``contract`` (None: no such leaf).

    ``same`` and ``widen`` are read as the contract's type, ``as text`` into a text column; ``keep apart`` stays in the
    column of extras. ``refuse`` is a value where the contract has an object, or the other way round: it is kept apart
    as well, and nothing that the contract has there can be read.
    """
    if contract is None:
        return APART
    if isinstance(contract, T.StructType) != isinstance(seen, T.StructType) and not isinstance(seen, T.NullType):
        return REFUSE
    if isinstance(contract, T.StructType) or isinstance(seen, T.NullType) or seen == contract:
        return SAME
    if isinstance(contract, T.StringType):
        return APART if isinstance(seen, (T.ArrayType, T.MapType)) else TEXT
    return WIDEN if widest(contract, seen) == contract else APART
