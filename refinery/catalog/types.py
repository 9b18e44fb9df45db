"""The lattice of safe type changes: a wider type holds every value of a narrower one,
and files written with the narrower one read as the wider one without a rewrite."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
# Digits that a decimal needs before the point: files store the three small integers alike.
_DIGITS = {T.ByteType(): 10, T.ShortType(): 10, T.IntegerType(): 10, T.LongType(): 20}


def widest(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both; None if there is none."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    small = [x for x in (a, b) if x in _INTEGERS]
    if small and {type(a), type(b)} & {T.DoubleType}:
        # a double holds every 32-bit number, not every 64-bit one
        return T.DoubleType() if small[0] != T.LongType() else None
    if any(isinstance(x, T.DecimalType) for x in (a, b)):
        parts = [(x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_DIGITS.get(x), 0) for x in (a, b)]
        if any(whole is None for whole, _ in parts):
            return None
        whole, scale = max(w for w, _ in parts), max(s for _, s in parts)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        inner = [widest(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)]
        return None if None in inner else T.StructType([T.StructField(n, t) for n, t in zip(a.names, inner)])
    return None


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether ``new`` holds every value of ``old`` and is another type."""
    return old != new and widest(old, new) == new


def union(schemas: Iterable[tuple[str, T.StructType]], fold=str.lower) -> tuple[list[T.StructField], dict[str, list[str]]]:
    """Columns of all schemas in order of first sight, each with its widest type, and the
    conflicts: column -> ``"<where>: <type>"`` of the types that have no common one."""
    fields: dict[str, T.StructField] = {}
    seen: dict[str, dict[str, str]] = {}
    conflicts: dict[str, list[str]] = {}
    for where, schema in schemas:
        for f in schema.fields:
            key = fold(f.name)
            seen.setdefault(key, {}).setdefault(f.dataType.simpleString(), where)
            if key not in fields:
                fields[key] = T.StructField(f.name, f.dataType)
                continue
            common = widest(fields[key].dataType, f.dataType)
            if common is None:
                conflicts[key] = []
            else:
                fields[key] = T.StructField(fields[key].name, common)
    return list(fields.values()), {k: [f"{where}: {kind}" for kind, where in seen[k].items()] for k in conflicts}
