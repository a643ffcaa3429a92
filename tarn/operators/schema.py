"""Fit rows to a schema: by field name, to any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A column that must not be NULL is missing, or a shape cannot become the one asked for."""


def _find(t: T.StructType, name: str) -> T.StructField | None:
    return next((f for f in t.fields if f.name == name), None)


def fitted(value: Column, have: T.DataType, want: T.DataType, where: str = "") -> Column:
    """value as the wanted type: structs by field name in the wanted order, missing fields NULL, others dropped; leaves that
    cannot be converted become NULL."""
    if isinstance(want, T.StructType):
        if not isinstance(have, T.StructType):
            raise SchemaMismatch(f"{where or 'the row'} is no struct")
        fields = []
        for f in want.fields:
            at = f"{where}.{f.name}" if where else f.name
            mine = _find(have, f.name)
            if mine is None:
                if not f.nullable:
                    raise SchemaMismatch(f"{at} is missing and must not be NULL")
                fields.append(F.lit(None).cast(f.dataType).alias(f.name))
            else:
                fields.append(fitted(value.getField(f.name), mine.dataType, f.dataType, at).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        if not isinstance(have, T.ArrayType):
            raise SchemaMismatch(f"{where} is no list")
        if have == want:
            return value
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType, f"{where}[]"))
    if isinstance(want, T.MapType):
        if not isinstance(have, T.MapType):
            raise SchemaMismatch(f"{where} is no map")
        if have == want:
            return value
        keys = F.transform(F.map_keys(value), lambda x: fitted(x, have.keyType, want.keyType, f"{where}.key"))
        values = F.transform(F.map_values(value), lambda x: fitted(x, have.valueType, want.valueType, f"{where}.value"))
        return F.map_from_arrays(keys, values)
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        raise SchemaMismatch(f"{where} is nested")
    return value if have == want else value.try_cast(want)


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df under schema: columns by name, in its order; missing nullable ones are NULL, others go."""
    out = []
    for f in schema.fields:
        mine = _find(df.schema, f.name)
        if mine is None:
            if not f.nullable:
                raise SchemaMismatch(f"{f.name} is missing and must not be NULL")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(fitted(F.col(f"`{f.name}`"), mine.dataType, f.dataType, f.name).alias(f.name))
    return df.select(*out)


def nested_field(schema: T.StructType, path: str) -> T.DataType:
    """The type at a dotted path."""
    if not path:
        raise SchemaMismatch("the path is empty")
    t: T.DataType = schema
    for p in path.split("."):
        if not isinstance(t, T.StructType):
            raise SchemaMismatch(f"{path}: what holds {p} is no struct")
        f = _find(t, p)
        if f is None:
            raise SchemaMismatch(f"{path}: there is no field {p}")
        t = f.dataType
    return t
