"""Values that are safe to write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark import constants as K


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def safe_text(c: Column, max_chars: int | None = None) -> Column:
    """Text without control characters; words for null become null; cut only if a caller asks for it."""
    clean = F.regexp_replace(c, K.CONTROL_CHARS, "")
    if max_chars is not None:
        clean = F.substring(clean, 1, max_chars)
    return F.when(~c.isin(list(K.NULL_WORDS)), clean)


def has_floats(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return has_floats(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return has_floats(dtype.keyType) or has_floats(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(has_floats(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def finite_inside(c: Column, dtype: T.DataType) -> Column:
    """``c`` with every floating number in it, however deep, finite or null."""
    if not has_floats(dtype):
        return c
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: finite_inside(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, v: finite_inside(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        fields = [finite_inside(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return finite(c)


def json_safe(df: DataFrame) -> DataFrame:
    """Every floating number finite or null, also inside arrays, structs and maps."""
    return df.select(*[finite_inside(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def sanitize(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Clean every text and floating column before a text sink."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = safe_text(c, max_chars)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = finite(c)
        columns.append(c.alias(f.name))
    return df.select(*columns)
