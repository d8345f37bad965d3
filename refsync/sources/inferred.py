"""JSON texts whose fields are not declared.

The schema is what all texts together show. Each text is described by itself,
and descriptions are merged as they meet, within a task first; no text moves.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

# What the merged description calls an object; names in backquotes are left alone.
_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|\bOBJECT(?=<)")
_RECORD = "record"


def infer_schema(texts: DataFrame, column: str = "value") -> StructType:
    """The fields of all texts that are JSON objects, in order of their names.

    Whole numbers are longs, or decimals beyond those, and others doubles. A field that is null wherever it
    occurs is a string, and so are the elements of an array that is always
    empty. A field whose values have several types is a string too, and holds
    their JSON text. Texts that are no object show nothing; without any there
    are no fields.
    """
    record = F.try_parse_json(F.col(column))
    objects = texts.select(record.alias(_RECORD)).filter(
        F.schema_of_variant(_RECORD).startswith("OBJECT")
    )
    merged = objects.agg(F.schema_of_variant_agg(_RECORD).alias("merged")).first()["merged"]
    text = _OBJECT.sub(lambda found: found[1] or "STRUCT", merged or "")
    if not text.startswith("STRUCT<"):
        return StructType([])
    whole = StructType.fromDDL(f"{_RECORD} {text}")[_RECORD].dataType
    return _settled(whole)


def _settled(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda field: field.name)
        return StructType([StructField(f.name, _settled(f.dataType)) for f in fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    if isinstance(kind, (NullType, VariantType)):
        return StringType()
    if isinstance(kind, FloatType) or (isinstance(kind, DecimalType) and kind.scale):
        return DoubleType()
    return kind


def parsed(column: Column, schema: StructType) -> Column:
    """A text as a record of an inferred schema; null if it is no object."""
    return F.from_json(column, schema)


def field_types(schema: DataType, path: str = "") -> list[tuple[str, str]]:
    """Every field with its path and type; elements of arrays are under ``[]``."""
    if isinstance(schema, StructType):
        found = []
        for field in schema.fields:
            name = f"{path}.{field.name}" if path else field.name
            found += [(name, field.dataType.typeName()), *field_types(field.dataType, name)]
        return found
    if isinstance(schema, ArrayType):
        element = f"{path}[]"
        return [(element, schema.elementType.typeName()), *field_types(schema.elementType, element)]
    return []
