"""Schemas that JSON texts show."""

import pytest
from pyspark.sql import functions as F

from refsync.sources.inferred import field_types, infer_schema, parsed


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def shown(spark, *values):
    return infer_schema(texts(spark, *values)).simpleString()


def test_shapes_are_merged(spark):
    assert shown(spark, '{"b": 1}', '{"a": "x", "b": 2.5}', '{"a": null, "c": true}') == (
        "struct<a:string,b:double,c:boolean>"
    )


def test_nested_shapes_are_merged(spark):
    found = shown(
        spark,
        '{"services": [{"name": "a"}], "type": {"id": "1"}}',
        '{"services": [{"code": 7}, {"name": null}], "type": {"level": 2}}',
    )
    assert found == (
        "struct<services:array<struct<code:bigint,name:string>>,type:struct<id:string,level:bigint>>"
    )


def test_nothing_to_infer_from(spark):
    assert shown(spark) == "struct<>"
    assert shown(spark, None, "", "not json", "[1]", "3", "{}") == "struct<>"


def test_lists_that_are_always_empty_hold_strings(spark):
    assert shown(spark, '{"services": []}', '{"services": []}') == "struct<services:array<string>>"
    assert shown(spark, '{"a": null}') == "struct<a:string>"
    # One element is enough.
    assert shown(spark, '{"services": []}', '{"services": [{"code": "c"}]}') == (
        "struct<services:array<struct<code:string>>>"
    )


def test_values_of_several_types_keep_their_text(spark):
    df = texts(spark, '{"a": 1}', '{"a": "x"}', '{"a": {"b": [1, 2]}}', '{"a": null}')
    schema = infer_schema(df)
    assert schema.simpleString() == "struct<a:string>"
    found = [row.a for row in df.select(parsed(F.col("value"), schema).alias("r")).select("r.a").collect()]
    assert found == ["1", "x", '{"b":[1,2]}', None]


@pytest.mark.parametrize("name", ["OBJECT", "a b", "a`b", "OBJECT<x", "ä", "1"])
def test_any_name(spark, name):
    import json

    df = texts(spark, json.dumps({name: {"inner": 1}}))
    schema = infer_schema(df)
    assert [field.name for field in schema.fields] == [name]
    assert df.select(parsed(F.col("value"), schema).alias("r")).first().r[name].inner == 1


def test_large_numbers_survive(spark):
    value = '{"a": 123456789012345678901234567890, "b": 9223372036854775807}'
    schema = infer_schema(texts(spark, value))
    assert schema.simpleString() == "struct<a:decimal(30,0),b:bigint>"


def test_field_types(spark):
    schema = infer_schema(texts(spark, '{"a": [[{"b": 1}]], "c": {"d": "x"}}'))
    assert field_types(schema) == [
        ("a", "array"), ("a[]", "array"), ("a[][]", "struct"), ("a[][].b", "long"),
        ("c", "struct"), ("c.d", "string"),
    ]


def test_merging_starts_within_the_tasks(spark, capsys):
    texts(spark, "{}").agg(F.schema_of_variant_agg(F.try_parse_json("value"))).explain()
    assert "partial_schema_of_variant_agg" in capsys.readouterr().out
