import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException

from refsync.operators.envelope import map_resource, with_json_rows
from refsync.sources.registry import resource

AT = datetime(2024, 6, 1, 12, 30, 5, tzinfo=timezone.utc)


def zones(spark):
    return spark.sql(
        "select 'z1' as id, 7 as catchmentpopulation, 'c' as code,"
        " cast(1.5 as decimal(8,5)) as latitude, cast(null as decimal(8,5)) as longitude,"
        " 'Zone' as name, 'L2' as levelid, cast(null as string) as parentid, 'x' as boundary"
    )


def test_envelope_of_a_row(spark):
    spec = resource("referencedata.geographic_zones")
    row = with_json_rows(map_resource(zones(spark), spec, AT)).first()
    assert (row.schema_name, row.table_name, row.operation) == ("", "geographic_zone", "S")
    assert row.change_time == "2024-06-01T12:30:05Z"
    assert json.loads(row.row_data) == {
        "id": "z1",
        "catchment_population": 7,
        "code": "c",
        "latitude": "1.50000",
        "longitude": None,
        "name": "Zone",
        "level_id": "L2",
        "parent_id": None,
    }


def test_ids_repeat_unless_random(spark):
    spec = resource("referencedata.geographic_zones")

    def identity(**options):
        return map_resource(zones(spark), spec, AT, **options).first().id

    assert identity() == identity()
    assert identity(random_ids=True) != identity(random_ids=True)


def test_times_and_costs_become_text(spark):
    lots = spark.sql(
        "select 'l' as id, true as active, 'c' as lotcode, date'2024-02-03' as expirationdate,"
        " timestamp'2024-01-02 03:04:05.120' as manufacturedate"
    )
    data = map_resource(lots, resource("referencedata.lots"), AT).first().row_data
    assert data.expiration_date == "2024-02-03"
    assert data.manufacture_date == "2024-01-02 03:04:05.12"


def test_missing_source_column_fails(spark):
    with pytest.raises(AnalysisException):
        map_resource(
            zones(spark).drop("levelid"), resource("referencedata.geographic_zones"), AT
        )


def test_mapping_does_not_shuffle(spark, tmp_path):
    spec = resource("referencedata.geographic_zones")
    zones(spark).write.parquet(str(tmp_path / "zones"))
    mapped = with_json_rows(map_resource(spark.read.parquet(str(tmp_path / "zones")), spec, AT))
    plan = mapped._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "boundary" not in plan
