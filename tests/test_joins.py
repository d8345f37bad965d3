import pytest
from helpers import rows
from pyspark.sql import functions as F

from refsync.operators import joins
from refsync.operators.joins import fits_broadcast, lookup_join, measured
from refsync.operators.numbering import running_total


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds(spark, monkeypatch):
    df = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 100))
    (size,) = measured(df)
    assert size.rows == 10 and size.bytes >= 1080
    assert fits_broadcast(df, spark.range(0)) == [True, True]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 9)
    assert fits_broadcast(df, spark.range(0)) == [False, True]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    assert fits_broadcast(df) == [False]


def test_nested_columns_are_measured(spark):
    df = spark.range(1).select(F.struct(F.repeat(F.lit("x"), 1000).alias("t")).alias("s"))
    assert measured(df)[0].bytes > 1000


def test_large_side_is_not_broadcast(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100).withColumn("k", F.col("id") % 7)
        right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        small = lookup_join(left, right, "k")
        assert "BroadcastHashJoin" in plan(small)
        monkeypatch.setattr(joins, "fits_broadcast", lambda *f: [False] * len(f))
        large = lookup_join(left, right, "k")
        assert "Broadcast" not in plan(large)
        assert rows(small) == rows(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_copies_on_the_right_are_reduced_before_the_shuffle(spark, how):
    left = spark.range(10).withColumn("k", F.col("id") % 4)
    right = spark.range(90).select((F.col("id") % 3).alias("k"), F.lit("x").alias("other"))
    usual = lookup_join(left, right, "k", how, small=True)
    shuffled = lookup_join(left, right, "k", how, small=False)
    assert rows(shuffled) == rows(usual)
    # Distinct keys were written out, so the join reads two plain tables.
    assert "HashAggregate" not in plan(shuffled)


def test_large_files_are_not_counted(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert measured(stored)[0].rows == 1000
    monkeypatch.setattr(joins, "COUNTED_BYTES", 10)
    assert fits_broadcast(stored) == [False]
    monkeypatch.setattr(joins, "_scanned_bytes", lambda frame: joins._NO_ESTIMATE)
    assert measured(stored)[0].rows == 1000
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    assert measured(stored)[0].rows == 101


@pytest.fixture
def shuffled(spark):
    """No broadcasts, and partitions small enough that a hot one shows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    """The plan that ran, after the re-plan."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


def stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def hot(spark, column="k", rows=60000):
    """A third of the rows on one key."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias(column),
        F.md5((F.col("id") * 7).cast("string")).alias("data"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_key_is_split_in_every_kind_of_join(spark, shuffled, tmp_path, how):
    left = stored(spark, hot(spark), tmp_path / "left")
    right = stored(spark, hot(spark).select("k").distinct().limit(15000), tmp_path / "right")
    joined = lookup_join(left, right, "k", how, small=False)
    assert "skew=true" in executed(joined)


def test_hot_province_is_split(spark, shuffled, tmp_path, monkeypatch):
    from refsync.operators import supplement
    from refsync.operators.reference import Small

    records = stored(
        spark,
        spark.range(0, 60000, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("municipality"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5((F.col("id") * 3).cast("string"))).alias(
                "province"
            ),
        ),
        tmp_path / "records",
    )
    zones = "id string, name string, levelid string, parentid string, levelnumber int, parentname string"
    hierarchy = spark.createDataFrame([("z", "Land", "l1", None, 1, None)], zones)
    levels = spark.createDataFrame([("l2", 2), ("l3", 3)], "id string, levelnumber int")
    none = Small(False, False, False, False, False)
    provinces = supplement.missing_provinces(records, hierarchy, levels, none)
    found = supplement.missing_municipalities(records, hierarchy, levels, provinces, none)
    assert "skew=true" in executed(found)


def test_hot_service_list_is_split(spark, shuffled, tmp_path):
    from refsync.operators.facilities import with_program_ids

    services = F.array(F.struct(F.lit("n").alias("name"), F.col("k").alias("code")))
    records = stored(
        spark, hot(spark).select("data", services.alias("services")), tmp_path / "records"
    )
    programs = hot(spark).select(F.col("k").alias("code"), F.col("k").alias("id")).distinct()
    found = with_program_ids(records, stored(spark, programs, tmp_path / "programs"), few=False)
    assert "skew=true" in executed(found)


def test_hot_role_is_split(spark, shuffled, tmp_path):
    from refsync.operators.report import recipients

    right = "12345678-1234-5678-1234-567812345678"
    roles = hot(spark).select(F.col("k").alias("roleid")).distinct()
    rights = stored(spark, roles.withColumn("rightid", F.lit(right)), tmp_path / "rights")
    held = stored(
        spark, hot(spark).toDF("roleid", "userid"), tmp_path / "held"
    )
    contacts = stored(
        spark,
        hot(spark).select(F.col("data").alias("referencedatauserid"), F.col("data").alias("email")),
        tmp_path / "contacts",
    )
    # The users found are written out before the last join, and with them this one.
    plans = []
    keep = joins.materialize

    def watched(df, label):
        plans.append(executed(df))
        return keep(df, label)

    joins.materialize = watched
    try:
        assert recipients(rights, held, contacts, right, small=False).count() == 60000
    finally:
        joins.materialize = keep
    assert any("skew=true" in found for found in plans)


def test_hot_unknown_municipality_is_split(spark, shuffled, tmp_path):
    from refsync.operators.reference import Small
    from refsync.operators.supplement import records_missing_zone

    records = stored(
        spark,
        hot(spark, "municipality").select(
            "municipality", F.lit("p").alias("province"), F.col("data").alias("code"),
            F.col("data").alias("name"),
        ),
        tmp_path / "records",
    )
    zones = hot(spark, "name").select("name").where("name <> 'hot'").distinct().limit(15000)
    hierarchy = stored(
        spark, zones.withColumn("levelnumber", F.lit(3)).withColumn("id", F.col("name")),
        tmp_path / "zones",
    )
    none = Small(False, False, False, False, False)
    assert "skew=true" in executed(records_missing_zone(records, hierarchy, 3, none))


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_running_total(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(1000).select(
            F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 5).alias("w")
        )
        data = sorted((row.k, row.w) for row in df.collect())
        expected, total = [], 0
        for number, (key, weight) in enumerate(data):
            expected.append((key, number, total))
            total += weight
        numbered = running_total(df, ["k"], column="n")
        weighted = running_total(df, ["k"], weight="w", column="t")
        got = numbered.join(weighted.select("k", "t"), "k").select("k", "n", "t")
        assert rows(got) == sorted(expected, key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_running_total_of_nothing(spark):
    assert running_total(spark.range(0), ["id"]).count() == 0
