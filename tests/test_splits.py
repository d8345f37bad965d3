"""Cutting a table by a key: every row once, parts of even size."""

from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from test_sources import RecordedSession

from refsync.sources.splits import Splits, bounds_sql, literal, splits_in, splits_of
from refsync.sources.tables import JdbcSource

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for name in ("lineitem", "orders", "customer", "events"):
        made.execute(f"create view {name} as from read_parquet('{FOLDER}/{name}.parquet')")
    # Keys far from even, with nulls and repeated ones.
    made.execute(
        """create table skewed as
        select case when i % 50 = 0 then null when i < 3000 then 'a' else 'k' || cast(i as varchar)
               end as name,
               cast(power(1.004, i) as bigint) as number, i as id,
               timestamp '2024-01-01' + interval (i * i) second as moment,
               date '2024-01-01' + cast(i // 1000 as integer) as day,
               cast(i / 7 as decimal(9, 3)) as price, i % 3 = 0 as flag
        from range(5000) t(i)"""
    )
    return made


class Database:
    """Stands in for a source that answers queries: the statement runs elsewhere."""

    def __init__(self, spark, con):
        self.spark, self.con = spark, con

    def query(self, sql):
        rows = self.con.execute(sql).fetchall()
        names = [column[0] for column in self.con.description]
        class Found:
            def collect(self):
                return [dict(zip(names, row)) for row in rows]
        return Found()


KEYS = [
    ("skewed", ("number",)),
    ("skewed", ("name", "id")),
    ("skewed", ("moment",)),
    ("skewed", ("day", "price")),
    ("skewed", ("flag", "name", "id")),
    ("lineitem", ("l_orderkey", "l_linenumber")),
    ("lineitem", ("l_shipdate", "l_orderkey", "l_linenumber")),
    ("customer", ("c_name",)),
    ("events", ("ts", "event_id")),
]


@pytest.mark.parametrize("table, key", KEYS)
def test_predicates_cut_evenly_and_cover_every_row_once(spark, con, table, key):
    splits = splits_in(Database(spark, con), table, key, 13)
    predicates = splits.predicates()
    assert len(predicates) == 13
    times = " + ".join(f"case when {p} then 1 else 0 end" for p in predicates)
    assert con.execute(f"select distinct {times} from {table}").fetchall() == [(1,)]
    counted = [
        con.execute(f"select count(*) from {table} where {p}").fetchone()[0] for p in predicates
    ]
    assert tuple(counted) == splits.rows
    assert splits.largest_share() < 2


def test_a_hot_key_stays_in_one_part_unless_more_columns_cut_it(spark, con):
    alone = splits_in(Database(spark, con), "skewed", ("name",), 10)
    assert len(alone.bounds) < 9 and alone.largest_share() > 2
    both = splits_in(Database(spark, con), "skewed", ("name", "id"), 10)
    assert len(both.bounds) == 9 and both.largest_share() < 1.01


def test_spark_finds_the_same_bounds(spark, con):
    stored = con.execute("select name, id, number from skewed").fetchall()
    frame = spark.createDataFrame(stored, "name string, id long, number long")
    for key in (("name", "id"), ("number",), ("name",)):
        assert splits_of(frame, key, 13) == splits_in(Database(spark, con), "skewed", key, 13)


def test_small_and_empty_tables(spark, con):
    frame = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    splits = splits_of(frame, ("k",), 10)
    assert splits.bounds == ((2,),) and splits.rows == (1, 2)
    assert splits_of(frame.limit(0), ("k",), 10).predicates() == ["1 = 1"]
    nulls = splits_of(spark.createDataFrame([(None,), (None,)], "k long"), "k", 4)
    assert nulls.bounds == () and nulls.rows == (2,)


def test_spark_filters_by_the_predicates(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    splits = splits_of(lines, ("l_shipdate", "l_orderkey", "l_linenumber"), 7)
    counted = [lines.filter(p).count() for p in splits.predicates()]
    assert tuple(counted) == splits.rows and sum(counted) == lines.count()


def test_literals():
    assert literal("it's") == "'it''s'" and literal(None) == "null" and literal(True) == "true"
    assert literal(Decimal("1.50")) == "1.50" and literal(date(2024, 1, 2)) == "date '2024-01-02'"
    assert literal(datetime(2024, 1, 2, 3, 4, 5, 6)) == "timestamp '2024-01-02 03:04:05.000006'"


def test_nulls_at_a_bound_of_several_columns(con):
    """A bound may hold nulls itself; they come first."""
    con.execute("create or replace table n as select * from (values (null, null), (null, 1),"
                " (null, 2), (1, null), (1, 1), (2, null)) t(a, b)")
    for bounds in [((None, 1),), ((None, 2), (1, None)), ((1, None), (1, 1), (2, None))]:
        predicates = Splits(("a", "b"), bounds).predicates()
        times = " + ".join(f"case when {p} then 1 else 0 end" for p in predicates)
        assert con.execute(f"select distinct {times} from n").fetchall() == [(1,)]
    counted = [con.execute(f"select count(*) from n where {p}").fetchone()[0]
               for p in Splits(("a", "b"), ((None, 2), (1, None))).predicates()]
    assert counted == [2, 1, 3]


def test_refuses_what_makes_no_parts():
    for columns, parts in (((), 4), (("a",), 0), (("a",), 70_000)):
        with pytest.raises(ValueError):
            bounds_sql("t", columns, parts)


def test_database_source_asks_where_to_cut(con):
    """No database is started: the statement it would be asked is answered by DuckDB."""

    class Source(JdbcSource):
        def query(self, sql):
            return Database(None, con).query(sql)

    source = Source(
        RecordedSession(), "jdbc:x", {"user": "u"}, keys={"skewed": (("number",), 5)}
    )
    assert len(source.table("skewed")["predicates"]) == 5
    assert "predicates" not in source.table("other")
