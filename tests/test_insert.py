import pytest
from pyspark.sql import types as T

from tarn import fixtures
from tarn.operators import insert
from tarn.plans import predicate, scan, sqlext
from tarn.session import LakehouseSession
from tarn.sources import snapshot
from tarn.sources.commit import write_commit

SHAPE = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("at", T.TimestampType()), T.StructField("kind", T.StringType()), T.StructField("x", T.DoubleType())])


@pytest.fixture
def table(spark, tmp_path):
    b = fixtures.Builder(spark, str(tmp_path / "t"))
    b.commit(*b.start(SHAPE, ["kind", "at"]))
    return b.root


@pytest.fixture
def lake(spark, table):
    lake = LakehouseSession(spark)
    lake.register_delta("ins_t", table)
    yield lake
    lake.schema.deregister_table("ins_t")


def test_rows_partitions_and_statistics(lake, spark, table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        made = lake.sql("INSERT INTO ins_t VALUES (1, timestamp'2024-01-01 00:00:00Z', 'a b/c=%', 1.5), (2, NULL, NULL, NULL), (3, timestamp'2024-01-01 00:00:00Z', 'a b/c=%', 7)")
        assert made.first()[0] == 3
        assert lake.sql("INSERT INTO ins_t (kind, id) SELECT 'z', 4").first()[0] == 1
        assert lake.sql("INSERT INTO ins_t SELECT * FROM ins_t WHERE id > 100").first()[0] == 0
        rows = {r.id: (r.s, r.kind, r.x) for r in lake.sql("SELECT id, unix_seconds(at) AS s, kind, x FROM ins_t").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows == {1: (1704067200, "a b/c=%", 1.5), 2: (None, None, None), 3: (1704067200, "a b/c=%", 7.0), 4: (None, "z", None)}
    found = snapshot.load(spark, table)
    assert found.version == 2
    assert all(f.records for f in scan.chosen(found)) and sum(f.records for f in scan.chosen(found)) == 4
    assert len(scan.chosen(snapshot.load(spark, table), predicate.parse(spark, "id = 4"))) == 1
    assert len(scan.chosen(snapshot.load(spark, table), predicate.parse(spark, "kind is null"))) == 1


def test_the_second_writer_takes_the_next_version(spark, table):
    old = snapshot.load(spark, table)
    write_commit(spark, table, 1, [{"commitInfo": {"operation": "OTHER"}}])
    rows = spark.createDataFrame([(9, None, "k", 0.5)], SHAPE)
    assert insert.append(old, rows).version == 2
    b = fixtures.Builder(spark, table)
    write_commit(spark, table, 3, [b.metadata(SHAPE, ["kind"])])
    with pytest.raises(insert.Conflict):
        insert.append(snapshot.load(spark, table, 2), rows)


def test_what_is_refused(lake, spark, sf_dir):
    with pytest.raises(ValueError, match="no column"):
        lake.sql("INSERT INTO ins_t (nothing) VALUES (1)")
    with pytest.raises(ValueError, match="1 columns for 4"):
        lake.sql("INSERT INTO ins_t VALUES (1)")
    with pytest.raises(Exception, match="must not be NULL"):
        lake.sql("INSERT INTO ins_t VALUES (NULL, NULL, 'a', 1)")
    mapped = snapshot.load(spark, fixtures.path_of(spark, sf_dir, "mapped_name"))
    with pytest.raises(insert.CannotAppend):
        insert.check(mapped)


def test_statements():
    one = sqlext.parse_one("INSERT INTO a.b (x, `y z`) VALUES (1, 2);")
    assert (one.name, one.columns, one.source, str(one)) == (("a", "b"), ("x", "y z"), "VALUES (1, 2)", "Insert: table=a.b")
    assert sqlext.parse_one("INSERT INTO TABLE t (SELECT 1)").source == "(SELECT 1)"
    assert sqlext.parse_one("INSERT INTO t SELECT ';'").source == "SELECT ';'"
    for text in ("INSERT OVERWRITE t SELECT 1", "INSERT INTO t PARTITION (a = 1) SELECT 1"):
        assert sqlext.parse_one(text) == sqlext.Host(text)
