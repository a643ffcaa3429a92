import pytest

from tarn.plans import sqlext
from tarn.plans.sqlext import CreateCatalog, DropCatalog, Host, SqlError, Vacuum, parse, parse_one


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("VACUUM t", Vacuum(("t",))),
        ("vacuum a.b.t FULL", Vacuum(("a", "b", "t"))),
        ("VACUUM '/data/events'", Vacuum(("/data/events",), True)),
        ("VACUUM delta.'s3://b/t/'", Vacuum(("s3://b/t/",), True)),
        ("VACUUM delta.`/data/x`", Vacuum(("/data/x",), True)),
        ("VACUUM t RETAIN 100 HOURS", Vacuum(("t",), retention_hours=100.0)),
        ("VACUUM t RETAIN 0.5 HOURS DRY RUN", Vacuum(("t",), retention_hours=0.5, dry_run=True)),
        ("VACUUM t DRY RUN RETAIN 1 HOURS FULL", Vacuum(("t",), retention_hours=1.0, dry_run=True)),
        ("VACUUM t RETAIN 1 HOURS RETAIN 2 HOURS", Vacuum(("t",), retention_hours=2.0)),
        ("VACUUM t LITE", Vacuum(("t",), mode="LITE")),
        ("CREATE CATALOG c", CreateCatalog("c")),
        ("CREATE CATALOG IF NOT EXISTS c USING SHARE p.s COMMENT 'x'", CreateCatalog("c", True, ("p", "s"), comment="x")),
        ("CREATE CATALOG c OPTIONS (a.b 1, 'k' 'v', z w,) MANAGED LOCATION 's3://b/x' DEFAULT COLLATION 'UTF8'", CreateCatalog("c", False, None, "s3://b/x", "UTF8", None, (("a.b", "1"), ("k", "v"), ("z", "w")))),
        ("DROP CATALOG IF EXISTS c CASCADE", DropCatalog("c", True, True)),
        ("DROP CATALOG c;", DropCatalog("c")),
        ("CREATE SCHEMA s", Host("CREATE SCHEMA s")),
        ("SELECT ';' -- a; comment\n;", Host("SELECT ';'")),
    ],
)
def test_statement(text, want):
    assert parse_one(text) == want


@pytest.mark.parametrize(
    "text",
    ["VACUUM", "VACUUM t DRY RUN DRY RUN", "VACUUM t RETAIN HOURS", "VACUUM t RETAIN 1", "VACUUM t SELECT", "CREATE CATALOG a.b", "CREATE CATALOG c USING SHARE s", "CREATE CATALOG c COMMENT 'a' COMMENT 'b'", "CREATE CATALOG c MANAGED LOCATION 'nowhere'", "CREATE CATALOG c USING SHARE p.s MANAGED LOCATION 's3://b'", "DROP CATALOG c now", "", "SELECT 'open"],
)
def test_error(text):
    with pytest.raises(SqlError):
        parse_one(text)


def test_scripts():
    assert parse("VACUUM t;; DROP CATALOG c; SELECT 1") == [Vacuum(("t",)), DropCatalog("c"), Host("SELECT 1")]
    with pytest.raises(NotImplementedError):
        parse_one("SELECT 1; SELECT 2")
    for kind in ("CONNECTION", "FOREIGN CATALOG", "LOCATION", "SHARE"):
        with pytest.raises(NotImplementedError):
            parse_one(f"CREATE {kind} x")


def test_explain_text():
    assert str(parse_one("VACUUM t RETAIN 5 HOURS DRY RUN")) == "Vacuum: table=t mode=FULL retention_hours=5 dry_run=true"
    assert str(parse_one("DROP CATALOG IF EXISTS c CASCADE")) == "DropCatalog: name=c if_exists=true cascade=true"
    assert str(sqlext.parse_one("CREATE CATALOG c")) == "CreateCatalog: name=c"


def test_files_by_sql(spark, sf_dir, tmp_path):
    from tarn.session import LakehouseSession

    lake = LakehouseSession(spark)
    lake.sql(f"CREATE EXTERNAL TABLE ext_nation STORED AS PARQUET LOCATION '{sf_dir}/nation.parquet'")
    lake.sql("CREATE EXTERNAL TABLE IF NOT EXISTS ext_nation STORED AS PARQUET LOCATION '/nowhere'")
    assert lake.sql("SELECT count(*) AS n FROM ext_nation").first().n == 25
    assert lake.sql(f"COPY (SELECT n_name, n_regionkey FROM ext_nation WHERE n_regionkey = (1)) TO '{tmp_path}/x.csv' OPTIONS (header true)").first()[0] == 5
    lake.sql(f"CREATE EXTERNAL TABLE ext_csv STORED AS CSV WITH HEADER ROW LOCATION '{tmp_path}/x.csv'")
    assert lake.sql("SELECT sum(n_regionkey) AS s FROM ext_csv").first().s == 5
    assert lake.sql(f"COPY ext_nation TO '{tmp_path}/y' STORED AS json").first()[0] == 25
    with pytest.raises(SqlError):
        lake.sql("COPY ext_nation TO '/x.strange'")
