import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


class Oracle:
    """Runs SQL over the same tables and compares rows in any order."""

    def __init__(self, folder):
        import glob

        import duckdb

        self.con = duckdb.connect()
        for f in glob.glob(f"{folder}/*.parquet"):
            self.con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")

    def same(self, df, sql):
        cur = self.con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, cur.fetchall())


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def oracle():
    return Oracle(SF)
