import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(x):
    """Values that compare alike between engines."""
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return round(x + 0.0, 9) if isinstance(x, float) else x


@pytest.fixture(scope="session")
def same(spark, duck):
    def check(function, sql):
        frame = function(spark, DATA)
        names = sorted(frame.columns)
        found = sorted(repr([plain(r[c]) for c in names]) for r in frame.collect())
        relation = duck.execute(sql)
        own = [c[0] for c in relation.description]
        assert sorted(own) == names
        assert found == sorted(repr([plain(r[own.index(c)]) for c in names]) for r in relation.fetchall())

    return check
