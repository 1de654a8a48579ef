"""One local session for all tests, and the SQL engine that queries are held against."""

import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

import duckdb  # noqa: E402
import pytest  # noqa: E402

from crateflow import get_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("w"))})
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sql():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(_plain, value)) if isinstance(value, (list, tuple)) else value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="session")
def same_as_sql(spark, sql):
    """Runs a query on both engines and compares names and rows."""

    def check(query, text):
        df = query(spark, SF)
        cur = sql.execute(text)
        names = [c[0] for c in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), names)

    return check
