import glob
import os

import duckdb
import pytest

from lodestone.session import session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return c


@pytest.fixture(scope="session")
def sf():
    return SF


def same_rows(df, duck, sql):
    """Whether a DataFrame and a SQL statement have the same rows, columns by name."""
    relation = duck.sql(sql)
    names = sorted(relation.columns)
    assert sorted(df.columns) == names
    listed = ", ".join(f'"{n}"' for n in names)
    want = sorted(map(repr, duck.sql(f"SELECT {listed} FROM ({sql})").fetchall()))
    got = sorted(repr(tuple(row)) for row in df.select(*names).collect())
    assert got == want
