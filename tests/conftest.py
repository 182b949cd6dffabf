import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from lodestack.session import get_session

    return get_session("tests", cpus=4, partitions=4)


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(data):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{data}/{name}'")
    return con
