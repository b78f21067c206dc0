import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from foldwise.session import get_session
    return get_session("local[4]", 4)


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from foldwise.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return con


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
