import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from small_tables import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from foldwise.session import get_session
    s = get_session("local[4]", 4)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from foldwise.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
