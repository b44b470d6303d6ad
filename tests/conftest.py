import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import get_session

    session = get_session("tests", cpus=4, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def rows_of(frame):
    """Rows as sorted strings, columns by name, floats rounded."""
    frame = frame[sorted(frame.columns)]

    def text(v):
        if v is None or v != v:
            return "null"
        return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)

    return sorted("|".join(map(text, row)) for row in frame.itertuples(index=False, name=None))
