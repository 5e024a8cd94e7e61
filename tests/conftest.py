import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from riskloom.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def values(df, *columns, key="transaction_id", digits=9):
    """Rows as a dict by key, doubles rounded."""
    def norm(v):
        return round(v, digits) + 0.0 if isinstance(v, float) else v

    columns = columns or [c for c in df.columns if c != key]
    return {row[key]: tuple(norm(row[c]) for c in columns) for row in df.select(key, *columns).collect()}
