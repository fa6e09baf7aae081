import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__driver__memory="8g",
        spark__sql__files__openCostInBytes=1048576,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted with nulls first."""
    columns = list(order) or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is not None, str(v)) for v in r])
