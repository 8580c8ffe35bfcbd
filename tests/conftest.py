import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from paygrain.session import get_spark, ship

    s = get_spark(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="4g", spark__driver__host="127.0.0.1", spark__sql__warehouse__dir="/tmp/paygrain-warehouse"
    )
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()


@pytest.fixture(scope="session")
def rows():
    """The rows of a table as a sorted list of tuples."""

    def get(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

    return get
