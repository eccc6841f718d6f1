import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from carelens.session import tune
    from workload.check import session

    return tune(session("4"))


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, nulls as None."""

    def read(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return read
