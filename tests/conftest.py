import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("QUIRESPARK_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from quirespark.session import local_session

    session = local_session(cpus=4, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = os.path.join(DATA, "sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("the driver's tables are not here")
    return folder


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
