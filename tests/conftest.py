import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from eventlake.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(cores=4, partitions=2, app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def rows():
    """A data frame's rows as a sorted list of tuples."""
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
