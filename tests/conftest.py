import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    return build_session("tests", "local[8]", 4, **{"spark.checkpoint.dir": shared, "spark.driver.memory": "8g"})


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def take(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))

    return take
