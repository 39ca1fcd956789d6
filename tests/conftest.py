import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bayline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "bayline-tests")


@pytest.fixture(scope="session")
def column(spark):
    """Values of an expression over rows: column(rows, ddl, build) -> list."""

    def evaluate(rows, ddl, build):
        return [r[0] for r in spark.createDataFrame(rows, ddl).select(build).collect()]

    return evaluate
