import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from outledger import schemas  # noqa: E402
from outledger.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", **{"spark.ui.showConsoleProgress": "false"})


@pytest.fixture(scope="session")
def rows(spark):
    """Build a declared table from dictionaries; missing columns are NULL."""

    def build(table, *records):
        struct = schemas.struct(table)
        names = [f.name for f in struct.fields]
        unknown = {k for r in records for k in r} - set(names)
        assert not unknown, unknown
        data = [tuple(r.get(n) for n in names) for r in records]
        return schemas.normalize_empty(spark.createDataFrame(data, struct))

    return build
