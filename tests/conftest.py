import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapflow.session import build_session  # noqa: E402

# made at import, because Column expressions at module level need a session
SESSION = build_session(
    "tests",
    "local[4]",
    **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="snapflow-tests-"),
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def one(spark):
    """Value of a Column expression over one row of given columns."""

    def value(column, schema="x string", *values):
        row = [tuple(values) if values else (None,) * len(schema.split(","))]
        return spark.createDataFrame(row, schema).select(column.alias("v")).first()["v"]

    return value
