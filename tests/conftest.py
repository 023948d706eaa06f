import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


from broadsheet import build_session  # noqa: E402

# Column expressions need a running session, also while test modules are imported.
SESSION = build_session(
    "broadsheet-tests",
    master="local[*]",
    **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def evaluate(spark, inputs, expression, column="v", schema=None):
    """Apply a Column function to a list of inputs, in order."""
    rows = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, schema or f"i int, {column} string")
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]
