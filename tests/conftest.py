import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from conceptree.session import build_session, clean_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make("a int, b string", (1, "x"), ...)"""

    def build(schema, *rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return build


def got(df, *columns):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
