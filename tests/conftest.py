import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercaloom.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "mercaloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tmp_path_factory.mktemp("warehouse"),
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def staging(spark, small):
    from mercaloom.sources.fixtures import StagingTables, read_source_tables

    return StagingTables(read_source_tables(spark, small))


def rows_of(df):
    """Rows in a comparable form, whatever their order."""
    columns = sorted(df.columns)
    return sorted(
        tuple("~" if v is None else str(v) for v in row) for row in df.select(*columns).collect()
    )
