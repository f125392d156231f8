import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    from paddock.session import build_session, tune

    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
    }
    session = build_session("local[8]", "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, sf):
    from suite.fixtures import racing

    return racing(spark, sf)


def rows(df):
    """Rows as a sorted list of tuples, columns in name order."""
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
