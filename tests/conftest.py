import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemill.session import session

    folder = str(tmp_path_factory.mktemp("shared"))
    s = session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": folder + "/warehouse",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="session")
def as_rows():
    return rows
