import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from lakeprofile.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.log.level": "ERROR"}
    )
    yield session
    session.stop()


def one(df):
    """The single row of a frame as a dict."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def plan_of(df, mode="simple"):
    jvm = df.sparkSession._jvm
    explain = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain)
