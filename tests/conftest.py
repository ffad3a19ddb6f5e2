import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.lexmill.scratch.dir", str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate one column over one row of literals."""
    from pyspark.sql import functions as F

    def value(col, **literals):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()]) if literals else spark.range(1)
        return df.select(col.alias("x")).first()["x"]

    return value
