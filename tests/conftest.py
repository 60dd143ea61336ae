import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        {
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column built from a literal."""
    from pyspark.sql import functions as F

    def evaluate(build, value, kind="string"):
        df = spark.range(1).select(F.lit(value).cast(kind).alias("v"))
        return df.select(build(F.col("v")).alias("r")).first()["r"]

    return evaluate


@pytest.fixture
def rows():
    def sorted_rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return sorted_rows
