import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lectern.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def facts(spark):
    """Builds enrolments from a few columns; all others are NULL."""
    from pyspark.sql import functions as F

    from lectern import schema

    types = dict(schema.ENROLMENT_COLUMNS)

    def build(columns, rows):
        ddl = ", ".join(f"{c} {types[c]}" for c in columns)
        df = spark.createDataFrame(rows, ddl)
        return df.select(
            *[
                F.col(n) if n in columns else F.lit(None).cast(k).alias(n)
                for n, k in schema.ENROLMENT_COLUMNS
            ]
        )

    return build
