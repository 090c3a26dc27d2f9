from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strandtide.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="strandtide-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one row."""

    def value(expr, **cells):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()], F.lit(0).alias("_"))
        return row.select(expr.alias("v")).first()["v"]

    return value
