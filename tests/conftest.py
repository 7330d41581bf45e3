import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablejobs.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablejobs-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def plan(capsys):
    """The physical plan of a DataFrame as text."""

    def text(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    return text


def rows(df, *order):
    """Rows as tuples, in the order of the given columns (all of them by default)."""
    found = [tuple(r) for r in df.collect()]
    places = [df.columns.index(c) for c in order] or range(len(df.columns))
    return sorted(found, key=lambda r: [(r[i] is None, repr(r[i])) for i in places])
