import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hopscan.session import use_temporary_folder


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    use_temporary_folder(session)
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, in a stable order."""
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=lambda t: tuple((v is None, str(type(v)), v) for v in t))
