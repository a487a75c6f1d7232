import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from wardframe.session import configure

    return configure(session)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame in a stable order, floats rounded."""

    def clean(v):
        return round(v, 6) if isinstance(v, float) else v

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(clean(v) for v in r) for r in chosen.collect()), key=repr)

    return collect
