import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from tracklake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a schema to a DataFrame; times are given as text."""

    def make(rows, schema):
        names = [part.split()[0] for part in schema.split(", ")]
        kinds = [part.split()[1] for part in schema.split(", ")]
        texts = ", ".join(f"{n} {'string' if k == 'timestamp' else k}" for n, k in zip(names, kinds))
        df = spark.createDataFrame(rows, texts)
        for n, k in zip(names, kinds):
            if k == "timestamp":
                df = df.withColumn(n, df[n].cast("timestamp"))
        return df

    return make
