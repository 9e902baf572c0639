from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def same_rows(found, asked) -> None:
    """Two pandas frames hold the same rows, whatever their order; null is null, and 1.0 is 1."""
    import pandas as pd

    columns = sorted(found.columns)
    assert columns == sorted(asked.columns)

    def rows(frame):
        whole = lambda x: None if pd.isna(x) else int(x) if isinstance(x, float) and x.is_integer() else x
        return sorted(repr([str(whole(x)) for x in r]) for r in frame[columns].astype(object).itertuples(index=False))

    assert rows(found) == rows(asked)
