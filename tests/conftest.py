import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", str(base / "wh")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def plain(v):
    return "" if v is None or v is pd.NA or v != v else round(float(v), 6) if isinstance(v, float) else int(v) if hasattr(v, "__index__") and not isinstance(v, bool) else v


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=str)


def by_sql(sql: str, data: str = DATA) -> pd.DataFrame:
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c.sql(sql).df()
