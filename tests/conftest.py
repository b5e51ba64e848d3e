import glob
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from cartoria.functions.lineage import clear

    clear(session)
    session.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return connection


def normal(rows):
    def plain(v):
        if isinstance(v, float):
            return "nan" if v != v else round(v, 6)
        if hasattr(v, "asDict"):
            return tuple(v)
        return v

    return sorted(repr([plain(v) for v in row]) for row in rows)


def same_as_sql(spark, duck, query, sql, directory=DATA):
    got = query(spark, directory)
    columns = sorted(got.columns)
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({sql})")
    assert normal([tuple(r) for r in got.select(*columns).collect()]) == normal(result.fetchall())


@pytest.fixture(scope="session")
def compare(spark, duck):
    return lambda query, sql: same_as_sql(spark, duck, query, sql)
