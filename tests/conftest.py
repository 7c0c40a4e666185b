import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventloom.session import get_spark

    os.environ.setdefault("EVENTLOOM_SCRATCH", tempfile.mkdtemp(prefix="eventloom-test-"))
    s = get_spark("local[4]", app="eventloom-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def raw_from_json(spark):
    """Raw VARIANT rows from JSON texts (None -> a malformed/absent row)."""
    from pyspark.sql import functions as F

    def make(lines):
        df = spark.createDataFrame([(x,) for x in lines], "j string")
        return df.select(F.try_parse_json("j").alias("json_data"))
    return make


@pytest.fixture()
def tmp_path_spark(spark):
    from eventloom.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make


@pytest.fixture(scope="session")
def w(spark):
    """The models' workspace over the smallest input, shared by the tests."""
    from eventloom.plans.catalog import Workspace

    return Workspace(spark, SF001)


def rows_of(result):
    """Rows of a Spark or DuckDB result as comparable text, in one order."""
    from tools.check_oracle import norm

    pdf = result.toPandas() if hasattr(result, "toPandas") else result.df()
    return sorted(pdf.columns), norm(pdf)


def oracle(name, sf_dir=SF001):
    """The DuckDB result of a registered query."""
    import duckdb

    from eventloom.plans.oracle import ORACLE

    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{sf_dir}/events.parquet')")
    return con.execute(ORACLE[name])
