import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkcat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="tests", memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column function on literal values, one row each."""
    def run(fn, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        from pyspark.sql import functions as F
        return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]
    return run


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from JSON texts."""
    def build(*texts, **columns):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, t string")
        return df.select("doc_id", F.parse_json("t").alias("body"))
    return build
