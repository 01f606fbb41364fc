import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("pairmill-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.driver.memory", "6g")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one column over one row of named string/array inputs."""
    def run(build, **inputs):
        fields = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}"
                           for k, v in inputs.items())
        df = spark.createDataFrame([tuple(inputs.values())], fields)
        return df.select(build(*[df[k] for k in inputs]).alias("v")).first().v
    return run


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate one column over many rows; each row is one value or a tuple."""
    def run(build, rows, schema="c string"):
        data = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
        df = spark.createDataFrame(data, "i int, " + schema).coalesce(1)
        cols = [df[c] for c in df.columns[1:]]
        return [r.v for r in df.select("i", build(*cols).alias("v")).orderBy("i").collect()]
    return run
