import os
import sys
import tempfile
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
}


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("martloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martloom-test-ckpt-"))
    yield s


def frame(spark, columns: dict[str, str], rows: list[tuple]):
    """A DataFrame from tuples with a declared schema ({name: type})."""
    schema = T.StructType([T.StructField(n, TYPES[t], True) for n, t in columns.items()])
    return spark.createDataFrame(rows, schema)


def full_frame(spark, columns: dict[str, str], rows: list[dict]):
    """A DataFrame from dicts; columns missing in a dict are NULL."""
    names = list(columns)
    return frame(spark, columns, [tuple(r.get(n) for n in names) for r in rows])


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def d(text: str) -> date:
    return date.fromisoformat(text)


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
