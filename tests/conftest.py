import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from inkline.session import get_spark
    s = get_spark("local[4]", app_name="inkline-tests", shuffle_partitions=4)
    s.conf.set("spark.sql.session.timeZone", "UTC")
    yield s
    s.stop()


def one(spark, col, value, schema="x string"):
    """Evaluate a Column builder on a one-row frame."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col(df.columns[0]) if callable(col) else col).first()[0]
