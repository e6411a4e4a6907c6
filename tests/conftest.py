import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kiln.session import get_session
    s = get_session("local[4]", app="kiln-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kiln-test-ckpt-"))
    yield s


def frame(spark, cols, rows, seq=True):
    """All-text frame with an explicit landing order."""
    from pyspark.sql import types as T
    fields = [T.StructField(c, T.StringType(), True) for c in cols]
    data = [tuple(r) for r in rows]
    if seq:
        fields.append(T.StructField("_seq", T.LongType(), False))
        data = [tuple(r) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, T.StructType(fields))
