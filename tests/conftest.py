import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from quire.session import build_session
    warehouse = tempfile.mkdtemp(prefix="quire-warehouse-")
    s = build_session("local[4]", app="quire-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


def text_df(spark, rows, cols=("doc_id", "text")):
    return spark.createDataFrame(rows, list(cols))
