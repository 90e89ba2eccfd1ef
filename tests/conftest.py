import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    s = build_session("local[4]", 4, app_name="quarry-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def corpus4(spark):
    # fixed values: the four-document corpus of the golden sizes (position = id)
    rows = [(0, "декан студент факультет"), (1, "декан преподаватель"),
            (2, "преподаватель экзамен"), (3, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")
