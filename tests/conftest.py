import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    s = build_session("local[*]", 8, app_name="strata-tests",
                      extra={"spark.sql.session.timeZone": "UTC"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their scratch folder only when the session names none.
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="strata-test-")
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(root)
    yield s
    from strata.session import release_scratch

    release_scratch(s)
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
