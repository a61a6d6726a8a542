import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pulsekit.session import build_session

    # local runs only: a scratch checkpoint folder when the session names none
    extra = {}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="pulsekit-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, app_name="pulsekit-tests", extra=extra)
    yield s
