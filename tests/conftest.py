import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from berthline.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    # Where the session names no spark.checkpoint.dir, berthline.session
    # falls back to a private scratch folder (tests only).
    yield s


def ts(s):
    import datetime as dt
    return None if s is None else dt.datetime.fromisoformat(s)
