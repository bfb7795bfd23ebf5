import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ratelens.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ratelens-test-")


def ratings_df(spark, rows):
    """rows of (customer_id, movie_id, rating, 'YYYY-MM-DD')."""
    import datetime as dt
    from ratelens.schemas import RATINGS
    data = [(int(c), int(m), int(r), dt.date.fromisoformat(d)) for c, m, r, d in rows]
    return spark.createDataFrame(data, RATINGS)
