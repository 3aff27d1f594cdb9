import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DAY = 86400

# FIXTURES.md §3: (uid, item_id, day, is_organic)
MICRO_LIKES = [
    (1, 10, 100, 1), (1, 10, 200, 0), (1, 20, 300, 1), (1, 30, 300, 1),
    (2, 10, 150, 1), (2, 20, 250, 0),
    (3, 30, 400, 1), (3, 40, 400, 0),
    (4, 99, 50, 1),
]
MICRO_MAPPING = [(10, 1), (20, 1), (30, 2), (40, 2), (40, 3), (50, None)]
MICRO_USERS = [1, 2, 3, 5]


@pytest.fixture(scope="session")
def spark():
    from tandem.session import get_session
    s = get_session("local[4]", app_name="tandem-tests", shuffle_partitions=8,
                    extra_conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def likes(spark):
    rows = [(u, i, d * DAY, o) for u, i, d, o in MICRO_LIKES]
    return spark.createDataFrame(rows, "uid long, item_id long, timestamp long, is_organic int")


@pytest.fixture(scope="session")
def mapping(spark):
    return spark.createDataFrame(MICRO_MAPPING, "item_id long, artist_id long")


@pytest.fixture(scope="session")
def users(spark):
    return spark.createDataFrame([(u,) for u in MICRO_USERS], "uid long")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
