import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from stationdw.session import build_session  # noqa: E402

DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app="stationdw-tests", shuffle_partitions=8,
                            conf={"spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def four_station(spark):
    from tests.climate_fixture import four_station_star
    return four_station_star(spark)
