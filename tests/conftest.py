import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from windrow.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength="10000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def raw(spark, sf):
    from windrow.plans import samples

    return samples.raw_weather(spark, sf)


@pytest.fixture(scope="session")
def bronze(spark, raw):
    from windrow.plans import layers
    from windrow.session import materialise

    return materialise(layers.build_bronze(raw), "bronze")


@pytest.fixture(scope="session")
def silver(bronze):
    from windrow.plans import layers

    return layers.build_silver(bronze)


@pytest.fixture(scope="session")
def gold(spark, silver):
    from windrow.plans import layers
    from windrow.session import materialise

    return materialise(layers.build_gold(silver), "gold")
