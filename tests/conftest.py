import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tidemark.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session", autouse=True)
def small_ensembles():
    """The test run fits the registered model queries with 20 trees and 10 rounds, as it always did."""
    from tidemark.ml.candidates import Settings
    from tidemark.plans import registry

    full, registry.ENSEMBLES = registry.ENSEMBLES, Settings(forest_trees=20, boosting_rounds=10)
    yield full
    registry.ENSEMBLES = full
