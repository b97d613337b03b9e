import itertools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators.lake import Lake  # noqa: E402
from tidemark.session import local_session  # noqa: E402

_numbers = itertools.count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4, "6g", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, f"lake_{next(_numbers)}", str(tmp_path / "lake"))
    yield made
    made.drop()
