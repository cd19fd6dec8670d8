import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_data import ODD, frame, real  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, ODD).where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return frame(spark, real()).cache()
