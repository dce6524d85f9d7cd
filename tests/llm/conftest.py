import pytest

from text_rows import AWKWARD, frame


@pytest.fixture()
def awkward(spark):
    return frame(spark, AWKWARD)


@pytest.fixture()
def nothing(spark):
    return frame(spark, [])
