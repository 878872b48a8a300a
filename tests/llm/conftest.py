import pytest

from starload.llm.frames import ship


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)
