import pytest

from outledger.llm.frames import ship_package


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark
