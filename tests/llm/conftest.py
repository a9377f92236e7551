import pytest

from anticipa.llm.common import ship_code


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship_code(spark)
