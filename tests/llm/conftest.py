import pytest

from tests.llm import inputs


@pytest.fixture(scope="session")
def edge(spark):
    return inputs.documents(spark, inputs.edge_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return inputs.documents(spark, [])
