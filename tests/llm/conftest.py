import pytest

from areafacts.llm.common import importable


@pytest.fixture(autouse=True, scope="session")
def workers_find_the_package(spark):
    importable(spark)
