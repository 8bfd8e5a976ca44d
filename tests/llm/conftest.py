import pytest


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    from palmyra.llm.common import prepare_workers
    prepare_workers(spark)
