import pytest

from limnocast.llm.common import ready


@pytest.fixture(autouse=True)
def session_ready(spark):
    ready(spark)
