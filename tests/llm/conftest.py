import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture
def sf001():
    return SF001
