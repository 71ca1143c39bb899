import pytest


@pytest.fixture
def small():
    return "/root/testdata/sf0.001"
