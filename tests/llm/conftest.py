import pytest


@pytest.fixture(scope="session")
def sf_tiny():
    return "/root/testdata/sf0.001"
