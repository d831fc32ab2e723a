import pytest

from check_oracle import compare, connect
from loglathe.llm.catalog import ORACLE
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, name):
    same, note = compare(spark, con, name, SMALL)
    assert same, note
