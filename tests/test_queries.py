import pytest

from tests.compare import connect, same
from terminus.plans import jobs, more, registry  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    if name in registry.ORACLE_SQL:
        a, b = same(spark, con, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)
        assert a == b
    else:
        assert registry.QUERIES[name](spark, SF).count() >= 0
