import pytest
from compare import connect, differences

from tidewatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
