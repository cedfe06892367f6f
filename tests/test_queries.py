import pytest
from compare import connect, differences

import __spark_entry__ as entry
from tidewatch.plans.oracles import ORACLES
from tidewatch.plans.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    frame = QUERIES[name](spark, sf_dir)
    assert differences(frame, ORACLES[name], oracle) is None
