"""Every registered query against its oracle SQL on the same tables."""

import pytest

from compare import oracle, table
from sparkq.queries import ORACLES, QUERIES
from sparkq.sources.views import TABLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle(sf_dir, TABLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = table(df.columns, df.collect())
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
