import pytest

import __spark_entry__ as E
from tests.oracle_check import digest, duck

from tests.conftest import SF_CHECK, SF_SMALL


# a query that compares nothing proves nothing: these find rows at the next scale factor only
NEED_MORE_ROWS = {"new_active_topk", "time_range_filter"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["coin_id", "name", "read_timestamp", "price"]


def test_every_oracle_names_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, name):
    sf_dir = SF_CHECK if name in NEED_MORE_ROWS else SF_SMALL
    df = E.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert rows, f"{name} returns no rows"
    if sql is None:
        return
    cur = duck(sf_dir).execute(sql)
    orows = cur.fetchall()
    ocols = [c[0] for c in cur.description]
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
