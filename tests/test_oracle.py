"""Every registered query equals its SQL statement run by DuckDB (sf0.001)."""


from gearwatch.plans.catalog import QUERIES
from tests.conftest import SF0001
from tests.oracle_check import compare


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF0001, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK",)}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 752
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
