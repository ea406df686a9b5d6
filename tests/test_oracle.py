"""Every registered query against its DuckDB oracle on the smallest test tables
(the driver runs the same comparison at sf0.01)."""

import pytest

from tools.oracle_check import duck, rows

SF = "/root/testdata/sf0.001"
def _names():
    from __spark_entry__ import oracle_sql
    return sorted(n for n in oracle_sql() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    got = queries()[name](spark, SF).toArrow()
    want = con.sql(oracle_sql()[name]).fetch_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    for c in got.column_names:
        assert str(got.schema.field(c).type).replace("large_", "") == str(want.schema.field(c).type), c
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and "rolling_mean" in df.columns


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    assert not {n for n in set(queries()) - set(oracle_sql()) if not n.startswith("op") and n != "pipeline"}
