"""Every registered query against its DuckDB oracle (rows, columns, order-insensitive values) at sf0.001."""
import pytest

from conftest import SF001
from tools.check import digest

import __spark_entry__ as E

NAMES = sorted(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck001, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck001.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_oracle():
    assert set(E.queries()) - set(E.LLM_QUERIES) - {"pipeline"} <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[0] == "rpl_operation" and df.columns[-1] == "sourcerv"
