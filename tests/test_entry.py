"""The driver contract: entry() runs on sf0.001, every oracle has a query, and every query of
the core matches its SQL at sf0.001 (tests/oracle_check.py does the same at other sizes; tests/llm has its own)."""

import pytest

import __spark_entry__ as ent
import oracle_check as oc
from conftest import SF001
from raresight.catalog import ORACLE

def test_entry_schema(spark):
    df = ent.entry(spark)
    assert df.columns == ["threshold", "expected_cost", "fp", "fn", "tp", "tn"]
    assert df.count() == 1


def test_every_oracle_has_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = oc.duck(SF001)
    r = oc.compare(spark, con, name, ent.queries()[name], ent.oracle_sql()[name], SF001)
    assert r["status"] in ("exact", "close") and "types" not in r, r
