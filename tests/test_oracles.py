"""Every query of the reference's operators against its SQL, at the smallest scale."""

import pytest

import oracle
from corpuskiln.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query_agrees_with_sql(spark, name):
    assert oracle.compare(spark, SF, name) == ""


def test_every_sql_has_a_query():
    assert set(REGISTRY.sql) <= set(REGISTRY.queries)


def test_entry_gives_the_known_reasons(spark):
    import __spark_entry__ as entry

    got = {r["fail_reason"]: r["n"] for r in entry.entry(spark).collect()}
    assert got == {"exact_duplicate": 11, "long_lines": 177, "too_few_lang_tokens": 9, "ok": 3}
