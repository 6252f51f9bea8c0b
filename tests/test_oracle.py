"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from oracle_check import compare, duck
from inkline.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    res = compare(spark, key, SF, con)
    assert res["status"] == "match", res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_checks_are_not_empty(spark):
    """Filters drop something and keep something; each reason and each depth occurs."""
    n = QUERIES["page_scan"](spark, SF).count()
    for key in ("page_guards", "require_complete", "rejects_by_reason"):
        assert 0 < QUERIES[key](spark, SF).count() < n, key
    assert QUERIES["frontier_anti_join"](spark, SF).count() < QUERIES["link_extract"](spark, SF).count()
    assert {r.reason for r in QUERIES["rejects_by_reason"](spark, SF).select("reason").distinct().collect()} == {"url_excluded", "no_container", "no_title", "bad_date"}
    assert QUERIES["link_closure"](spark, "/root/testdata/sf0.01").select("depth").distinct().count() >= 3
