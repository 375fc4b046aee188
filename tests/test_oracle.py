"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SF = "/root/testdata/sf0.001"
# the text operators have tests of their own
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems


def test_raw_percent_is_compared_unrounded(spark, con):
    rows = QUERIES["pair_rules_unrounded_percent"](spark, SF).collect()
    want = {r[:2]: r[2:] for r in con.sql(ORACLES["pair_rules_unrounded_percent"]).fetchall()}
    assert {(r.p1, r.p2): (r.support_pct, r.confidence_pct) for r in rows} == want
    assert any(r.confidence_pct != round(r.confidence_pct, 6) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["p1", "p2", "pair_count", "support", "confidence"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["monthly_top5", "monthly_revenue_full", "pair_rules", "month_prefix",
                                  "pair_counts_events_grid"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.ansi.enabled": "false",
             "spark.sql.session.timeZone": "America/Sao_Paulo", "spark.sql.shuffle.partitions": "3"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        n, problems = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert not problems, problems
