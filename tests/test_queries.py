"""Every registered query against its oracle SQL, and the shape of the main plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cratewise.operators import canonical
from cratewise.sources.stage import Stage
from verification import adapters
from verification.compare import differences, oracle_connection
from verification.oracle import ORACLE_SQL
from verification.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE_SQL[name]) == []


def test_contract():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_flagship_plan(spark, capsys):
    plan = plan_of(entry.entry(spark), capsys)
    # One row per cluster and task leaves for the final ranking.
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_filters_and_columns_reach_a_stored_table(spark, capsys):
    release = Stage(spark).save("release", adapters.release(adapters.Star(spark, SF)))
    plan = plan_of(canonical.official_releases(release), capsys)
    assert "EqualTo(status,1)" in plan
    assert "ReadSchema: struct<id:bigint,artist_credit:bigint,release_group:bigint,status:int>" in plan


@pytest.mark.parametrize(
    "name", ["text_lookup", "link_lookup", "dim_recording", "history_resolve", "closed_sample_track"]
)
def test_plans_stay_in_the_engine(spark, capsys, name):
    plan = plan_of(QUERIES[name](spark, SF), capsys)
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
