"""Queries of the panel against their SQL, on small tables made here."""

import duckdb
import pytest

import __spark_entry__ as entry
import check

TABLES = {
    "region": "SELECT i AS r_regionkey, 'R' || i AS r_name FROM range(2) t(i)",
    "nation": "SELECT i AS n_nationkey, 'NATION_' || i AS n_name, i % 2 AS n_regionkey FROM range(12) t(i)",
    "customer": """SELECT i AS c_custkey, 'C' || i AS c_name, i % 12 AS c_nationkey, (i * 997) % 9000 + 1.0 AS c_acctbal,
  ['MACHINERY', 'BUILDING', 'AUTO'][i % 3 + 1] AS c_mktsegment FROM range(1, 25) t(i)""",
    "orders": """SELECT i AS o_orderkey, (i * 7) % 24 + 1 AS o_custkey, ['O', 'F', 'P'][i % 3 + 1] AS o_orderstatus,
  6000.0 + i AS o_totalprice, TIMESTAMP '1995-01-01' + INTERVAL (i * 7) DAY AS o_orderdate,
  ['1-URGENT', '5-LOW'][i % 2 + 1] AS o_orderpriority FROM range(1, 360) t(i)""",
    "part": """SELECT i AS p_partkey, 'P' || i AS p_name, 'Brand#' || i % 4 AS p_brand, ['PROMO', 'SMALL', 'LARGE'][i % 3 + 1] AS p_type,
  i % 50 AS p_size, 1.0 * i AS p_retailprice FROM range(1, 41) t(i)""",
    "lineitem": """SELECT o AS l_orderkey, (o * 13 + n * 5) % 40 + 1 AS l_partkey, o % 5 AS l_suppkey, n AS l_linenumber, 1.0 AS l_quantity,
  10.0 * n AS l_extendedprice, ['R', 'N', 'A'][(o + n) % 3 + 1] AS l_returnflag, ['F', 'O'][(o * n) % 2 + 1] AS l_linestatus,
  TIMESTAMP '1995-01-01' + INTERVAL (o * 7 + n) DAY AS l_shipdate FROM range(1, 360) t(o), range(1, 4) u(n)""",
}


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    db = duckdb.connect()
    for name, text in TABLES.items():
        db.sql(f"COPY ({text}) TO '{folder}/{name}.parquet'")
        db.sql(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return folder, db


def agrees(spark, tables, name):
    folder, db = tables
    got, wanted = entry.queries()[name](spark, folder).toPandas(), db.sql(entry.oracle_sql()[name]).df()
    assert len(wanted) and check.compare(got, wanted) == "ok"
    return got


def test_analytical_set_runs(spark, tables):
    agrees(spark, tables, "analytical_set")


def test_left_join_composite_joins_all_plays_with_the_flagged_ones(spark, tables):
    got = agrees(spark, tables, "left_join_composite")
    assert set(got.columns) == {"showid", "songid", "jammed"} and set(got["jammed"]) == {0, 1}


def test_score_next_is_the_whole_model_on_all_rows(monkeypatch):
    from panelcast.params import ModelParams
    from panelcast.plans import model_queries as m

    asked = []
    monkeypatch.setattr(m, "stored_sets", lambda spark, sf: ("past", "ahead"))
    monkeypatch.setattr(m.M, "fit_and_score", lambda past, ahead, params: asked.append(params))
    monkeypatch.setattr(m, "tidy", lambda df: df)
    entry.queries()["score_next"](None, "")
    assert asked == [ModelParams()] and asked[0].options["n_estimators"] == 555 and "max_depth" not in asked[0].options


@pytest.mark.parametrize("name", ["expanding_median", "lagged_period_join", "prev_period_gap_stats", "show_gap", "scope_gap_stats"])
def test_gaps_are_made_for_the_asked_scopes_only(spark, tables, name):
    """The occurrences with all stats are dealt out eleven times; no query on gaps needs them."""
    from panelcast.plans import queries

    queries.forget_builds()
    agrees(spark, tables, name)
    built = queries.build(spark, tables[0])
    assert not {"play_stats", "jam_stats", "frame"} & built.__dict__.keys()
    wanted = {"expanding_median": {"_state"}, "scope_gap_stats": {"", "_venue", "_run", "_tour", "_state"}}
    assert built._scope_gaps.keys() == wanted.get(name, {""})


@pytest.mark.parametrize("name", ["flagged_branch", "trailing_year"])
def test_overall_gaps_need_no_recency_of_all_scopes(spark, tables, name):
    from panelcast.plans import queries

    queries.forget_builds()
    agrees(spark, tables, name)
    built = queries.build(spark, tables[0])
    assert not {"play_stats", "frame", "recent"} & built.__dict__.keys()
