"""Every registered query with SQL against DuckDB, on the smallest tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in found), key=lambda r: tuple(map(str, r)))


def test_names_agree():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    rows_only = set(driver.queries()) - set(driver.oracle_sql())
    rows_only = {n for n in rows_only if n != "pipeline" and not n.startswith("op")}
    assert rows_only == {
        "als_user_recs", "als_item_sim", "als_item_topk", "als_grid", "als_best_setting",
        "offline_recs", "content_similarity_hashed", "uv_approx",
    }


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, SF)
    want = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert table(got.columns, got.collect()) == table(columns, want.fetchall())


@pytest.mark.parametrize("name", ["als_user_recs", "als_item_topk", "content_similarity_hashed", "uv_approx"])
def test_rows_only_queries_run(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    got = driver.entry(spark)
    assert got.count() == 20
    assert "avg" in got.columns


@pytest.mark.parametrize("name", ["itemcf_topk", "content_topk", "hot_window_topn", "login_alerts_24h", "rating_upsert", "most_rated_products"])
def test_no_cartesian_products(spark, name):
    plan = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_narrow(spark):
    plan = driver.queries()["rate_more"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    assert "o_totalprice" not in plan
