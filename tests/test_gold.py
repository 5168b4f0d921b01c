from __future__ import annotations

import pytest

from storelake.operators import cleaning
from storelake.plans import analytics, gold
from storelake.sources import testbed
from storelake.sources.tables import PERIOD

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold") / "tables")
    return gold.build_gold(
        testbed.pos(spark, SF_DIR), testbed.erp_orders(spark, SF_DIR),
        testbed.iot_readings(spark, SF_DIR), root, grain="year",
    )


def test_reports_over_sql_views(spark, stored):
    gold.register_views(stored)
    by_sql = spark.sql(
        "SELECT category, rank() OVER (ORDER BY sum(total_revenue) DESC) AS r "
        "FROM fct_daily_sales GROUP BY category"
    )
    by_api = analytics.revenue_by_category(stored["fct_daily_sales"]).select("category", "revenue_rank")
    assert sorted(map(tuple, by_sql.collect())) == sorted(map(tuple, by_api.collect()))


def test_margin_ranking_over_stored_fact(stored):
    ranked = analytics.store_margin_ranking(stored["fct_gross_margin"])
    assert ranked.count() == stored["fct_gross_margin"].count()
    assert {r.revenue_quartile for r in ranked.collect()} == {1, 2, 3, 4}


def test_date_range_reads_its_periods_only(stored):
    days = stored["mv_store_revenue"]
    ranged = cleaning.between(days, "report_date", "1998-10-01", "1999-02-01")
    without = cleaning.between(days.drop(PERIOD), "report_date", "1998-10-01", "1999-02-01")
    assert ranged.drop(PERIOD).exceptAll(without).count() == 0
    assert ranged.count() == without.count() > 0
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_gold_queries_derive_the_lines_once(spark, monkeypatch):
    from storelake.catalog import jobs

    read = []
    pos, erp = jobs.gold.POS_NEEDS, jobs.gold.ERP_NEEDS
    for name, columns in (("pos", pos), ("erp_orders", erp), ("iot_readings", ["event_id"])):
        one = spark.createDataFrame([tuple(columns)], columns)
        monkeypatch.setattr(jobs.testbed, name, lambda *_, one=one: one)
    monkeypatch.setattr(
        jobs.gold, "build_gold",
        lambda p, e, *_, **__: read.extend([(p.columns, p.inputFiles()), (e.columns, e.inputFiles())]),
    )
    jobs._gold(jobs.Job(spark, "none", "gold_once"))
    assert [columns for columns, _ in read] == [pos, erp]
    assert all(files and all("/lines/" in f for f in files) for _, files in read)
