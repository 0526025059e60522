"""Registered queries against their SQL, and the whole batch end to end.

All queries run with PANELPROJ_ALL=1; by default those that exercise whole operators.
"""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, canonical
from panelproj.catalog import registry
from panelproj.catalog.fixtures import Fixtures
from panelproj.catalog.panel_queries import RULES, TARGET_CITIES, TCM_PRODUCTS
from panelproj.operators.delivery import DELIVERY_COLUMNS
from panelproj.plans import Inputs, Parameters, run_delivery

DATA = "/root/testdata/sf0.001"
CORE = [
    "ingest_csv_roundtrip", "standardize_no_district", "place_map", "combine_panels", "build_universe", "product_master", "tender_packs",
    "knn_impute", "project_nation", "price_levels", "format_delivery", "growth_rollforward", "assemble_delivery", "benchmark_extract",
    "first_by_file_position", "master_by_position", "ingest_problems", "lookup_audit", "cross_source_duplicates", "restatement_report",
    "moving_annual_series", "classify_by_table", "quantile_sketched",
]
NAMES = sorted(registry.queries()) if os.environ.get("PANELPROJ_ALL") else CORE

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="example tables not present")


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = registry.queries()[name](spark, DATA)
    cursor = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), names)


def test_stored_panel_and_universe(spark, rows):
    """Queries that read the panel several times read a stored one with the same rows."""
    fx = Fixtures(spark, DATA)
    assert rows(fx.written_panel) == rows(fx.panel) and rows(fx.written_universe) == rows(fx.universe)
    for stored in (fx.written_panel, fx.written_universe):
        assert not any(DATA in f for f in stored.inputFiles())


def test_sales_are_joined_once(spark):
    """What a query reads several times comes from a written table, not from the joins again."""
    assert not any(DATA in f for f in registry.queries()["quantile_sketched"](spark, DATA).inputFiles())
    folder = spark.conf.get("spark.checkpoint.dir")
    stored = lambda: sum(f.startswith("both-exports-") for f in os.listdir(folder))
    before = stored()
    registry.queries()["first_by_file_position"](spark, DATA)
    assert stored() == before + 1


def test_delivery_run(spark):
    fx = Fixtures(spark, DATA)
    inputs = Inputs(
        panels=[fx.panel.drop("flag")], registry=fx.registry, tiers=fx.tier_listing, master=fx.master, tenders=fx.tenders, rounds=fx.rounds,
        city_names=fx.city_names, history=fx.past, external=fx.external,
    )
    params = Parameters(
        quarter=fx.quarter, target_cities=TARGET_CITIES, impute_region="ASIA", impute_market="Diabetes", missing_city="NATION_20",
        proxy_city="NATION_2", residual_molecule="Others", tcm_products=TCM_PRODUCTS, rules=RULES,
    )
    rows = run_delivery(inputs, params).cache()
    assert set(rows.columns) <= set(DELIVERY_COLUMNS)
    periods = {r[0]: r[1] for r in rows.groupBy("period_type").count().collect()}
    assert set(periods) == {"QTR", "MAT"}
    current = rows.filter((rows.period_type == "QTR") & (rows.date == fx.quarter))
    assert {"National", "NATION_20"} <= {r.city for r in current.select("city").distinct().collect()}
    assert rows.filter("value_lc <= 0 OR units <= 0").count() == 0


def test_run_projects_one_quarter(spark):
    """Rows of other quarters in the panels change nothing."""
    fx = Fixtures(spark, DATA)
    params = Parameters(
        quarter=fx.quarter, target_cities=TARGET_CITIES, impute_region="ASIA", impute_market="Diabetes", missing_city="NATION_20",
        proxy_city="NATION_2", residual_molecule="Others", tcm_products=TCM_PRODUCTS, rules=RULES,
    )

    def national(panel):
        inputs = Inputs(
            panels=[panel], registry=fx.registry, tiers=fx.tier_listing, master=fx.master, tenders=fx.tenders, rounds=fx.rounds,
            city_names=fx.city_names, history=fx.past, external=fx.external,
        )
        rows = run_delivery(inputs, params)
        return rows.filter((rows.city == "National") & (rows.date == fx.quarter) & (rows.period_type == "QTR")).agg({"value_lc": "sum"}).first()[0]

    panel = fx.panel.drop("flag")
    assert national(panel) == pytest.approx(national(panel.filter(panel.quarter == fx.quarter)))
