"""The example views once more as SQL text, for the oracle statements."""

import re

from panelproj.catalog.fixtures import ATC4, MARKET, QUARTERS, ROUND_LABELS, TRACKED


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


FACT_KEYS = "year, date, quarter, province, city, district, pchc, market, packid"
PLACE = "province, city, district"

VIEWS = {
    "places": """
        SELECT c_custkey, c_acctbal, r_name AS province, n_name AS city, c_mktsegment AS district,
               replace(c_name, 'Customer#', 'C') AS pchc, floor(c_acctbal) AS est,
               c_name || CASE WHEN c_mktsegment = 'MACHINERY' THEN ' station' ELSE ' centre' END AS hospital
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "packs": f"""
        SELECT *, {_case('p_type', ATC4)} AS atc4, substr({_case('p_type', ATC4)}, 1, 4) AS atc3,
               {_case('p_type', MARKET)} AS market
        FROM (SELECT p_partkey, p_type, p_name, p_size, p_retailprice,
                     lpad(replace(p_brand, 'Brand#', ''), 5, '0') || lpad(CAST(p_size AS VARCHAR), 2, '0') AS packid,
                     'MOL' || lpad(replace(p_brand, 'Brand#', ''), 5, '0') AS molecule,
                     'PROD' || lpad(replace(p_brand, 'Brand#', ''), 5, '0') AS product
              FROM part)""",
    "sales": """
        SELECT l.*, o_orderstatus, pl.*, pk.*, strftime(o_orderdate, '%Y%m') AS date, strftime(o_orderdate, '%Y') AS year,
               strftime(o_orderdate, '%Y') || 'Q' || quarter(o_orderdate) AS quarter,
               l_quantity AS units, floor(l_extendedprice) AS sales
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN places pl ON o_custkey = c_custkey
        JOIN packs pk ON l_partkey = p_partkey""",
    "raw_panel": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN 'P2' ELSE 'P1' END AS project, CAST(year AS INTEGER) AS year, quarter,
               substr(date, 1, 4) || '/' || substr(date, 5, 2) AS month, province || '省' AS province,
               CASE WHEN city = 'NATION_4' THEN '市辖区' ELSE city || '市' END AS city, district AS county,
               hospital AS hospital_name, atc4 AS atc4_code, molecule AS molecule_desc,
               CASE WHEN l_tax <> 0 THEN CAST(CAST(packid AS INTEGER) AS VARCHAR) END AS packcode,
               CASE WHEN l_returnflag <> 'N' THEN units END AS volume,
               CASE WHEN l_discount = 0 THEN 0.0 ELSE sales / units END AS price, sales AS value
        FROM sales""",
    "place_lookup": """
        SELECT province, CASE WHEN city = 'NATION_4' THEN '北京' ELSE city END AS city, district, hospital, pchc
        FROM places WHERE c_acctbal > 0""",
    "market_listing": """
        SELECT atc3, molecule, market FROM packs WHERE p_type <> 'PROMO'
        UNION ALL
        SELECT atc3, molecule, CASE WHEN market = 'HTN' THEN 'IHD' ELSE 'HTN' END FROM packs WHERE atc3 IN ('C07A', 'C08A')""",
    "market_def": "SELECT DISTINCT atc3, molecule, market FROM market_listing",
    "panel_cities": """
        SELECT city FROM (
            SELECT n_name AS city, r_name, count(s_suppkey) AS n
            FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey
            GROUP BY n_name, r_name) c
        WHERE r_name <> 'EUROPE' AND n >= (SELECT count(*) FROM supplier) / (SELECT count(*) FROM nation)""",
    "panel_sales": """
        SELECT * FROM sales
        WHERE (district = 'HOUSEHOLD' OR (district <> 'MACHINERY' AND c_acctbal >= 5000))
          AND city IN (SELECT city FROM panel_cities)""",
    "panel": f"""
        SELECT {FACT_KEYS}, sum(units) AS units, sum(sales) AS sales, 0 AS flag FROM panel_sales GROUP BY {FACT_KEYS}""",
    "universe": """
        SELECT pchc, province, city, district, est,
               CASE WHEN pchc IN (SELECT pchc FROM panel_sales) THEN 1 ELSE 0 END AS flag_sample
        FROM places WHERE est > 0""",
    "registry": """
        SELECT province || '省' AS province, city || '市' AS city, district, pchc, est FROM places
        UNION ALL
        SELECT province || '省', city || '市', district, pchc, o_est
        FROM places JOIN (SELECT o_custkey, sum(floor(o_totalprice)) AS o_est FROM orders WHERE o_orderstatus = 'P'
                          GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "tier_listing": """
        SELECT n_name AS city, CASE WHEN m >= 4700 THEN 1.0 WHEN m >= 4300 THEN 2.0 WHEN m >= 4000 THEN 3.0 END::DOUBLE AS city_tier
        FROM (SELECT n_name, avg(floor(s_acctbal)) AS m FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name) t
        UNION ALL
        SELECT DISTINCT n_name, NULL::DOUBLE FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal < 0
        UNION ALL
        SELECT n_name, 2.0::DOUBLE FROM nation WHERE n_name = 'NATION_7'""",
    "tiers": """
        SELECT DISTINCT city, coalesce(city_tier, min(city_tier) OVER (PARTITION BY city), 5.0)::DOUBLE AS tier FROM tier_listing""",
    "city_names": "SELECT n_name AS city, replace(n_name, 'NATION_', 'City ') AS city_en FROM nation",
    "history": """
        SELECT 'CHC' AS channel, replace(city, 'NATION_', 'City ') AS city_en, city, 'QTR' AS period_type, year,
               substr(quarter, 5, 2) AS quarter, quarter AS date,
               CASE market WHEN 'HTN' THEN max(atc3) ELSE min(atc3) END AS atc3,
               market, market AS category_2, min(molecule) AS molecule, min(product) || ' v' || max(l_linenumber) AS product_name,
               min(product) AS product, CASE WHEN max(l_returnflag) = 'R' THEN 'cn v' || max(l_linenumber) END AS product_cn,
               CAST(CAST(packid AS INTEGER) AS VARCHAR) AS packid,
               CASE min(l_returnflag) WHEN 'A' THEN 'oral' WHEN 'N' THEN 'topical' END AS route,
               CASE WHEN max(l_linestatus) = 'O' THEN 'CORP ' || min(l_returnflag) END AS corp,
               CASE WHEN min(l_discount) = 0 THEN 'R1' END AS tender_round,
               sum(sales) AS value_lc, sum(units) AS units, sum(units * p_size) AS counting_units,
               sum(sales) AS value_lc_raw, sum(units) AS units_raw, sum(units * p_size) AS counting_units_raw
        FROM sales GROUP BY city, year, sales.quarter, market, sales.packid""",
    # The last quarter with orders and the three before it.
    "this_quarter": "SELECT "
    + ", ".join(f"strftime(d - INTERVAL {3 * i} MONTH, '%Y') || 'Q' || quarter(d - INTERVAL {3 * i} MONTH) AS q{i}" for i in range(4))
    + " FROM (SELECT date_trunc('quarter', max(o_orderdate)) AS d FROM orders)",
    "past": "SELECT * FROM history WHERE date < (SELECT q0 FROM this_quarter)",
    "current_q": "SELECT * REPLACE (lpad(packid, 7, '0') AS packid) FROM history WHERE date = (SELECT q0 FROM this_quarter)",
    "pack_growth": """
        SELECT packid AS pack_id, sum(CASE WHEN quarter = q0 THEN sales END) / sum(CASE WHEN quarter = q1 THEN sales END) AS gs,
               sum(CASE WHEN quarter = q0 THEN units END) / sum(CASE WHEN quarter = q1 THEN units END) AS gu
        FROM sales, (SELECT * FROM this_quarter) GROUP BY packid""",
    "residual": """
        SELECT channel, city_en, city, period_type, year, quarter, date, 'Others' AS molecule, 'TCM' AS category_2,
               'Venous Disease' AS market, '99' AS packid, sum(value_lc) AS value_lc, sum(units) AS units,
               sum(counting_units) AS counting_units, sum(value_lc_raw) AS value_lc_raw, sum(units_raw) AS units_raw,
               sum(counting_units_raw) AS counting_units_raw
        FROM history WHERE atc3 = 'V03B' GROUP BY channel, city_en, city, period_type, year, quarter, date""",
    "external": "SELECT packid AS pack_id, min(atc3) AS atc3, min(molecule) AS molecule, min(product) AS product, "
    + ", ".join(
        f'sum(CASE WHEN quarter = \'{q}\' THEN {value} END) AS "{q}_{name}"'
        for q in QUARTERS
        for name, value in (("UNIT", "units"), ("SU", "units * p_size"), ("RENMINBI", "sales"))
    )
    + " FROM sales GROUP BY packid",
    "product_1": """
        SELECT DISTINCT packid, 'CORP ' || p_type AS corp,
               CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'L' WHEN p_type <> 'PROMO' THEN 'I' END AS type,
               atc3, atc4, molecule, product || '  ' || upper(substr(p_name, 1, 3)) AS product,
               CASE p_type WHEN 'PROMO' THEN 'SYRUP' WHEN 'SMALL' THEN 'CAP  20MG X'
                    ELSE 'TAB FILM  ' || p_size || 'MG  ' || CAST(floor(p_retailprice / 100) AS BIGINT) END AS pack
        FROM packs""",
    "product_2": """
        SELECT DISTINCT packid, atc3, 'class ' || atc3 AS atc3_cn, molecule, 'm ' || molecule AS molecule_cn,
               product || '  ' || upper(substr(p_name, 1, 3)) AS product,
               CASE WHEN p_type <> 'MEDIUM' THEN 'cn ' || p_name END AS product_cn,
               CASE p_type WHEN 'LARGE' THEN '口服固体' WHEN 'PROMO' THEN '外用制剂' END AS route
        FROM packs WHERE p_size >= 10""",
    "product_3": "SELECT DISTINCT packid, 'sup ' || p_name AS product_cn, '外用制剂' AS route FROM packs WHERE p_type = 'PROMO'",
    "fallback_names": "SELECT packid, 'alt ' || min(p_name) AS product_cn, '口服固体' AS route FROM packs GROUP BY packid",
    # Rows in the order of their source and of their contents, numbered; NULL sorts last.
    "product_rows": """
        SELECT *, CASE WHEN corp IS NOT NULL THEN replace(corp, 'CORP', '公司') END AS corp_cn,
               row_number() OVER (ORDER BY src, packid, corp, type, atc3, atc4, atc3_cn, molecule, molecule_cn, product,
                   product_cn, pack, route) AS rn
        FROM (SELECT 0 AS src, * FROM product_1 UNION ALL BY NAME SELECT 1 AS src, * FROM product_2
              UNION ALL BY NAME SELECT 2 AS src, * FROM product_3)""",
    "product_filled": """
        SELECT * REPLACE (
            arg_min(atc3_cn, rn) FILTER (WHERE atc3_cn IS NOT NULL) OVER (PARTITION BY atc3) AS atc3_cn,
            arg_min(molecule_cn, rn) FILTER (WHERE molecule_cn IS NOT NULL) OVER (PARTITION BY molecule) AS molecule_cn,
            arg_min(product_cn, rn) FILTER (WHERE product_cn IS NOT NULL) OVER (PARTITION BY product) AS product_cn)
        FROM product_rows""",
    "master_rows": "SELECT packid, "
    + ", ".join(
        f"arg_min({c}, rn) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in "corp corp_cn type atc3 atc4 atc3_cn molecule molecule_cn product product_cn pack route".split()
    )
    + " FROM product_filled GROUP BY packid",
    "master": """
        SELECT m.* REPLACE (coalesce(m.product_cn, f.product_cn) AS product_cn, coalesce(m.route, f.route) AS route)
        FROM master_rows m LEFT JOIN fallback_names f USING (packid)""",
    "tender_parts": """
        SELECT CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 WHEN l_linestatus = 'F' THEN 3 ELSE 4 END AS sheet,
               province, 'm ' || molecule AS molecule_cn, CAST(CAST(packid AS INTEGER) AS VARCHAR) AS pack_id,
               CAST(date_diff('day', DATE '1899-12-30', last_day(CAST(strptime(date, '%Y%m') AS DATE))) AS INTEGER) AS award_serial
        FROM sales WHERE l_discount = 0""",
    "tenders": f"""
        SELECT DISTINCT t.city, p.molecule, t.packid, '中标产品' AS tender_win, t.sheet
        FROM (SELECT 'National' AS city, lpad(pack_id, 7, '0') AS packid, sheet FROM tender_parts
              UNION ALL
              SELECT {_case('province', TRACKED)}, lpad(pack_id, 7, '0'), sheet FROM tender_parts
              WHERE province IN ({', '.join(repr(p) for p in TRACKED)})) t
        JOIN (SELECT DISTINCT substr(packid, 1, 5) AS prodid, molecule FROM product_1) p ON p.prodid = substr(t.packid, 1, 5)""",
    "rounds": f"""
        SELECT DISTINCT city, molecule, CASE WHEN sheet = 2 AND city = 'National' THEN '4+7'
            ELSE {_case('sheet', ROUND_LABELS).replace("WHEN '", "WHEN ").replace("' THEN", " THEN")} END AS tender_round
        FROM tenders WHERE molecule <> 'MOL00001'""",
}


def with_views(body: str, **extra: str) -> str:
    """`body` preceded by the views it uses, directly or through other views."""
    known = {**VIEWS, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text, re.IGNORECASE):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" for n in needed) + "\n" + body
