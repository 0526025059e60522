"""Text and period functions, standardisation, projection, delivery and review."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.catalog.fixtures import QUARTERS, ROUND_LABELS, TRACKED, Fixtures
from panelproj.catalog.registry import query, rounded
from panelproj.catalog.sql_views import FACT_KEYS, PLACE, with_views
from panelproj.functions import (
    drop_suffix,
    excel_serial_date,
    half_even,
    month_to_quarter,
    pad_code,
    parse_pack,
    ratio,
    remap_prefix,
    safe_int,
    strip_pattern,
    substring_between,
)
from panelproj.operators.delivery import MEASURES, DeliveryRules, classify, format_delivery, national_rollup, split_markets
from panelproj.operators.dims import build_universe, city_tier, product_master, tender_packs, tender_rounds
from panelproj.operators.impute import knn_impute, knn_neighbours, knn_weights
from panelproj.operators.periods import assemble_delivery, growth_rollforward, moving_annual_total, self_rollforward
from panelproj.operators.price import update_price
from panelproj.operators.project import (
    district_mapping,
    donor_facts,
    nearest_district_donor,
    nearest_tier_donor,
    project_nation,
    project_sample,
    tier_districts,
)
from panelproj.operators.review import benchmark_extract, price_check_matrix, tender_coverage, uniformity_report
from panelproj.operators.standardize import (
    FACT_COLUMNS,
    channel_extract,
    clean_city,
    combine_panels,
    derived_units,
    market_definition,
    place_map,
    standardize_panel,
)
from panelproj.sources import materialize

SUCCESSION = {"00007": "00008", "00012": "00099"}
PLACE_COLUMNS = ["province", "city", "district"]
NO_DONORS = ["AFRICA"]


# --- text, codes, periods ------------------------------------------------------------


@query(
    "str_clean",
    with_views("""
    SELECT hospital_name, replace(month, '/', '') AS date, regexp_replace(province, '省|市', '', 'g') AS province,
           CASE WHEN city = '市辖区' THEN '北京' ELSE replace(city, '市', '') END AS city FROM raw_panel"""),
)
def str_clean(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.select(
        "hospital_name",
        strip_pattern("month", "/").alias("date"),
        strip_pattern("province", "省|市").alias("province"),
        clean_city("city").alias("city"),
    )


@query("str_substr", with_views("SELECT p_partkey, substr(packid, 1, 5) AS prodid, substr(packid, 6, 2) AS suffix, substr(atc4, 1, 3) AS atc2 FROM packs"))
def str_substr(fx: Fixtures) -> DataFrame:
    return fx.packs.select(
        "p_partkey",
        substring_between("packid", 1, 5).alias("prodid"),
        substring_between("packid", 6, 7).alias("suffix"),
        substring_between("atc4", 1, 3).alias("atc2"),
    )


@query("str_drop_suffix", "SELECT p_partkey, trim(substr(p_name, 1, length(p_name) - 3)) AS short_name FROM part")
def str_drop_suffix(fx: Fixtures) -> DataFrame:
    return fx.table("part").select("p_partkey", drop_suffix("p_name", 3).alias("short_name"))


_PAD = "CASE WHEN length(packcode) >= 7 THEN packcode ELSE lpad(packcode, 7, '0') END"


@query(
    "code_pad",
    with_views(f"SELECT hospital_name, month, packcode, {_PAD} AS packid, CASE WHEN length(packcode) >= 3 THEN '9' || packcode ELSE lpad('9' || packcode, 4, '0') END AS short FROM raw_panel"),
)
def code_pad(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.select(
        "hospital_name", "month", "packcode", pad_code("packcode").alias("packid"),
        pad_code(F.concat(F.lit("9"), "packcode"), 4).alias("short"),
    )


_REMAP = """CASE substr(packid, 1, 5) WHEN '00007' THEN '00008' || substr(packid, 6) WHEN '00012' THEN '00099' || substr(packid, 6) ELSE packid END"""


@query("code_remap", with_views(f"SELECT p_partkey, {_REMAP} AS packid FROM packs"))
def code_remap(fx: Fixtures) -> DataFrame:
    return fx.packs.select("p_partkey", remap_prefix("packid", SUCCESSION).alias("packid"))


@query(
    "pack_parse",
    with_views(r"""
    SELECT packid, pack,
        nullif(trim(regexp_replace(regexp_extract(pack, '^([^0-9]*)[0-9]', 1), '\s+', ' ', 'g')), '') AS pack_form,
        CASE WHEN regexp_matches(pack, '\s')
             THEN nullif(trim(regexp_replace(regexp_extract(regexp_extract(pack, '^(.*)\s[^\s]*$', 1), '[0-9].*$'), '\s+', ' ', 'g')), '') END
            AS pack_strength,
        CASE WHEN regexp_matches(pack, '\s') THEN CAST(TRY_CAST(trim(regexp_extract(pack, '\s([^\s]*)$', 1)) AS DOUBLE) AS INTEGER) END AS pack_size
    FROM (SELECT DISTINCT packid, pack FROM product_1)"""),
)
def pack_parse(fx: Fixtures) -> DataFrame:
    return parse_pack(fx.product_sources[0].select("packid", "pack").distinct())


@query(
    "safe_cast",
    with_views("SELECT hospital, TRY_CAST(split_part(hospital, '#', 2) AS INTEGER) AS whole, TRY_CAST(substr(hospital, 10, 10) AS INTEGER) AS digits FROM places"),
)
def safe_cast(fx: Fixtures) -> DataFrame:
    return fx.places.select(
        "hospital",
        safe_int(F.split_part("hospital", F.lit("#"), F.lit(2))).alias("whole"),
        safe_int(F.substring("hospital", 10, 10)).alias("digits"),
    )


@query(
    "excel_serial_date",
    with_views("""
    SELECT sheet, province, pack_id, award_serial, CAST(DATE '1899-12-30' + award_serial AS VARCHAR) AS award_date FROM tender_parts"""),
)
def excel_serial_date_query(fx: Fixtures) -> DataFrame:
    return fx.tender_parts.select("sheet", "province", "pack_id", "award_serial", excel_serial_date("award_serial").alias("award_date"))


@query("month_to_quarter", with_views("SELECT date, strftime(d, '%Y') || 'Q' || quarter(d) AS quarter, n FROM (SELECT date, CAST(strptime(date, '%Y%m') AS DATE) AS d, count(*) AS n FROM sales GROUP BY ALL)"))
def month_to_quarter_query(fx: Fixtures) -> DataFrame:
    return fx.sales.groupBy("date").agg(F.count("*").alias("n")).withColumn("quarter", month_to_quarter("date"))


@query("round_half_even", with_views("SELECT packid, city, date, round_even(value_lc / 2, 0) AS half, round_even(units / 8, 0) AS eighth FROM history"))
def round_half_even(fx: Fixtures) -> DataFrame:
    return fx.history.select(
        "packid", "city", "date", half_even(F.col("value_lc") / 2).alias("half"), half_even(F.col("units") / 8).alias("eighth")
    )


_UNITS = "coalesce(volume, CASE WHEN price <> 0 THEN value / price WHEN value > 0 THEN 'inf'::DOUBLE END)"


@query("derive_units", with_views(f"SELECT hospital_name, month, value, {_UNITS} AS units FROM raw_panel"))
def derive_units(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.select("hospital_name", "month", "value", derived_units().alias("units"))


# --- standardisation ------------------------------------------------------------------


def _market_def(fx: Fixtures) -> DataFrame:
    return market_definition(fx.market_listing, [])


_CLEANED = f"""
    SELECT DISTINCT CAST(year AS VARCHAR) AS year, quarter, replace(month, '/', '') AS date, replace(province, '省', '') AS province,
           CASE WHEN city = '市辖区' THEN '北京' ELSE replace(city, '市', '') END AS city, county AS district,
           hospital_name AS hospital, substr(atc4_code, 1, 4) AS atc3, molecule_desc AS molecule, {_PAD} AS packid,
           %s {_UNITS} AS units, value AS sales
    FROM raw_panel %s"""
_STANDARD = f"""
    SELECT year, date, quarter, province, city, district, pchc, market, {_REMAP} AS packid, units, sales
    FROM cleaned JOIN place_lookup USING (%s) JOIN market_def USING (atc3, molecule) WHERE units > 0 AND sales > 0"""


@query(
    "standardize_panel",
    with_views(_STANDARD % "province, city, district, hospital", cleaned=_CLEANED % ("", "WHERE project = 'P1'")),
)
def standardize_panel_query(fx: Fixtures) -> DataFrame:
    return standardize_panel(fx.raw_panel, fx.place_lookup, _market_def(fx), projects=["P1"], succession=SUCCESSION)


@query(
    "standardize_coded",
    with_views(
        _STANDARD % "province, city, district, hospital",
        cleaned=_CLEANED % ("", "WHERE project IN ('P1', 'P2') AND packcode IS NOT NULL AND province <> 'AFRICA省'"),
    ),
)
def standardize_coded(fx: Fixtures) -> DataFrame:
    return standardize_panel(
        fx.raw_panel, fx.place_lookup, _market_def(fx), projects=["P1", "P2"], require_code=True,
        exclude_provinces=["AFRICA省"], succession=SUCCESSION,
    )


@query(
    "standardize_no_district",
    with_views(
        (_STANDARD % "province, city, hospital"),
        cleaned="SELECT DISTINCT * EXCLUDE (province, city, district), 'AMERICA' AS province, 'NATION_6' AS city FROM cleaned_all",
        cleaned_all=_CLEANED % ("price,", ""),
    ),
)
def standardize_no_district(fx: Fixtures) -> DataFrame:
    """A file that names no places belongs to one city; other cities' centres find no match."""
    raw = fx.raw_panel.drop("province", "city", "county")
    return standardize_panel(
        raw, fx.place_lookup, _market_def(fx), place={"province": "AMERICA", "city": "NATION_6"}, succession=SUCCESSION
    )


@query(
    "place_map",
    with_views("""
    SELECT DISTINCT * FROM (
        SELECT province, city, district, hospital, arg_min(pchc, rn) AS pchc FROM named WHERE est > 0 GROUP BY ALL
        UNION ALL
        SELECT province, city, district, district || ' of ' || city, arg_min(pchc, rn) FROM named WHERE est >= 5000 GROUP BY ALL)""",
        named="SELECT *, row_number() OVER (ORDER BY est, pchc) AS rn FROM places"),
)
def place_map_query(fx: Fixtures) -> DataFrame:
    registry = fx.places.select(
        *PLACE_COLUMNS,
        "est",
        "hospital",
        F.when(F.col("est") >= 5000, F.concat_ws(" of ", "district", "city")).alias("alias"),
        F.when(F.col("est") > 0, F.col("pchc")).alias("pchc"),
    )
    return place_map(
        registry.withColumnRenamed("hospital", "name"), ["name", "alias"], ["est", "pchc"]
    )


@query(
    "combine_panels",
    with_views(
        f"""
    SELECT year, date, quarter, p.province, p.city, p.district, f.pchc, market, packid, sum(units) AS units, sum(sales) AS sales, 0 AS flag
    FROM stacked f JOIN (SELECT pchc, arg_min(province, rn) AS province, arg_min(city, rn) AS city,
                                arg_min(district, rn) FILTER (WHERE district IS NOT NULL) AS district FROM stacked GROUP BY pchc) p
    USING (pchc) GROUP BY ALL""",
        stacked=f"""
        SELECT *, row_number() OVER (ORDER BY src, date, market, packid, province, city, district) AS rn FROM (
            SELECT 0 AS src, year, date, quarter, province, city, CASE WHEN p_type <> 'LARGE' THEN district END AS district,
                   pchc, market, packid, units, sales FROM sales WHERE o_orderstatus = 'P'
            UNION ALL
            SELECT 1, year, date, quarter, province, 'Z ' || city, district, pchc, market, packid, units, sales
            FROM sales WHERE o_orderstatus <> 'P')""",
    ),
)
def combine_panels_query(fx: Fixtures) -> DataFrame:
    """Two sources that disagree on the place: one lacks districts, the other spells cities differently."""
    first = fx.sales.filter(F.col("o_orderstatus") == "P").withColumn(
        "district", F.when(F.col("p_type") != "LARGE", F.col("district"))
    )
    second = fx.sales.filter(F.col("o_orderstatus") != "P").withColumn("city", F.concat(F.lit("Z "), "city"))
    return combine_panels(first.select(*FACT_COLUMNS), second.select(*FACT_COLUMNS), parts=fx.parts)


@query(
    "channel_extract",
    with_views(
        """
    SELECT date, province, city, district, market, packid, sum(sales) AS sales, floor(sum(units) * 10000 + 0.5) / 10000 AS units,
           'CHS' AS channel, 1 AS flag_sample
    FROM cleaned JOIN market_def USING (atc3, molecule) GROUP BY date, province, city, district, market, packid""",
        cleaned=(_CLEANED % ("price,", "WHERE regexp_matches(hospital_name, 'station')")).replace(
            _UNITS, "CASE WHEN price <> 0 THEN value / price WHEN value > 0 THEN 'inf'::DOUBLE END"
        ),
    ),
)
def channel_extract_query(fx: Fixtures) -> DataFrame:
    return rounded(channel_extract(fx.raw_panel, _market_def(fx), name_pattern="station", channel="CHS"), units=4)


# --- universe and product lookups ----------------------------------------------------------


@query(
    "build_universe",
    with_views("""
    SELECT r.pchc, r.province, CASE WHEN s.pchc IS NULL THEN r.city ELSE 'P ' || r.city END AS city, r.district, r.est,
           CASE WHEN s.pchc IS NULL THEN 0 ELSE 1 END AS flag_sample
    FROM (SELECT pchc, province, city, district, sum(est) AS est FROM (
              SELECT DISTINCT replace(province, '省', '') AS province, replace(city, '市', '') AS city, district, pchc, est FROM registry)
          WHERE est > 0 GROUP BY ALL) r
    LEFT JOIN (SELECT DISTINCT pchc FROM panel) s USING (pchc)"""),
)
def build_universe_query(fx: Fixtures) -> DataFrame:
    """The facts spell the city differently, and a sampled centre keeps the facts' spelling."""
    return build_universe(fx.panel.withColumn("city", F.concat(F.lit("P "), "city")), fx.registry)


@query("city_tier", with_views("SELECT * FROM tiers"))
def city_tier_query(fx: Fixtures) -> DataFrame:
    return city_tier(fx.tier_listing, ["city_tier"])


@query("product_master", with_views("SELECT * FROM master"))
def product_master_query(fx: Fixtures) -> DataFrame:
    return product_master(fx.product_sources, fx.corporations, fx.fallback_names)


@query("tender_packs", with_views("SELECT * FROM tenders"))
def tender_packs_query(fx: Fixtures) -> DataFrame:
    return tender_packs(fx.tender_parts, fx.product_sources[0], city_of_province=TRACKED)


@query("tender_rounds", with_views("SELECT * FROM rounds"))
def tender_rounds_query(fx: Fixtures) -> DataFrame:
    return tender_rounds(fx.tenders, labels=ROUND_LABELS, merge_national=("扩围", "4+7"), exclude_molecules=["MOL00001"])


# --- imputation --------------------------------------------------------------------------------

_KNN_VIEWS = {
    "monthly": f"""
        SELECT {PLACE}, pchc, date, sum(sales) AS s
        FROM (SELECT DISTINCT date, {PLACE}, pchc, packid, sales FROM panel) GROUP BY ALL""",
    "grid": f"""
        SELECT c.*, m.date, coalesce(s, 0) AS s
        FROM (SELECT DISTINCT {PLACE}, pchc FROM panel) c CROSS JOIN (SELECT DISTINCT date FROM panel) m
        LEFT JOIN monthly USING (province, city, district, pchc, date)""",
    "deviation": "SELECT date, stddev_samp(s) AS sd FROM grid WHERE province <> 'ASIA' GROUP BY date",
    "vectors": f"""
        SELECT {PLACE}, pchc, list(CASE WHEN sd > 0 THEN s / sd ELSE 0 END ORDER BY date) AS v
        FROM grid JOIN deviation USING (date) GROUP BY ALL""",
    "neighbours": """
        SELECT t.province, t.city, t.district, t.pchc, d.pchc AS knn_pchc, list_distance(t.v, d.v) AS distance,
               row_number() OVER (PARTITION BY t.pchc ORDER BY list_distance(t.v, d.v), d.pchc) AS rank
        FROM (SELECT * FROM vectors WHERE province = 'ASIA') t, (SELECT * FROM vectors WHERE province <> 'ASIA') d
        QUALIFY rank <= 3""",
    "weights": """
        SELECT province, city, district, pchc, unnest([1, 2, 3]) AS rank, unnest([p1, p2, p3]) AS knn_pchc,
               unnest([a1, w2 / (a1 + w2 + w3), w3 / (a1 + w2 / (a1 + w2 + w3) + w3)]) AS knn_weight
        FROM (SELECT *, w1 / (w1 + w2 + w3) AS a1 FROM (
            SELECT province, city, district, pchc,
                   max(CASE WHEN rank = 1 THEN 1 / (distance + 1) END) AS w1, max(CASE WHEN rank = 2 THEN 1 / (distance + 1) END) AS w2,
                   max(CASE WHEN rank = 3 THEN 1 / (distance + 1) END) AS w3, max(CASE WHEN rank = 1 THEN knn_pchc END) AS p1,
                   max(CASE WHEN rank = 2 THEN knn_pchc END) AS p2, max(CASE WHEN rank = 3 THEN knn_pchc END) AS p3
            FROM neighbours GROUP BY ALL))""",
}


@query(
    "knn_neighbours",
    with_views("SELECT province, city, district, pchc, rank, knn_pchc, floor(distance * 1000000 + 0.5) / 1000000 AS distance FROM neighbours", **_KNN_VIEWS),
)
def knn_neighbours_query(fx: Fixtures) -> DataFrame:
    return rounded(knn_neighbours(fx.panel, target="ASIA", parts=fx.parts), distance=6)


@query(
    "knn_weights",
    with_views("SELECT province, city, district, pchc, rank, knn_pchc, floor(knn_weight * 100000000 + 0.5) / 100000000 AS knn_weight FROM weights", **_KNN_VIEWS),
)
def knn_weights_query(fx: Fixtures) -> DataFrame:
    return rounded(knn_weights(knn_neighbours(fx.panel, target="ASIA", parts=fx.parts)), knn_weight=8)


@query(
    "knn_impute",
    with_views(
        f"""
    SELECT year, date, quarter, w.province, w.city, w.district, w.pchc, market, packid, floor(sum(units * knn_weight) * 10000 + 0.5) / 10000 AS units,
           floor(sum(sales * knn_weight) * 100 + 0.5) / 100 AS sales, 1 AS flag
    FROM weights w JOIN panel f ON f.pchc = w.knn_pchc AND f.province <> 'ASIA' AND market = 'Diabetes' GROUP BY ALL""",
        **_KNN_VIEWS,
    ),
)
def knn_impute_query(fx: Fixtures) -> DataFrame:
    return rounded(knn_impute(fx.panel, target="ASIA", market="Diabetes", parts=fx.parts), units=4, sales=2)


# --- projection ----------------------------------------------------------------------------------

_DONOR_VIEWS = {
    "mapping": f"SELECT {PLACE}, avg(est) AS est, sum(flag_sample) AS sample FROM universe GROUP BY ALL",
    "candidates": """
        SELECT d.*, s.city AS sample_city, s.district AS sample_dist, s.est AS sample_est, abs(d.est - s.est) AS diff,
               CASE WHEN d.city = s.city AND d.district = s.district THEN 1 ELSE 2 END AS prio
        FROM mapping d JOIN mapping s ON d.province = s.province AND s.sample > 0""",
    "closest": f"""
        SELECT * FROM (SELECT * FROM candidates QUALIFY prio = 1 OR diff = min(diff) OVER (PARTITION BY {PLACE}))
        QUALIFY prio = min(prio) OVER (PARTITION BY {PLACE})""",
    "donors": f"""
        SELECT {PLACE}, sample_city, sample_dist FROM closest
        QUALIFY sample_dist = first_value(sample_dist) OVER (PARTITION BY {PLACE} ORDER BY sample_city, sample_est DESC, sample_dist)""",
}
_PROJECT_VIEWS = {
    **_DONOR_VIEWS,
    "combos": f"SELECT DISTINCT {PLACE}, market, packid, date FROM panel",
    "literal": """
        SELECT d.sample_dist, u.*, c.market, c.packid, c.date,
               CASE WHEN u.flag_sample = 1 THEN coalesce(f.sales, 0) ELSE f.sales END AS sales,
               CASE WHEN u.flag_sample = 1 THEN coalesce(f.units, 0) ELSE f.units END AS units
        FROM donors d JOIN universe u USING (province, city, district)
        JOIN combos c ON c.province = d.province AND c.city = d.sample_city AND c.district = d.sample_dist
        LEFT JOIN panel f ON (f.province, f.city, f.district, f.pchc, f.market, f.packid, f.date)
                           = (u.province, u.city, u.district, u.pchc, c.market, c.packid, c.date)""",
    "rates": """
        SELECT sample_dist, market, packid, date, avg(flag_sample) AS share,
               sum(sales) FILTER (WHERE flag_sample = 1) / sum(est) FILTER (WHERE flag_sample = 1) AS sales_rate,
               sum(units) FILTER (WHERE flag_sample = 1) / sum(est) FILTER (WHERE flag_sample = 1) AS units_rate
        FROM literal GROUP BY ALL""",
    "proj_sample": f"""
        SELECT date, {PLACE}, market, packid, flag_sample, sum(sales) AS sales, sum(units) AS units FROM (
            SELECT date, {PLACE}, market, packid, 1 AS flag_sample, sales, units FROM literal WHERE flag_sample = 1
            UNION ALL
            SELECT date, {PLACE}, market, packid, 0, sum(est) * sales_rate, sum(est) * units_rate
            FROM literal JOIN rates USING (sample_dist, market, packid, date) WHERE flag_sample = 0 AND share < 0.8
            GROUP BY date, {PLACE}, market, packid, sample_dist, sales_rate, units_rate
            UNION ALL
            SELECT date, {PLACE}, market, packid, 1, sales, units FROM panel WHERE pchc NOT IN (SELECT pchc FROM universe))
        WHERE sales > 0 AND units > 0 GROUP BY ALL""",
}
_TIER_VIEWS = {
    "targets": f"""
        SELECT {PLACE}, coalesce(tier, 1) AS tier, sum(est) AS est FROM universe LEFT JOIN tiers USING (city) GROUP BY ALL""",
    "offers": f"""
        SELECT date, {PLACE}, coalesce(tier, 1) AS tier, market, packid, sum(sales) AS sales, sum(units) AS units
        FROM sample_facts LEFT JOIN tiers USING (city) WHERE province <> 'AFRICA' GROUP BY ALL""",
    "offering": f"SELECT * FROM targets WHERE ({PLACE}, tier) IN (SELECT DISTINCT ({PLACE}, tier) FROM offers)",
    "slopes": """
        SELECT t.province, t.city, t.district, t.tier, o.province AS donor_province, o.city AS donor_city,
               o.district AS donor_district, t.est / o.est AS slope
        FROM targets t JOIN offering o ON t.tier = o.tier
        QUALIFY abs(t.est - o.est) = min(abs(t.est - o.est)) OVER (PARTITION BY t.province, t.city, t.district, t.tier)""",
}
_NATION_VIEWS = {
    **_PROJECT_VIEWS,
    **_TIER_VIEWS,
    "sample_facts": "SELECT * FROM proj_sample",
    "dense": """
        SELECT s.*, p.market, p.packid, d.date
        FROM slopes s JOIN (SELECT DISTINCT province, city, district, tier, market, packid FROM offers) p
        ON (s.donor_province, s.donor_city, s.donor_district, s.tier) = (p.province, p.city, p.district, p.tier)
        CROSS JOIN (SELECT DISTINCT date FROM offers) d""",
    "cap": "SELECT quantile_cont(slope, 0.9) AS q FROM dense",
    "proj_nation": f"""
        SELECT o.date, s.province, s.city, s.district, o.market, o.packid, 0 AS flag_sample,
               sum(o.sales * least(slope, (SELECT q FROM cap))) AS sales, sum(o.units * least(slope, (SELECT q FROM cap))) AS units
        FROM slopes s JOIN offers o ON (s.donor_province, s.donor_city, s.donor_district, s.tier) = (o.province, o.city, o.district, o.tier)
        WHERE s.city NOT IN (SELECT city FROM sample_facts) GROUP BY ALL
        UNION ALL SELECT date, {PLACE}, market, packid, flag_sample, sales, units FROM sample_facts""",
}


@query("nearest_district_donor", with_views("SELECT * FROM donors", **_DONOR_VIEWS))
def nearest_district_donor_query(fx: Fixtures) -> DataFrame:
    return nearest_district_donor(district_mapping(fx.universe))


@query(
    "nearest_tier_donor",
    with_views(
        "SELECT province, city, district, tier, donor_province, donor_city, donor_district, floor(slope * 100000000 + 0.5) / 100000000 AS slope FROM slopes",
        **_TIER_VIEWS,
        sample_facts="SELECT * FROM panel",
    ),
)
def nearest_tier_donor_query(fx: Fixtures) -> DataFrame:
    districts = materialize(tier_districts(fx.universe, fx.tiers), "districts")
    pairs = nearest_tier_donor(districts, donor_facts(fx.panel, fx.tiers, NO_DONORS))
    return rounded(pairs.drop("est", "donor_est"), slope=8)


@query(
    "project_sample",
    with_views(f"SELECT date, {PLACE}, market, packid, flag_sample, floor(sales * 100 + 0.5) / 100 AS sales, floor(units * 10000 + 0.5) / 10000 AS units FROM proj_sample", **_PROJECT_VIEWS),
)
def project_sample_query(fx: Fixtures) -> DataFrame:
    return rounded(project_sample(fx.written_panel, fx.written_universe), sales=2, units=4)


def _projected(fx: Fixtures) -> DataFrame:
    return project_nation(project_sample(fx.written_panel, fx.written_universe), fx.written_universe, fx.tiers, exclude_provinces=NO_DONORS)


@query(
    "project_nation",
    with_views(f"SELECT date, {PLACE}, market, packid, flag_sample, floor(sales * 100 + 0.5) / 100 AS sales, floor(units * 10000 + 0.5) / 10000 AS units FROM proj_nation", **_NATION_VIEWS),
)
def project_nation_query(fx: Fixtures) -> DataFrame:
    return rounded(_projected(fx), sales=2, units=4)


@query(
    "price_fallback",
    with_views(
        f"""
    SELECT 'CHC' AS channel, year, date, quarter, {PLACE}, market, packid, flag_sample, floor(price * 10000 + 0.5) / 10000 AS price,
           floor((sales / price) * 10000 + 0.5) / 10000 AS units, floor(sales * 100 + 0.5) / 100 AS sales
    FROM (SELECT d.*, coalesce(a.price, b.price, c.price, e.price, g.price, h.price) AS price FROM dated d
          LEFT JOIN (SELECT packid, province, city, quarter, sum(sales) / sum(units) AS price FROM panel GROUP BY ALL) a
              USING (packid, province, city, quarter)
          LEFT JOIN (SELECT packid, province, city, year, sum(sales) / sum(units) AS price FROM panel GROUP BY ALL) b
              USING (packid, province, city, year)
          LEFT JOIN (SELECT packid, province, quarter, sum(sales) / sum(units) AS price FROM panel GROUP BY ALL) c
              USING (packid, province, quarter)
          LEFT JOIN (SELECT packid, province, year, sum(sales) / sum(units) AS price FROM panel GROUP BY ALL) e
              USING (packid, province, year)
          LEFT JOIN (SELECT packid, quarter, sum(sales) / sum(units) AS price FROM panel GROUP BY ALL) g USING (packid, quarter)
          LEFT JOIN (SELECT packid, year, sum(sales) / sum(units) AS price FROM panel GROUP BY ALL) h USING (packid, year))
    WHERE price > 0 AND sales > 0""",
        **_NATION_VIEWS,
        dated="""
        SELECT *, substr(date, 1, 4) AS year, substr(date, 1, 4) || 'Q' || quarter(CAST(strptime(date, '%Y%m') AS DATE)) AS quarter
        FROM proj_nation""",
    ),
)
def price_fallback(fx: Fixtures) -> DataFrame:
    priced = update_price(_projected(fx).withColumn("channel", F.lit("CHC")), fx.written_panel)
    return rounded(priced, price=4, units=4, sales=2)


# --- delivery ----------------------------------------------------------------------------------------

_SPLIT = """CASE WHEN market = 'HTN' AND atc3 LIKE 'C07%' THEN 0.75 WHEN market = 'IHD' AND atc3 LIKE 'C07%' THEN 0.25
    WHEN market = 'HTN' AND atc3 LIKE 'C08%' THEN 0.9 WHEN market = 'IHD' AND atc3 LIKE 'C08%' THEN 0.1 ELSE 1 END"""
# The classes that occur in the part table, with their final labels.
_CATEGORY_1 = """CASE WHEN market = 'Diabetes' THEN 'OAD&GLP-1'
    WHEN market = 'HTN' AND atc3 = 'C09A' THEN 'RAASi PLAIN'
    WHEN market IN ('HTN', 'IHD') AND atc3 = 'C07A' THEN 'BB' WHEN market IN ('HTN', 'IHD') AND atc3 = 'C08A' THEN 'CCB'
    WHEN market = 'Venous Disease' AND atc3 = 'C05A' THEN 'HD Topical' WHEN market = 'Venous Disease' AND atc3 LIKE 'V03%' THEN 'TCM' END"""
_CATEGORY_2 = f"""CASE WHEN market = 'Diabetes' THEN CASE WHEN atc3 = 'A10H' THEN 'SU' END
    WHEN market = 'Venous Disease' AND atc3 LIKE 'V03%' AND route = '口服固体' THEN 'TCM Oral'
    WHEN market = 'Venous Disease' AND atc3 LIKE 'V03%' AND route = '外用制剂' THEN 'TCM Topical'
    WHEN market = 'Venous Disease' THEN {_CATEGORY_1}
    WHEN atc3 = 'C09A' THEN 'ACEI'
    WHEN market = 'HTN' THEN {_CATEGORY_1} END"""


@query(
    "classify_rules",
    with_views(f"""
    SELECT market, packid, atc3, atc4, molecule, route, {_CATEGORY_1} AS category_1, {_CATEGORY_2} AS category_2
    FROM (SELECT DISTINCT market, packid FROM sales) JOIN master USING (packid)"""),
)
def classify_rules(fx: Fixtures) -> DataFrame:
    master = fx.master.select("packid", "atc3", "atc4", "molecule", "route")
    return classify(fx.sales.select("market", "packid").distinct().join(master, "packid"))


@query(
    "split_factors",
    with_views(f"SELECT city, date, market, packid, atc3, floor((value_lc * {_SPLIT}) * 100 + 0.5) / 100 AS value_adj, floor((units * {_SPLIT}) * 100 + 0.5) / 100 AS units_adj FROM history"),
)
def split_factors(fx: Fixtures) -> DataFrame:
    rows = split_markets(fx.history, {"value_adj": "value_lc", "units_adj": "units"})
    return rounded(rows, value_adj=2, units_adj=2).select("city", "date", "market", "packid", "atc3", "value_adj", "units_adj")


_DIMS = "channel, period_type, year, quarter, date, atc3, market, category_2, molecule, product_name, product, product_cn, packid, route, corp"
_HISTORY = f"city_en, city, {_DIMS}, tender_round, " + ", ".join(MEASURES)


@query(
    "national_rollup",
    with_views(f"""
    SELECT 0 AS _src, 'National' AS city_en, 'National' AS city, {_DIMS}, NULL AS tender_round,
           {', '.join(f'sum({m}) AS {m}' for m in MEASURES)} FROM history GROUP BY {_DIMS}
    UNION ALL SELECT 1, {_HISTORY} FROM history"""),
)
def national_rollup_query(fx: Fixtures) -> DataFrame:
    return national_rollup(fx.history)


TARGET_CITIES = ["NATION_2", "NATION_5", "NATION_9"]
TCM_PRODUCTS = ["PROD00003  RED", "PROD00011  SMA"]
RULES = DeliveryRules(route_rounds={("MOL00002", "口服固体"): "第三批", ("MOL00004", "外用制剂"): "第二批"})

_FORMAT_VIEWS = {
    "pack_parts": r"""
        SELECT *, nullif(trim(regexp_replace(regexp_extract(pack, '^([^0-9]*)[0-9]', 1), '\s+', ' ', 'g')), '') AS pack_form,
            CASE WHEN regexp_matches(pack, '\s') THEN nullif(trim(regexp_replace(regexp_extract(
                regexp_extract(pack, '^(.*)\s[^\s]*$', 1), '[0-9].*$'), '\s+', ' ', 'g')), '') END AS pack_strength,
            CASE WHEN regexp_matches(pack, '\s') THEN CAST(TRY_CAST(trim(regexp_extract(pack, '\s([^\s]*)$', 1)) AS DOUBLE) AS INTEGER) END
                AS pack_size FROM master""",
    "typed": f"""
        SELECT f.*, city_en, m.* EXCLUDE (packid), tender_win,
               {_CATEGORY_1} AS category_1, {_CATEGORY_2} AS category_2,
               CASE WHEN type <> 'L' THEN '原研' WHEN type = 'L' THEN '仿制' END AS originator,
               CASE WHEN type <> 'L' THEN 'MNC' WHEN type = 'L' THEN 'Local' END AS manufacture_type,
               round_even(f.sales * {_SPLIT}, 2) AS value_lc, round_even(f.units * {_SPLIT}, 0) AS units_adj
        FROM (SELECT year, quarter, province, city, market, packid, sum(sales) AS sales, sum(units) AS units FROM panel GROUP BY ALL) f
        LEFT JOIN city_names USING (city) LEFT JOIN pack_parts m USING (packid)
        LEFT JOIN tenders t ON (t.city, t.molecule, t.packid) = (f.city, m.molecule, f.packid)""",
    "city_rows": """
        SELECT 'CHC' AS channel, city_en, city, 'QTR' AS period_type, year, substr(quarter, 5, 2) AS quarter, quarter AS date,
               atc3, atc4, market, category_1, category_2, molecule, product AS product_name,
               trim(substr(product, 1, length(product) - 3)) AS product, product_cn, packid, pack, pack_form, pack_strength, pack_size,
               route, corp, corp_cn, manufacture_type, tender_win, originator, value_lc, units_adj AS units,
               round_even(pack_size * units_adj, 0) AS counting_units, round_even(sales, 2) AS value_lc_raw,
               round_even(typed.units, 0) AS units_raw, round_even(pack_size * round_even(typed.units, 0), 0) AS counting_units_raw
        FROM typed""",
    "rolled": """
        SELECT 0 AS src, channel, 'National' AS city_en, 'National' AS city, period_type, year, quarter, date, atc3, atc4, market,
               category_1, category_2, molecule, product_name, product, product_cn, packid, pack, pack_form, pack_strength, pack_size,
               route, corp, corp_cn,
               arg_min(manufacture_type, city) AS manufacture_type, arg_min(tender_win, city) AS tender_win,
               arg_min(originator, city) AS originator,
               sum(value_lc) AS value_lc, sum(units) AS units, coalesce(sum(counting_units), 0) AS counting_units,
               sum(value_lc_raw) AS value_lc_raw, sum(units_raw) AS units_raw, coalesce(sum(counting_units_raw), 0) AS counting_units_raw
        FROM city_rows
        GROUP BY channel, period_type, year, quarter, date, atc3, atc4, market, category_1, category_2, molecule, product_name, product,
                 product_cn, packid, pack, pack_form, pack_strength, pack_size, route, corp, corp_cn
        UNION ALL BY NAME SELECT 1 AS src, * FROM city_rows""",
    "kept": """
        SELECT r.*, CASE WHEN r.molecule = 'MOL00002' AND route = '口服固体' THEN '第三批'
                         WHEN r.molecule = 'MOL00004' AND route = '外用制剂' THEN '第二批' ELSE tender_round END AS tender_round
        FROM rolled r LEFT JOIN rounds v ON v.city = r.city AND v.molecule = r.molecule
        WHERE NOT coalesce(atc3 = 'V03B' AND NOT coalesce(product_name IN ('PROD00003  RED', 'PROD00011  SMA'), FALSE), FALSE)
          AND r.city IN ('National', 'NATION_2', 'NATION_5', 'NATION_9') AND value_lc > 0 AND units > 0 AND counting_units > 0""",
    "ranked": """
        SELECT *, row_number() OVER (ORDER BY src,
            CASE src WHEN 0 THEN struct_pack(a := channel, b := period_type, c := year, d := quarter, e := date) END,
            CASE src WHEN 0 THEN atc3 END, CASE src WHEN 0 THEN atc4 END, CASE src WHEN 0 THEN market END,
            CASE src WHEN 0 THEN category_1 END, CASE src WHEN 0 THEN category_2 END, CASE src WHEN 0 THEN molecule END,
            CASE src WHEN 0 THEN product_name END, CASE src WHEN 0 THEN product END,
            channel, date, city, market, packid, product_cn) AS rn FROM kept""",
}


@query(
    "format_delivery",
    with_views(
        """
    SELECT * EXCLUDE (src, rn) REPLACE (
        arg_min(product_cn, rn) OVER (PARTITION BY product) AS product_cn, floor(value_lc * 100 + 0.5) / 100 AS value_lc,
        floor(value_lc_raw * 100 + 0.5) / 100 AS value_lc_raw) FROM ranked""",
        **_FORMAT_VIEWS,
    ),
)
def format_delivery_query(fx: Fixtures) -> DataFrame:
    facts = fx.panel.withColumn("channel", F.lit("CHC"))
    rows = format_delivery(
        facts, fx.master, fx.tenders, fx.rounds, fx.city_names,
        target_cities=TARGET_CITIES, tcm_products=TCM_PRODUCTS, rules=RULES,
    )
    return rounded(rows, value_lc=2, value_lc_raw=2)


# --- periods ---------------------------------------------------------------------------------------------

_THIS, _PREVIOUS, _BEFORE = (f"(SELECT q{i} FROM this_quarter)" for i in range(3))


def _grown(value: str, units: str) -> str:
    parts = [f"floor((h.{m} * {value if m.startswith('value') else units}) * 10000 + 0.5) / 10000 AS {m}" for m in MEASURES]
    return ", ".join(parts)


_ROLL_DIMS = (
    "h.channel, h.city_en, h.city, h.period_type, h.year, h.atc3, h.market, h.category_2, h.molecule, h.product_name, h.product, "
    "h.product_cn, h.route, h.corp, h.tender_round"
)


@query(
    "growth_rollforward",
    with_views(f"""
    SELECT {_ROLL_DIMS}, lpad(h.packid, 7, '0') AS packid, substr({_THIS}, 5) AS quarter, {_THIS} AS date,
           {_grown('coalesce(g.gs, x.gs)', 'coalesce(g.gu, x.gu)')}
    FROM past h
    LEFT JOIN (SELECT a.market, a.packid, b.value_lc / a.value_lc AS gs, b.units / a.units AS gu
               FROM past a JOIN current_q b ON b.city = 'NATION_0' AND a.city = 'NATION_0' AND a.market = b.market
                    AND lpad(a.packid, 7, '0') = b.packid AND a.date = {_PREVIOUS}) g
        ON g.market = h.market AND g.packid = h.packid
    LEFT JOIN (SELECT * FROM pack_growth WHERE isfinite(gs) AND isfinite(gu)) x
        ON x.pack_id = lpad(h.packid, 7, '0')
    WHERE h.city = 'NATION_20' AND h.date = {_PREVIOUS} AND coalesce(g.gs, x.gs) > 0 AND coalesce(g.gu, x.gu) > 0"""),
)
def growth_rollforward_query(fx: Fixtures) -> DataFrame:
    past, current = fx.recent(2)
    rows = growth_rollforward(
        current, past, fx.external, missing_city="NATION_20", proxy_city="NATION_0", quarter=fx.quarter
    )
    return rounded(rows, **dict.fromkeys(MEASURES, 4))


@query(
    "self_rollforward",
    with_views(f"""
    SELECT h.channel, h.city_en, h.city, h.period_type, h.year, h.molecule, h.category_2, h.market, lpad(h.packid, 7, '0') AS packid,
           substr({_THIS}, 5) AS quarter, {_THIS} AS date, {_grown('(h.value_lc / b.value_lc)', '(h.units / b.units)')}
    FROM residual h JOIN residual b ON h.city = b.city AND h.date = {_PREVIOUS} AND b.date = {_BEFORE}"""),
)
def self_rollforward_query(fx: Fixtures) -> DataFrame:
    rows = self_rollforward(fx.residual, molecule="Others", quarter=fx.quarter)
    return rounded(rows, **dict.fromkeys(MEASURES, 4))


_MAT_VIEWS = {
    "mat_rows": """
        SELECT 0 AS src, * REPLACE (lpad(packid, 7, '0') AS packid) FROM past WHERE date >= (SELECT q3 FROM this_quarter)
        UNION ALL SELECT 1, * FROM current_q""",
    "mat_named": """
        SELECT * REPLACE (last_value(product_name) OVER w AS product_name, last_value(product) OVER w AS product,
            last_value(corp) OVER w AS corp, first_value(route IGNORE NULLS) OVER w AS route,
            last_value(tender_round IGNORE NULLS) OVER w AS tender_round)
        FROM mat_rows WINDOW w AS (PARTITION BY city, packid ORDER BY src, channel, period_type DESC, date, city_en, market
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "mat": f"""
        SELECT channel, city_en, city, 'MAT' AS period_type, substr({_THIS}, 1, 4) AS year, substr({_THIS}, 5) AS quarter, {_THIS} AS date,
               atc3, market, category_2, molecule, product_name, product, product_cn, packid, route, corp, tender_round,
               {', '.join(f'sum({m}) AS {m}' for m in MEASURES)}
        FROM mat_named
        GROUP BY channel, city_en, city, atc3, market, category_2, molecule, product_name, product, product_cn, packid, route, corp,
                 tender_round""",
}


@query("moving_annual_total", with_views("SELECT * FROM mat", **_MAT_VIEWS))
def moving_annual_total_query(fx: Fixtures) -> DataFrame:
    past, current = fx.recent(4)
    return moving_annual_total(past, current, quarter=fx.quarter)


_ASSEMBLE_VIEWS = {
    **_MAT_VIEWS,
    "assembled": """
        SELECT 0 AS src, * REPLACE (lpad(packid, 7, '0') AS packid) FROM past
        UNION ALL BY NAME SELECT 1 AS src, * FROM current_q UNION ALL BY NAME SELECT 2 AS src, * FROM mat""",
}


@query(
    "assemble_delivery",
    with_views(
        """
    SELECT * EXCLUDE (src, product_name, product, corp, product_cn, route),
           last_value(product_name) OVER w AS product_name, last_value(product) OVER w AS product, last_value(corp) OVER w AS corp,
           last_value(product_cn IGNORE NULLS) OVER w AS product_cn, first_value(route IGNORE NULLS) OVER w AS route
    FROM assembled WINDOW w AS (PARTITION BY packid ORDER BY src, channel, CASE WHEN src < 2 THEN period_type END DESC,
        CASE WHEN src < 2 THEN date END, CASE src WHEN 1 THEN city ELSE city_en END, CASE WHEN src < 2 THEN market END,
        city, atc3, market, category_2, molecule, product_name, product, product_cn
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
        **_ASSEMBLE_VIEWS,
    ),
)
def assemble_delivery_query(fx: Fixtures) -> DataFrame:
    return assemble_delivery(fx.past, fx.current, moving_annual_total(fx.past, fx.current, quarter=fx.quarter))


# --- review -----------------------------------------------------------------------------------------------


@query(
    "uniformity_report",
    with_views("""
    SELECT *, count(*) OVER (PARTITION BY packid, market) AS n FROM (
        SELECT DISTINCT packid, market, atc3, category_2, molecule, last_value(product_name) OVER w AS product_name,
               last_value(product) OVER w AS product, product_cn, first_value(route IGNORE NULLS) OVER w AS route,
               last_value(corp) OVER w AS corp
        FROM history WINDOW w AS (PARTITION BY packid ORDER BY channel, period_type DESC, date, city_en, market
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    QUALIFY n > 1"""),
)
def uniformity_report_query(fx: Fixtures) -> DataFrame:
    return uniformity_report(fx.history)


@query(
    "existence_check",
    with_views("""
    SELECT *, CASE WHEN flag_bid = 1 AND flag_prod = 1 THEN '有' WHEN flag_bid IS NULL AND flag_prod = 1 THEN 'Pack没有，产品有'
                   WHEN flag_bid IS NULL AND flag_prod IS NULL THEN '没有' END AS existence
    FROM (SELECT t.* EXCLUDE (own), t.own AS prodid, b.flag_bid, p.flag_prod FROM
        (SELECT *, substr(packid, 1, 5) AS own FROM tenders WHERE sheet = 2) t
        LEFT JOIN (SELECT DISTINCT city, molecule, lpad(packid, 7, '0') AS packid, 1 AS flag_bid FROM history) b
            USING (city, molecule, packid)
        LEFT JOIN (SELECT DISTINCT city, molecule, substr(lpad(packid, 7, '0'), 1, 5) AS prodid, 1 AS flag_prod FROM history) p
            ON (p.city, p.molecule, p.prodid) = (t.city, t.molecule, t.own))"""),
)
def existence_check(fx: Fixtures) -> DataFrame:
    delivery = fx.history.withColumn("packid", pad_code("packid"))
    return tender_coverage(fx.tenders, delivery, sheet=2)


@query(
    "benchmark_extract",
    with_views(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT pack_id, atc3, molecule, product, '{q}' AS date, \"{q}_UNIT\" AS units, \"{q}_SU\" AS counting_units, "
            f'"{q}_RENMINBI" AS value_lc, market FROM external JOIN market_def USING (atc3, molecule)'
            for q in QUARTERS
        )
        + ") WHERE units > 0 AND value_lc > 0 AND NOT (atc3 = 'C05A' AND product <> 'PROD00003') AND date >= '1996'"
    ),
)
def benchmark_extract_query(fx: Fixtures) -> DataFrame:
    return benchmark_extract(
        fx.external, _market_def(fx), ids=["pack_id", "atc3", "molecule", "product"],
        years=[str(y) for y in range(1996, 2002)], tcm_class="C05A", tcm_products=["PROD00003"],
    )


@query(
    "price_check_matrix",
    with_views(
        "SELECT channel, city, market, molecule, product_name, packid, "
        + ", ".join(
            f"coalesce(array_to_string(list_sort(list(DISTINCT CAST(round_even(value_lc / units, 0) AS BIGINT)) FILTER (date = '{q}')), ' '), '') AS \"{q}\""
            for q in QUARTERS
        )
        + " FROM history GROUP BY channel, city, market, molecule, product_name, packid"
    ),
)
def price_check_query(fx: Fixtures) -> DataFrame:
    """All prices of a cell, as one text."""
    matrix = price_check_matrix(fx.history, dates=QUARTERS)
    return matrix.withColumns({q: F.array_join(F.transform(q, lambda p: p.cast("bigint").cast("string")), " ") for q in QUARTERS})


@query(
    "ratio_undefined",
    with_views("""
    SELECT hospital_name, month, value, CASE WHEN price <> 0 THEN volume / price WHEN volume > 0 THEN 'inf'::DOUBLE END AS rate FROM raw_panel"""),
)
def ratio_undefined(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.select("hospital_name", "month", "value", ratio("volume", "price").alias("rate"))
