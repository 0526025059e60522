"""Ingest by position, problem reports, audits, restatements and the whole run."""

import re
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelproj.catalog.fixtures import Fixtures
from panelproj.catalog.panel_queries import _CATEGORY_1, _CATEGORY_2, _CLEANED, _FORMAT_VIEWS, _KNN_VIEWS, _NATION_VIEWS, _SPLIT, _STANDARD, NO_DONORS, RULES, SUCCESSION, TCM_PRODUCTS
from panelproj.catalog.registry import query, rounded
from panelproj.catalog.sql_views import FACT_KEYS, PLACE, VIEWS, with_views
from panelproj.functions import quarter_shift
from panelproj.operators.audit import LookupAudit, cross_source_duplicates, restatement_report
from panelproj.operators.delivery import MEASURES
from panelproj.operators.dims import attribute_source, product_master
from panelproj.operators.periods import moving_annual_series
from panelproj.operators.position import by_position, with_position
from panelproj.operators.relational import spread, union_strict, weighted_quantile
from panelproj.operators.rules import apply_rules, classification_rules
from panelproj.operators.sketch import merged_quantile, period_sketches, rank_error
from panelproj.operators.standardize import market_definition
from panelproj.plans import Lookups, Parameters, RawSource, StageStore, files_version, whole_run

from panelproj.sources import checkpoint_dir, ingest, materialize
from panelproj.sources.manifest import Manifest


def _scratch(fx: Fixtures, name: str) -> str:
    return f"{checkpoint_dir(fx.spark)}/{name}-{uuid.uuid4().hex}"


# --- ingest ------------------------------------------------------------------------------


@query(
    "first_by_file_position",
    with_views(
        """
    SELECT read_first, hospital, arg_min(city, k) AS city, arg_min(district, k) FILTER (WHERE district IS NOT NULL) AS district,
           arg_max(packid, k) AS last_packid
    FROM (SELECT 'P' AS read_first, *, src * 1000000000000 + rn AS k FROM exported
          UNION ALL SELECT 'other', *, (1 - src) * 1000000000000 + rn FROM exported)
    GROUP BY read_first, hospital""",
        exported="""
        SELECT CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS src, hospital, packid,
               CASE WHEN o_orderstatus = 'P' THEN city ELSE 'Z ' || city END AS city,
               CASE WHEN o_orderstatus <> 'P' OR p_type <> 'LARGE' THEN district END AS district,
               row_number() OVER (PARTITION BY o_orderstatus = 'P' ORDER BY l_orderkey, l_linenumber, packid) AS rn FROM sales""",
    ),
)
def first_by_file_position(fx: Fixtures) -> DataFrame:
    """First place and last pack of each centre by their lines in two exports, read in one order and in the other."""
    columns = ["hospital", "city", "district", "packid"]
    from_p = F.col("o_orderstatus") == "P"
    both = fx.sales.select(
        from_p.alias("p"), "l_orderkey", "l_linenumber", "hospital", "packid",
        F.when(from_p, F.col("city")).otherwise(F.concat(F.lit("Z "), "city")).alias("city"),
        F.when(~from_p | (F.col("p_type") != "LARGE"), F.col("district")).alias("district"),
    )
    both = materialize(both, "both-exports")  # each export's sort reads it twice
    paths = []
    for part in (F.col("p"), ~F.col("p")):
        paths.append(_scratch(fx, "export"))
        both.filter(part).orderBy("l_orderkey", "l_linenumber", "packid").select(*columns).write.csv(paths[-1], header=True)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def places(name: str, *order: str) -> DataFrame:
        rows = with_position(ingest(fx.spark, order, schema).rows)
        found = by_position(rows, ["hospital"], first=["city"], first_known_of=["district"], last=["packid"])
        return found.withColumnRenamed("packid", "last_packid").withColumn("read_first", F.lit(name))

    return places("P", *paths).unionByName(places("other", *reversed(paths)))


@query(
    "ingest_problems",
    """
    WITH numbered AS (
        SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS "_row",
               CASE WHEN l_tax = 0.0 AND l_linenumber = 1 THEN 'short' WHEN l_tax = 0.08 AND l_linenumber = 2 THEN 'long'
                    WHEN l_tax = 0.07 AND l_linenumber = 3 THEN 'quote' ELSE 'whole' END AS shape,
               l_discount = 0.1 AND l_returnflag = 'A' AS no_number, l_discount = 0.05 AND l_linenumber = 4 AS no_flag,
               l_returnflag = 'R' AND l_linenumber = 5 AS odd_date FROM lineitem),
    problems AS (
        SELECT "_row", NULL AS "column", NULL AS text, 'cells' AS reason FROM numbered WHERE shape <> 'whole'
        UNION ALL SELECT "_row", 'quantity', 'n/a', 'type' FROM numbered WHERE shape = 'whole' AND no_number
        UNION ALL SELECT "_row", 'flag', NULL, 'missing' FROM numbered WHERE shape = 'whole' AND no_flag
        UNION ALL SELECT "_row", 'shipped', strftime(l_shipdate, '%Y-%m') || '-99', 'type' FROM numbered WHERE shape = 'whole' AND odd_date)
    SELECT * FROM problems
    UNION ALL SELECT -1, NULL, CAST(count(DISTINCT "_row") AS VARCHAR), 'lines rejected' FROM problems
    UNION ALL SELECT -1, NULL, CAST((SELECT count(*) FROM numbered) - count(DISTINCT "_row") AS VARCHAR), 'rows kept' FROM problems""",
)
def ingest_problems(fx: Fixtures) -> DataFrame:
    """An export with planted faults: each cell that does not fit, and how many lines were kept and rejected."""
    no_number = (F.col("l_discount") == 0.1) & (F.col("l_returnflag") == "A")
    no_flag = (F.col("l_discount") == 0.05) & (F.col("l_linenumber") == 4)
    odd_date = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 5)
    cells = [
        F.col("l_orderkey").cast("string"),
        F.when(no_number, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")),
        F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.when(odd_date, F.lit("-99")).otherwise(F.date_format("l_shipdate", "-dd"))),
        F.when(no_flag, F.lit("")).otherwise(F.col("l_returnflag")),
    ]
    whole, n = F.concat_ws(",", *cells), F.col("l_linenumber")
    line = (
        F.when((F.col("l_tax") == 0.0) & (n == 1), F.concat_ws(",", *cells[:2]))
        .when((F.col("l_tax") == 0.08) & (n == 2), F.concat_ws(",", whole, F.lit("more")))
        .when((F.col("l_tax") == 0.07) & (n == 3), F.concat(F.lit('"'), whole))
        .otherwise(whole)
    )
    path = _scratch(fx, "faulty")
    rows = fx.spark.read.parquet(f"{fx.dir}/lineitem.parquet")
    rows.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select(line.alias("value")).write.text(path)
    schema = T.StructType().add("orderkey", "long").add("quantity", "double").add("shipped", "date").add("flag", "string")
    read = ingest(fx.spark, [path], schema, header=False, required=["flag"])

    def total(df: DataFrame, label: str) -> DataFrame:
        none = F.lit(None).cast("string")
        return df.agg(F.count(F.lit(1)).cast("string").alias("text")).select(
            F.lit(-1).cast("bigint").alias("_row"), none.alias("column"), "text", F.lit(label).alias("reason")
        )

    problems = read.problems.select("_row", "column", "text", "reason")
    return problems.unionByName(total(read.rejected, "lines rejected")).unionByName(total(read.rows, "rows kept"))


_BACKWARDS = ", ".join(f"{c} DESC NULLS LAST" for c in "packid corp type atc3 atc4 atc3_cn molecule molecule_cn product product_cn pack route".split())


@query(
    "master_by_position",
    with_views("SELECT * FROM master", product_rows=re.sub(r"ORDER BY src, packid.*?route\)", f"ORDER BY src, {_BACKWARDS})", VIEWS["product_rows"], flags=re.DOTALL)),
)
def master_by_position(fx: Fixtures) -> DataFrame:
    """The product master from three exports that list their rows backwards: the first line wins, not the first text."""
    sources = []
    for source in fx.product_sources:
        path = _scratch(fx, "products")
        order = [c for c in ("packid", "corp", "type", "atc3", "atc4", "atc3_cn", "molecule", "molecule_cn", "product", "product_cn", "pack", "route") if c in source.columns]
        source.orderBy(*[F.desc_nulls_last(c) for c in order]).write.csv(path, header=True)
        read = with_position(ingest(fx.spark, [path], T.StructType([T.StructField(c, T.StringType()) for c in source.columns])).rows)
        sources.append(attribute_source(read, {c: c for c in source.columns}))
    return product_master(sources, fx.corporations, fx.fallback_names)


# --- audits --------------------------------------------------------------------------------


@query(
    "lookup_audit",
    with_views(
        """
    SELECT 'place' AS lookup, count(DISTINCT id) AS rows_in, count(*) AS rows_out, count(*) FILTER (WHERE pchc IS NULL) AS unmatched,
           count(DISTINCT id) FILTER (WHERE n > 1) AS multiplied FROM placed
    UNION ALL
    SELECT 'market', count(DISTINCT (id, pchc)), count(*), count(*) FILTER (WHERE listed IS NULL), count(DISTINCT (id, pchc)) FILTER (WHERE n > 1)
    FROM marketed""",
        facts="""
        SELECT row_number() OVER () AS id, * FROM (
            SELECT province, city, district, hospital, atc3, molecule, packid, date, sum(sales) AS sales FROM sales GROUP BY ALL)""",
        centres="SELECT province, city, district, hospital, pchc FROM places WHERE c_acctbal > 0 UNION ALL SELECT province, city, district, hospital, 'second ' || pchc FROM places WHERE c_acctbal > 9000",
        placed="""
        SELECT f.*, l.pchc, l.n FROM facts f LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY province, city, district, hospital) AS n FROM centres) l
        USING (province, city, district, hospital)""",
        marketed="""
        SELECT f.id, f.pchc, l.market AS listed, l.n FROM placed f
        LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY atc3, molecule) AS n FROM market_def) l USING (atc3, molecule)""",
    ),
)
def lookup_audit(fx: Fixtures) -> DataFrame:
    """What two lookups do to the facts: some centres stand for two, some are unknown, some classes are in two markets or none."""
    keys = ["province", "city", "district", "hospital", "atc3", "molecule", "packid", "date"]
    facts = spread(fx.sales, fx.parts, *keys).groupBy(*keys).agg(F.sum("sales").alias("sales"))
    centres = fx.places.select("province", "city", "district", "hospital", "pchc", "c_acctbal").filter(F.col("c_acctbal") > 0)
    second = centres.filter(F.col("c_acctbal") > 9000).withColumn("pchc", F.concat(F.lit("second "), "pchc"))
    audit = LookupAudit()
    placed = audit.lookup(facts, centres.unionByName(second).drop("c_acctbal"), ["province", "city", "district", "hospital"], "place")
    markets = fx.market_listing.distinct()
    materialize(audit.lookup(placed, markets, ["atc3", "molecule"], "market"), "audited")
    return audit.report(fx.spark)


@query(
    "cross_source_duplicates",
    with_views("""
    SELECT *, n_0 + n_1 + n_2 - greatest(n_0, n_1, n_2) AS surplus FROM (
        SELECT date, city, packid, units, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_0, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_1,
               count(*) FILTER (WHERE l_returnflag = 'N' AND l_linenumber <= 2) AS n_2
        FROM (SELECT * REPLACE (CASE WHEN l_tax <> 0 THEN packid END AS packid) FROM sales) GROUP BY date, city, packid, units)
    WHERE surplus > 0"""),
)
def cross_source_duplicates_query(fx: Fixtures) -> DataFrame:
    """Transactions that several files hold; the third file overlaps the others, and a missing code is a code."""
    sales = fx.sales.withColumn("packid", F.when(F.col("l_tax") != 0, F.col("packid")))
    files = [F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O", (F.col("l_returnflag") == "N") & (F.col("l_linenumber") <= 2)]
    return cross_source_duplicates([sales.filter(f) for f in files], ["date", "city", "packid", "units"], fx.parts)


_VERSION_KEYS = ["channel", "city", "date", "market", "packid"]


@query(
    "restatement_report",
    with_views(
        f"""
    SELECT {', '.join(_VERSION_KEYS)}, coalesce(a.n, 0) AS rows_before, coalesce(b.n, 0) AS rows_after,
           a.v AS value_lc_before, b.v AS value_lc_after, a.u AS units_before, b.u AS units_after,
           CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'gone' ELSE 'changed' END AS status
    FROM (SELECT {', '.join(_VERSION_KEYS)}, count(*) AS n, sum(value_lc) AS v, sum(units) AS u FROM past GROUP BY ALL) a
    FULL JOIN (SELECT {', '.join(_VERSION_KEYS)}, count(*) AS n, sum(value_lc) AS v, sum(units) AS u FROM restated GROUP BY ALL) b
    USING ({', '.join(_VERSION_KEYS)})
    WHERE a.n IS DISTINCT FROM b.n OR a.v IS DISTINCT FROM b.v OR a.u IS DISTINCT FROM b.u""",
        restated="""
        SELECT * REPLACE (CASE WHEN tender_round IS NOT NULL THEN value_lc + 1 ELSE value_lc END AS value_lc) FROM history
        WHERE NOT (date < (SELECT q3 FROM this_quarter) AND city = 'NATION_3')""",
    ),
)
def restatement_report_query(fx: Fixtures) -> DataFrame:
    """Two published versions of the history: a new quarter, a city taken out of the old ones, values restated."""
    versions = Manifest(fx.spark, _scratch(fx, "versions"))
    columns = [*_VERSION_KEYS, "tender_round", "value_lc", "units"]
    versions.publish(fx.past.select(*columns), "history", "first")
    before = versions.newest("history")
    gone = (F.col("date") < quarter_shift(fx.quarter, -3)) & (F.col("city") == "NATION_3")
    restated = fx.written_history.filter(~gone).select(*columns)
    restated = restated.withColumn("value_lc", F.when(F.col("tender_round").isNotNull(), F.col("value_lc") + 1).otherwise(F.col("value_lc")))
    versions.publish(restated, "history", "second")
    return restatement_report(versions.open(before), versions.open(versions.newest("history")), _VERSION_KEYS, ["value_lc", "units"])


@query(
    "classify_by_table",
    with_views(f"""
    SELECT market, packid, atc3, atc4, molecule, route, {_CATEGORY_1} AS category_1, {_CATEGORY_2} AS category_2
    FROM (SELECT DISTINCT market, packid FROM sales) JOIN master USING (packid)"""),
)
def classify_by_table(fx: Fixtures) -> DataFrame:
    """The two categories of every pack by the rule table."""
    master = fx.master.select("packid", "atc3", "atc4", "molecule", "route")
    return apply_rules(fx.sales.select("market", "packid").distinct().join(master, "packid"), classification_rules(fx.spark))


@query(
    "quantile_sketched",
    with_views("SELECT quantile_cont(sales, 0.9) AS exact, count(*) AS n, TRUE AS within FROM sales"),
)
def quantile_sketched(fx: Fixtures) -> DataFrame:
    """The cap of all amounts from one sketch a quarter: its rank is within one hundredth of the exact one's."""
    amounts = materialize(fx.sales.select("sales", "quarter"), "amounts")  # read three times
    counted = amounts.groupBy("sales").agg(F.count("*").alias("n"))
    exact = weighted_quantile(counted, "sales", "n", 0.9).select(F.col("quantile").alias("exact"))
    sketches = materialize(period_sketches(amounts, "sales", "quarter"), "sketches")
    merged = materialize(merged_quantile(sketches, 0.9), "merged")
    error = rank_error(amounts, "sales", merged, 0.9).select((F.col("rank_error") <= 0.01).alias("within"))
    return exact.join(merged.select("n"), F.lit(True)).join(error, F.lit(True))  # one row each


# --- periods -----------------------------------------------------------------------------------


@query(
    "moving_annual_series",
    with_views(
        """
    SELECT s.city, s.packid, CAST(s.q // 4 AS VARCHAR) || 'Q' || CAST(s.q % 4 + 1 AS VARCHAR) AS date, s.n_quarters, s.value_lc, s.units,
           floor((s.value_lc / p.value_lc) * 100000000 + 0.5) / 100000000 AS value_lc_growth, floor((s.units / p.units) * 100000000 + 0.5) / 100000000 AS units_growth
    FROM series s LEFT JOIN series p ON s.city = p.city AND s.packid = p.packid AND p.q = s.q - 4""",
        quarterly="""
        SELECT city, packid, CAST(year AS INTEGER) * 4 + CAST(substr(date, 6, 1) AS INTEGER) - 1 AS q, sum(value_lc) AS value_lc, sum(units) AS units
        FROM history WHERE date <> '1997Q2' AND NOT (city = 'NATION_1' AND year = '1998') GROUP BY ALL""",
        series="""
        SELECT city, packid, q + d AS q, count(*) AS n_quarters, sum(value_lc) AS value_lc, sum(units) AS units
        FROM quarterly, (SELECT unnest([0, 1, 2, 3]) AS d) WHERE q + d <= (SELECT max(q) FROM quarterly) GROUP BY city, packid, q + d""",
    ),
)
def moving_annual_series_query(fx: Fixtures) -> DataFrame:
    """Totals of all quarters; one quarter is missing everywhere, and a whole year in one city."""
    rows = fx.history.filter((F.col("date") != "1997Q2") & ~((F.col("city") == "NATION_1") & (F.col("year") == "1998")))
    series = moving_annual_series(rows, ["city", "packid"], ["value_lc", "units"])
    return rounded(series, value_lc_growth=8, units_growth=8)


# --- the whole run -----------------------------------------------------------------------------

# Shares without ties at the rounding to whole units.
_RUN_SPLIT = {("HTN", "C07"): 0.7513, ("IHD", "C07"): 0.2487, ("HTN", "C08"): 0.9017, ("IHD", "C08"): 0.0983}
_RUN_CITIES = ["NATION_0", "NATION_2", "NATION_5", "NATION_9"]
_MISSING, _PROXY = "NATION_20", "NATION_0"


def _second_category(fx_or_sql: str = "spark"):
    """The history's second category, as the classification names it."""
    pairs = {"Diabetes|A10H": "SU", "HTN|C09A": "ACEI", "HTN|C07A": "BB", "HTN|C08A": "CCB", "Venous Disease|C05A": "HD Topical"}
    if fx_or_sql == "sql":
        return "CASE market || '|' || atc3 " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + " END"
    return F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), F.concat_ws("|", "market", "atc3"))


def _run_views() -> dict[str, str]:
    """The run's stages as SQL: the views of the single operators, each over the stage before it."""
    over = lambda views, **tables: {
        name: _renamed(sql, tables) for name, sql in views.items()
    }
    cleaned = _CLEANED.replace("FROM raw_panel", "FROM raw_reporting")
    split = _SPLIT
    for old, new in (("0.75", "0.7513"), ("0.25", "0.2487"), ("0.9 ", "0.9017 "), ("0.1 ", "0.0983 ")):
        split = split.replace(old, new)
    at = "(SELECT q0 FROM this_quarter)"
    keys = "channel, city_en, city, period_type, year, atc3, atc4, market, category_1, category_2, molecule, product_name, product, product_cn, packid, pack, pack_form, pack_strength, pack_size, route, corp, corp_cn, manufacture_type, tender_round, tender_win, originator"

    def newest(src: str, partition: str, columns: dict[str, str]) -> str:
        rows = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
        how = {"last": "last_value({c}) OVER", "last_known": "last_value({c} IGNORE NULLS) OVER", "first_known": "first_value({c} IGNORE NULLS) OVER"}
        return ", ".join(f"{how[h].format(c=c)} (PARTITION BY {partition} ORDER BY {src}, {c} {rows}) AS {c}" for c, h in columns.items())

    four = "src, channel, CASE WHEN src = 0 THEN period_type END DESC, date, CASE src WHEN 0 THEN city_en ELSE city END, market, packid"
    stacked = (
        "src, channel, CASE WHEN src <> 1 THEN CASE src WHEN 0 THEN CASE period_type WHEN 'QTR' THEN '0' ELSE '1' END ELSE city_en END ELSE date END, "
        "CASE src WHEN 0 THEN date WHEN 1 THEN city ELSE city END, CASE src WHEN 0 THEN city_en WHEN 1 THEN market ELSE period_type END, "
        "CASE src WHEN 0 THEN market WHEN 1 THEN packid ELSE year END, CASE src WHEN 0 THEN packid WHEN 2 THEN quarter END"
    )
    for c in ("date", "atc3", "atc4", "market", "category_1", "category_2", "molecule", "product_name", "product", "product_cn", "packid", "pack", "pack_form", "pack_strength", "CAST(pack_size AS VARCHAR)", "route", "corp", "corp_cn", "manufacture_type", "tender_round", "tender_win", "originator"):
        stacked += f", CASE src WHEN 2 THEN {c} END"
    grown = lambda value, units: ", ".join(f"h.{m} * {value if m.startswith('value') else units} AS {m}" for m in MEASURES)
    dims = "h.channel, h.city_en, h.city, h.period_type, h.year, h.atc3, h.market, h.category_2, h.molecule, h.product_name, h.product, h.product_cn, h.route, h.corp, h.tender_round"
    return {
        "raw_reporting": VIEWS["raw_panel"].replace("FROM sales", f"FROM panel_sales WHERE NOT (province = 'ASIA' AND p_type = 'LARGE') AND quarter = {at}"),
        "facts_1": (_STANDARD % "province, city, district, hospital").replace("FROM cleaned", "FROM cleaned_1"),
        "cleaned_1": cleaned % ("", "WHERE project = 'P1'"),
        "facts_2": (_STANDARD % "province, city, district, hospital").replace("FROM cleaned", "FROM cleaned_2"),
        "cleaned_2": cleaned % ("", "WHERE project = 'P2' AND packcode IS NOT NULL"),
        "panel_0": f"SELECT {FACT_KEYS}, sum(units) AS units, sum(sales) AS sales, 0 AS flag FROM (SELECT * FROM facts_1 UNION ALL SELECT * FROM facts_2) GROUP BY {FACT_KEYS}",
        **over(_KNN_VIEWS, panel="panel_0"),
        "imputed": """
            SELECT year, date, quarter, w.province, w.city, w.district, w.pchc, market, packid, sum(units * knn_weight) AS units, sum(sales * knn_weight) AS sales, 1 AS flag
            FROM weights w JOIN panel_0 f ON f.pchc = w.knn_pchc AND f.province <> 'ASIA' AND market = 'Diabetes' GROUP BY ALL""",
        "run_sample": "SELECT * FROM panel_0 UNION ALL BY NAME SELECT * FROM imputed",
        "run_universe": """
            SELECT r.pchc, coalesce(s.province, r.province) AS province, coalesce(s.city, r.city) AS city, coalesce(s.district, r.district) AS district, r.est,
                   CASE WHEN s.pchc IS NULL THEN 0 ELSE 1 END AS flag_sample
            FROM (SELECT pchc, province, city, district, sum(est) AS est FROM (
                      SELECT DISTINCT replace(province, '省', '') AS province, replace(city, '市', '') AS city, district, pchc, est FROM registry)
                  WHERE est > 0 GROUP BY ALL) r
            LEFT JOIN (SELECT DISTINCT pchc, province, city, district FROM run_sample) s USING (pchc)""",
        **over(_NATION_VIEWS, panel="run_sample", universe="run_universe"),
        "dated": """
            SELECT *, substr(date, 1, 4) AS year, substr(date, 1, 4) || 'Q' || quarter(CAST(strptime(date, '%Y%m') AS DATE)) AS quarter FROM proj_nation""",
        "priced": f"""
            SELECT year, quarter, {PLACE}, market, packid, sales / price AS units, sales FROM (
                SELECT d.*, coalesce(a.price, b.price, c.price, e.price, g.price, h.price) AS price FROM dated d
                LEFT JOIN (SELECT packid, province, city, quarter, sum(sales) / sum(units) AS price FROM run_sample GROUP BY ALL) a USING (packid, province, city, quarter)
                LEFT JOIN (SELECT packid, province, city, year, sum(sales) / sum(units) AS price FROM run_sample GROUP BY ALL) b USING (packid, province, city, year)
                LEFT JOIN (SELECT packid, province, quarter, sum(sales) / sum(units) AS price FROM run_sample GROUP BY ALL) c USING (packid, province, quarter)
                LEFT JOIN (SELECT packid, province, year, sum(sales) / sum(units) AS price FROM run_sample GROUP BY ALL) e USING (packid, province, year)
                LEFT JOIN (SELECT packid, quarter, sum(sales) / sum(units) AS price FROM run_sample GROUP BY ALL) g USING (packid, quarter)
                LEFT JOIN (SELECT packid, year, sum(sales) / sum(units) AS price FROM run_sample GROUP BY ALL) h USING (packid, year))
            WHERE price > 0 AND sales > 0""",
        **{name: _renamed(sql, {"panel": "priced"}).replace(_SPLIT, split).replace("'NATION_2', 'NATION_5', 'NATION_9'", "'NATION_0', 'NATION_2', 'NATION_5', 'NATION_9'") for name, sql in _FORMAT_VIEWS.items()},
        "quarter_rows": "SELECT * EXCLUDE (src, rn) REPLACE (arg_min(product_cn, rn) OVER (PARTITION BY product) AS product_cn) FROM ranked",
        "run_history": f"""
            SELECT * REPLACE ({_second_category('sql')} AS category_2, lpad(packid, 7, '0') AS packid) FROM past
            UNION ALL BY NAME SELECT * REPLACE (lpad(packid, 7, '0') AS packid) FROM residual WHERE date < {at}""",
        "proxy_growth": f"""
            SELECT market, category_2, packid, lead(value_lc) OVER w / value_lc AS gs, lead(units) OVER w / units AS gu FROM (
                SELECT market, category_2, packid, date, value_lc, units FROM run_history
                WHERE city = '{_PROXY}' AND date = (SELECT q1 FROM this_quarter)
                UNION ALL SELECT market, category_2, packid, date, value_lc, units FROM quarter_rows WHERE city = '{_PROXY}')
            WINDOW w AS (PARTITION BY market, category_2, packid ORDER BY date, value_lc, units) QUALIFY gs IS NOT NULL""",
        "city_rolled": f"""
            SELECT {dims}, h.packid, substr({at}, 5) AS quarter, {at} AS date, {grown('coalesce(g.gs, x.gs)', 'coalesce(g.gu, x.gu)')}
            FROM run_history h
            LEFT JOIN proxy_growth g ON g.market IS NOT DISTINCT FROM h.market AND g.category_2 IS NOT DISTINCT FROM h.category_2 AND g.packid IS NOT DISTINCT FROM h.packid
            LEFT JOIN (SELECT * FROM pack_growth WHERE isfinite(gs) AND isfinite(gu)) x ON x.pack_id = h.packid
            WHERE h.city = '{_MISSING}' AND h.date = (SELECT q1 FROM this_quarter) AND coalesce(g.gs, x.gs) > 0 AND coalesce(g.gu, x.gu) > 0""",
        "residual_rolled": f"""
            SELECT h.channel, h.city_en, h.city, h.period_type, h.year, h.molecule, h.category_2, h.market, lpad(h.packid, 7, '0') AS packid,
                   substr({at}, 5) AS quarter, {at} AS date, {grown('(h.value_lc / b.value_lc)', '(h.units / b.units)')}
            FROM residual h JOIN residual b ON h.city = b.city AND h.date = (SELECT q1 FROM this_quarter) AND b.date = (SELECT q2 FROM this_quarter)""",
        "run_current": f"SELECT * FROM quarter_rows WHERE city <> '{_MISSING}' UNION ALL BY NAME SELECT * FROM city_rolled UNION ALL BY NAME SELECT * FROM residual_rolled",
        "run_four": "SELECT 0 AS src, * FROM run_history WHERE date >= (SELECT q3 FROM this_quarter) UNION ALL BY NAME SELECT 1 AS src, * FROM run_current",
        "run_named": "SELECT * EXCLUDE (product_name, product, corp, route, tender_round), "
        + newest(four, "city, packid", {"product_name": "last", "product": "last", "corp": "last", "route": "first_known", "tender_round": "last_known"})
        + " FROM run_four",
        "run_mat": f"""
            SELECT {keys}, quarter, date, {', '.join(f'sum({m}) AS {m}' for m in MEASURES)}
            FROM (SELECT * REPLACE ('MAT' AS period_type, substr({at}, 1, 4) AS year, substr({at}, 5) AS quarter, {at} AS date) FROM run_named)
            GROUP BY {keys}, quarter, date""",
        "run_stacked": "SELECT 0 AS src, * FROM run_history UNION ALL BY NAME SELECT 1 AS src, * FROM run_current UNION ALL BY NAME SELECT 2 AS src, * FROM run_mat",
        "run_delivery": "SELECT * EXCLUDE (src, product_name, product, corp, corp_cn, product_cn, route), "
        + newest(stacked, "packid", {"product_name": "last", "product": "last", "corp": "last", "corp_cn": "last", "product_cn": "last_known", "route": "first_known"})
        + " FROM run_stacked",
    }


def _renamed(sql: str, tables: dict[str, str]) -> str:
    for old, new in tables.items():
        sql = re.sub(rf"\b(FROM|JOIN)\s+{old}\b", rf"\1 {new}", sql)
    return sql


@query(
    "delivery_run",
    with_views(
        "SELECT * REPLACE (" + ", ".join(f"floor({m} * 100 + 0.5) / 100 AS {m}" for m in MEASURES) + ") FROM run_delivery",
        **_run_views(),
    ),
)
def delivery_run(fx: Fixtures) -> DataFrame:
    """Raw exports of two providers to the delivery: every stage of the batch, published one by one."""
    root = _scratch(fx, "run")
    reporting = Fixtures(fx.spark, fx.dir)
    known = fx.panel_sales.filter(~((F.col("province") == "ASIA") & (F.col("p_type") == "LARGE")) & (F.col("quarter") == fx.quarter))
    reporting.__dict__["sales"] = known  # the raw view over these sales
    raw = reporting.raw_panel
    paths = {}
    for project in ("P1", "P2"):
        paths[project] = f"{root}/{project}"
        raw.filter(F.col("project") == project).write.csv(paths[project], header=True)
    sources = [
        RawSource("first", [paths["P1"]], "UTF-8", rules={"projects": ["P1"], "succession": SUCCESSION}),
        RawSource("second", [paths["P2"]], "UTF-8", rules={"require_code": True, "succession": SUCCESSION}),
    ]
    history = fx.past.withColumn("category_2", _second_category())
    lookups = Lookups(
        files_version(fx.spark, fx.dir), fx.place_lookup, market_definition(fx.market_listing, exclude_atc3=[]), fx.registry, fx.tier_listing, fx.master, fx.tenders, fx.rounds,
        fx.city_names, union_strict(history, fx.residual.filter(F.col("date") < fx.quarter)), fx.external,
    )
    params = Parameters(
        quarter=fx.quarter, target_cities=_RUN_CITIES, impute_region="ASIA", impute_market="Diabetes", missing_city=_MISSING, proxy_city=_PROXY,
        residual_molecule="Others", exclude_donor_provinces=NO_DONORS, tcm_products=TCM_PRODUCTS, rules=replace(RULES, market_split=_RUN_SPLIT),
    )
    delivery = whole_run(StageStore(fx.spark, f"{root}/stages"), sources, lookups, params).delivery
    return rounded(delivery, **dict.fromkeys(MEASURES, 2))
