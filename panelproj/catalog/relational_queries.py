"""Sources, projection, filters, joins, aggregates, windows, sorts, unions, reshaping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelproj.catalog.fixtures import MONTHS, QUARTERS, Fixtures
from panelproj.catalog.registry import query, rounded
from panelproj.catalog.sql_views import FACT_KEYS, with_views
from panelproj.functions import first_known, if_else, is_in, mean_known, not_in, ratio, sum_known
from panelproj.operators.periods import lead_growth
from panelproj.operators.price import price_level_table
from panelproj.operators.project import district_mapping, ratio_of_means, sample_share
from panelproj.operators.relational import (
    drop_by_prefix,
    exclude_class,
    fill_from_group,
    flag_membership,
    keep_minimum,
    keep_repeated,
    lookup_matched,
    na_anti,
    na_join,
    na_join_repeated,
    replace_slice,
    sort_rows,
    spread,
    sum_by,
    tag_rows,
    union_strict,
    weighted_quantile,
)
from panelproj.operators.reshape import densify, pivot_longer, pivot_longer_split, pivot_wider
from panelproj.operators.review import duplicate_key_check
from panelproj.sources import checkpoint_dir, read_parts, read_raw_csv, read_sheet, write_history, write_report


def _scratch(fx: Fixtures, name: str) -> str:
    import uuid

    return f"{checkpoint_dir(fx.spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks -------------------------------------------------------------


@query("ingest_csv_roundtrip", with_views("SELECT * FROM raw_panel"))
def ingest_csv_roundtrip(fx: Fixtures) -> DataFrame:
    """Write the raw panel as GB18030 text and read it back with its schema."""
    path = _scratch(fx, "raw-csv")
    fx.spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    fx.raw_panel.write.csv(path, header=True, encoding="GB18030", compression="gzip")
    return read_raw_csv(fx.spark, path, T.StructType(fx.raw_panel.schema.fields))


@query("sheet_first_columns", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def sheet_first_columns(fx: Fixtures) -> DataFrame:
    """An exported sheet: its header line goes by position, and only its first columns are read."""
    path = _scratch(fx, "sheet")
    fx.table("part").select("p_partkey", "p_brand", "p_retailprice", "p_type", "p_name").write.csv(path, header=True)
    schema = T.StructType().add("p_partkey", T.LongType()).add("p_brand", "string").add("p_retailprice", "double")
    return read_sheet(fx.spark, path, schema.add("p_type", "string").add("p_name", "string"), first_columns=3)


@query(
    "report_sorted",
    with_views("SELECT channel, period_type, date, city_en, market, packid, value_lc FROM history"),
)
def report_sorted(fx: Fixtures) -> DataFrame:
    """The delivery's report, written in its order and read again."""
    path = _scratch(fx, "report")
    rows = fx.history.select("channel", "period_type", "date", "city_en", "market", "packid", "value_lc")
    write_report(rows, path, ["channel", "-period_type", "date", "city_en", "market", "packid"])
    return fx.spark.read.schema(rows.schema).parquet(path)


@query(
    "multipart_source_tagged",
    with_views("""
    SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS sheet, city, packid, sum(sales) AS sales
    FROM sales GROUP BY ALL"""),
)
def multipart_source_tagged(fx: Fixtures) -> DataFrame:
    paths = []
    for flag in ("A", "N", "R"):
        path = _scratch(fx, f"part-{flag}")
        fx.sales.filter(F.col("l_returnflag") == flag).select("city", "packid", "sales").write.parquet(path)
        paths.append(path)
    return sum_by(read_parts(fx.spark, paths), ["sheet", "city", "packid"], ["sales"])


@query(
    "history_plus_current",
    with_views(f"""
    SELECT channel, city, market, packid, value_lc, units, date FROM past
    UNION ALL SELECT channel, city, market, packid, value_lc * 2, units, date FROM current_q"""),
)
def history_plus_current(fx: Fixtures) -> DataFrame:
    """Append a quarter to the partitioned history, then replace only that quarter."""
    path, columns = _scratch(fx, "history"), ["channel", "city", "market", "packid", "value_lc", "units", "date"]
    write_history(union_strict(fx.past, fx.current).select(*columns), path)
    write_history(fx.current.select(*columns).withColumn("value_lc", F.col("value_lc") * 2), path)
    schema = fx.past.select(*columns).schema
    return fx.spark.read.schema(schema).parquet(path)


# --- projection, filters, predicates --------------------------------------------------


@query(
    "mutate_sequential",
    """SELECT l_orderkey, l_linenumber, l_partkey, a, b, a + b AS c FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 AS a, l_quantity * 2 + l_linenumber AS b FROM lineitem)""",
)
def mutate_sequential(fx: Fixtures) -> DataFrame:
    rows = fx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    rows = rows.withColumn("a", F.col("l_quantity") * 2).withColumn("b", F.col("a") + F.col("l_linenumber"))
    return rows.withColumn("c", F.col("a") + F.col("b")).drop("l_quantity")


@query("const_flag", "SELECT c_custkey, c_name, 0 AS flag, 'CHC' AS channel FROM customer")
def const_flag(fx: Fixtures) -> DataFrame:
    return fx.table("customer").select("c_custkey", "c_name").withColumns({"flag": F.lit(0), "channel": F.lit("CHC")})


@query("select_rename", "SELECT o_orderstatus AS status, o_orderkey AS id, o_custkey AS centre FROM orders")
def select_rename(fx: Fixtures) -> DataFrame:
    return fx.table("orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("centre")
    )


@query("drop_by_prefix", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def drop_by_prefix_query(fx: Fixtures) -> DataFrame:
    rows = fx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    return drop_by_prefix(rows.withColumnsRenamed({"l_tax": "Growth_tax"}).withColumn("growth_x", F.lit(1)), "growth_")


@query(
    "filter_conjunction",
    with_views("SELECT hospital_name, month, packcode, value FROM raw_panel WHERE project = 'P1' AND packcode IS NOT NULL AND volume IS NULL"),
)
def filter_conjunction(fx: Fixtures) -> DataFrame:
    rows = fx.raw_panel.filter((F.col("project") == "P1") & F.col("packcode").isNotNull() & F.col("volume").isNull())
    return rows.select("hospital_name", "month", "packcode", "value")


@query(
    "filter_positive",
    with_views("SELECT hospital_name, month, volume, price FROM raw_panel WHERE volume > 0 AND price > 0"),
)
def filter_positive(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.filter((F.col("volume") > 0) & (F.col("price") > 0)).select("hospital_name", "month", "volume", "price")


@query(
    "finite_filter",
    with_views("SELECT hospital_name, month, value, value / price AS units FROM raw_panel WHERE price <> 0"),
)
def finite_filter(fx: Fixtures) -> DataFrame:
    rows = fx.raw_panel.withColumn("units", ratio("value", "price"))
    return rows.filter(F.abs("units") < float("inf")).select("hospital_name", "month", "value", "units")


@query("isin_literal", with_views("SELECT pchc, city, est FROM places WHERE city IN ('NATION_3', 'NATION_9', 'National')"))
def isin_literal(fx: Fixtures) -> DataFrame:
    return fx.places.filter(is_in("city", ["National", "NATION_3", "NATION_9"])).select("pchc", "city", "est")


@query(
    "not_isin_null_kept",
    with_views("""
    SELECT hospital_name, month, packcode, volume FROM raw_panel
    WHERE volume IS NULL OR NOT (volume IN (1, 2, 3, 50))"""),
)
def not_isin_null_kept(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.filter(not_in("volume", [1, 2, 3, 50])).select("hospital_name", "month", "packcode", "volume")


@query(
    "class_allowlist",
    with_views("""
    SELECT city, date, packid, atc3, product_cn FROM history
    WHERE NOT (atc3 = 'V03B' AND NOT coalesce(product_cn IN ('cn v1', 'cn v7'), FALSE))"""),
)
def class_allowlist(fx: Fixtures) -> DataFrame:
    rows = exclude_class(fx.history, "atc3", "V03B", "product_cn", ["cn v1", "cn v7"])
    return rows.select("city", "date", "packid", "atc3", "product_cn")


@query("filter_regex", with_views("SELECT pchc, hospital FROM places WHERE regexp_matches(hospital, 'station')"))
def filter_regex(fx: Fixtures) -> DataFrame:
    return fx.places.filter(F.col("hospital").rlike("station")).select("pchc", "hospital")


# --- joins ----------------------------------------------------------------------------


@query(
    "left_join_nullsafe",
    with_views("""
    SELECT p.pchc, p.district, s.total FROM (SELECT pchc, province, nullif(district, 'MACHINERY') AS district FROM places) p
    LEFT JOIN (SELECT province, nullif(district, 'MACHINERY') AS district, sum(sales) AS total FROM sales
               WHERE district <> 'BUILDING' GROUP BY ALL) s
    ON p.province = s.province AND p.district IS NOT DISTINCT FROM s.district"""),
)
def left_join_nullsafe(fx: Fixtures) -> DataFrame:
    hidden = F.when(F.col("district") != "MACHINERY", F.col("district"))
    totals = fx.sales.filter(F.col("district") != "BUILDING").withColumn("district", hidden)
    totals = totals.groupBy("province", "district").agg(F.sum("sales").alias("total"))
    rows = fx.places.withColumn("district", hidden)
    return na_join(rows, totals, ["province", "district"], "left").select("pchc", "district", "total")


@query(
    "left_join_renamed",
    with_views("SELECT p.pchc, p.city, c.city_en FROM places p LEFT JOIN city_names c ON p.city = c.city AND p.city <> 'NATION_4'"),
)
def left_join_renamed(fx: Fixtures) -> DataFrame:
    names = fx.city_names.filter(F.col("city") != "NATION_4").withColumnRenamed("city", "name")
    return na_join(fx.places.select("pchc", "city"), names, [("city", "name")], "left")


@query(
    "inner_join_fanout",
    with_views("SELECT p.packid, p.atc3, p.molecule, m.market FROM packs p JOIN market_listing m ON p.atc3 = m.atc3 AND p.molecule = m.molecule"),
)
def inner_join_fanout(fx: Fixtures) -> DataFrame:
    rows = fx.packs.select("packid", "atc3", "molecule")
    return na_join_repeated(rows, fx.market_listing, ["atc3", "molecule"], fx.pack_blocks).select("packid", "atc3", "molecule", "market")


@query(
    "lookup_keep_matched",
    with_views("""
    SELECT r.hospital_name, r.month, r.value, l.pchc FROM raw_panel r
    JOIN (SELECT hospital, max(pchc) AS pchc FROM place_lookup GROUP BY hospital) l ON r.hospital_name = l.hospital"""),
)
def lookup_keep_matched(fx: Fixtures) -> DataFrame:
    codes = fx.place_lookup.groupBy("hospital").agg(F.max("pchc").alias("pchc"))
    rows = fx.raw_panel.select("hospital_name", "month", "value")
    return lookup_matched(rows, codes, [("hospital_name", "hospital")], "pchc")


@query(
    "anti_join_membership",
    with_views("SELECT * EXCLUDE (flag) FROM panel WHERE pchc NOT IN (SELECT pchc FROM universe)"),
)
def anti_join_membership(fx: Fixtures) -> DataFrame:
    return na_anti(fx.panel.drop("flag"), fx.universe, ["pchc"])


@query("membership_flag", with_views("SELECT pchc, city, CASE WHEN pchc IN (SELECT pchc FROM panel) THEN 1 ELSE 0 END AS flag_sample FROM places"))
def membership_flag(fx: Fixtures) -> DataFrame:
    return flag_membership(fx.places.select("pchc", "city"), fx.panel, ["pchc"], "flag_sample")


# --- aggregates -----------------------------------------------------------------------


@query("agg_sum_rollup", with_views(f"SELECT {FACT_KEYS}, sum(units) AS units, sum(sales) AS sales FROM sales GROUP BY ALL"))
def agg_sum_rollup(fx: Fixtures) -> DataFrame:
    keys = FACT_KEYS.split(", ")
    return sum_by(spread(fx.sales, fx.parts, *keys), keys, ["units", "sales"])


@query(
    "agg_weighted_sum",
    with_views("SELECT city, packid, floor((sum(sales * (1 - l_discount))) * 100 + 0.5) / 100 AS net FROM sales GROUP BY ALL"),
)
def agg_weighted_sum(fx: Fixtures) -> DataFrame:
    net = F.sum(F.col("sales") * (1 - F.col("l_discount")))
    return rounded(fx.sales.groupBy("city", "packid").agg(net.alias("net")), net=2)


@query("agg_mean", with_views("SELECT province, city, district, avg(nullif(est, 0)) AS est FROM places GROUP BY ALL"))
def agg_mean(fx: Fixtures) -> DataFrame:
    return fx.places.groupBy("province", "city", "district").agg(mean_known(F.nullif(F.col("est"), F.lit(0.0))).alias("est"))


_LEVELS = {
    "price_city_quarter": "province, city, quarter",
    "price_city_year": "province, city, year",
    "price_province_quarter": "province, quarter",
    "price_province_year": "province, year",
    "price_pack_quarter": "quarter",
    "price_pack_year": "year",
}


@query(
    "price_levels",
    with_views(
        " UNION ALL BY NAME ".join(
            f"SELECT '{name}' AS level, packid, {keys}, sum(sales) / sum(units) AS price FROM panel GROUP BY packid, {keys}"
            for name, keys in _LEVELS.items()
        )
    ),
)
def price_levels_query(fx: Fixtures) -> DataFrame:
    return price_level_table(fx.panel)


@query(
    "agg_first_ordered",
    with_views("SELECT pchc, arg_min(packid, date || market || packid) AS packid, arg_min(quarter, date || market || packid) AS quarter FROM sales GROUP BY pchc"),
)
def agg_first_ordered(fx: Fixtures) -> DataFrame:
    order = F.struct("date", "market", "packid")
    return spread(fx.sales, fx.parts, "pchc").groupBy("pchc").agg(F.min_by("packid", order).alias("packid"), F.min_by("quarter", order).alias("quarter"))


@query("golden_record", with_views("SELECT * FROM master_rows"))
def golden_record(fx: Fixtures) -> DataFrame:
    from panelproj.operators.dims import product_master

    no_names = fx.fallback_names.filter(F.col("packid").isNull())
    return product_master(fx.product_sources, fx.corporations, no_names)


@query(
    "agg_expr_keys",
    with_views("SELECT city AS place, substr(packid, 1, 5) AS prodid, 'MAT' AS period_type, sum(units) AS units FROM sales GROUP BY ALL"),
)
def agg_expr_keys(fx: Fixtures) -> DataFrame:
    keys = [F.col("city").alias("place"), F.substring("packid", 1, 5).alias("prodid"), F.lit("MAT").alias("period_type")]
    return sum_by(fx.sales, keys, ["units"])


@query(
    "district_mapping",
    with_views("SELECT province, city, district, avg(est) AS est, sum(flag_sample) AS sample FROM universe GROUP BY ALL"),
)
def district_mapping_query(fx: Fixtures) -> DataFrame:
    return district_mapping(fx.universe)


@query("distinct_rows", with_views("SELECT DISTINCT province, city, district, date, market, packid FROM sales"))
def distinct_rows(fx: Fixtures) -> DataFrame:
    return fx.sales.select("province", "city", "district", "date", "market", "packid").distinct()


@query(
    "distinct_computed",
    with_views("SELECT DISTINCT replace(month, '/', '') AS date, substr(atc4_code, 1, 4) AS atc3, molecule_desc AS molecule FROM raw_panel"),
)
def distinct_computed(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.select(
        F.replace("month", F.lit("/"), F.lit("")).alias("date"),
        F.substring("atc4_code", 1, 4).alias("atc3"),
        F.col("molecule_desc").alias("molecule"),
    ).distinct()


@query(
    "quantile_cap",
    with_views("""
    SELECT city, packid, sales, least(sales, (SELECT quantile_cont(sales, 0.9) FROM sales)) AS capped FROM
    (SELECT city, packid, max(sales) AS sales FROM sales GROUP BY ALL)"""),
)
def quantile_cap(fx: Fixtures) -> DataFrame:
    counted = fx.sales.groupBy("sales").agg(F.count("*").alias("n"))
    cap = weighted_quantile(counted, "sales", "n", 0.9)
    rows = fx.sales.groupBy("city", "packid").agg(F.max("sales").alias("sales"))
    return rows.withColumn("capped", F.least("sales", cap.scalar()))


# --- group values written to rows ----------------------------------------------------


@query(
    "window_ratio_of_means",
    with_views("""
    SELECT pchc, district, flag_sample, est, avg(units) OVER w / avg(est) OVER w AS rate FROM
    (SELECT u.*, s.units FROM universe u LEFT JOIN (SELECT pchc, sum(units) AS units FROM sales GROUP BY pchc) s USING (pchc))
    WINDOW w AS (PARTITION BY district, flag_sample)"""),
)
def window_ratio_of_means(fx: Fixtures) -> DataFrame:
    rows = na_join(fx.universe, sum_by(fx.sales, ["pchc"], ["units"]), ["pchc"], "left")
    return ratio_of_means(rows, ["district", "flag_sample"], {"rate": "units"}, "est").select(
        "pchc", "district", "flag_sample", "est", "rate"
    )


@query(
    "window_sample_share",
    with_views("SELECT pchc, city, sum(flag_sample) OVER (PARTITION BY city) / count(*) OVER (PARTITION BY city) AS share FROM universe"),
)
def window_sample_share(fx: Fixtures) -> DataFrame:
    return sample_share(fx.universe, ["city"]).select("pchc", "city", "share")


@query(
    "window_first_nonnull",
    with_views("""
    SELECT city, date, market, packid,
           first_value(route IGNORE NULLS) OVER (PARTITION BY packid ORDER BY date, city, market
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS route FROM history"""),
)
def window_first_nonnull(fx: Fixtures) -> DataFrame:
    rows = fx.history.select("city", "date", "market", "packid", F.col("route").alias("own"))
    return fill_from_group(rows, ["packid"], {"route": first_known("own", ["date", "city", "market"])}).drop("own")


@query(
    "window_last_value",
    with_views("""
    SELECT city, date, market, packid, last_value(corp) OVER w AS corp, last_value(tender_round IGNORE NULLS) OVER w AS tender_round
    FROM history WINDOW w AS (PARTITION BY city, packid ORDER BY date, market
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""),
)
def window_last_value(fx: Fixtures) -> DataFrame:
    from panelproj.operators.dims import newest_attributes

    rows = fx.history.select("city", "date", "market", "packid", "corp", "tender_round")
    return newest_attributes(rows, ["city", "packid"], ["date", "market"], last=["corp"], last_known=["tender_round"])


@query(
    "window_argmin_filter",
    with_views("SELECT province, city, district, pchc, est FROM universe QUALIFY est = min(est) OVER (PARTITION BY province, city, district)"),
)
def window_argmin_filter(fx: Fixtures) -> DataFrame:
    return keep_minimum(fx.universe.drop("flag_sample"), ["province", "city", "district"], "est")


@query(
    "lead_growth",
    with_views("""
    SELECT * FROM (
        SELECT city, market, packid, lead(value_lc) OVER w / value_lc AS growth_sales, lead(units) OVER w / units AS growth_units
        FROM history WINDOW w AS (PARTITION BY city, market, packid ORDER BY date))
    WHERE growth_sales IS NOT NULL"""),
)
def lead_growth_query(fx: Fixtures) -> DataFrame:
    return lead_growth(fx.history, ["city", "market", "packid"])


@query(
    "duplicate_key_check",
    with_views("""
    SELECT packid, market, atc3, category_2, molecule, product_name, product, product_cn, route, corp, city, date, tender_round,
           count(*) OVER (PARTITION BY packid, market, city, date) AS n
    FROM (SELECT DISTINCT packid, market, atc3, category_2, molecule, product_name, product, product_cn, route, corp, city,
                 date, tender_round
          FROM (SELECT * FROM history UNION ALL SELECT * REPLACE ('B' AS product) FROM history WHERE route IS NULL))
    QUALIFY n > 1"""),
)
def duplicate_key_query(fx: Fixtures) -> DataFrame:
    """A few keys get a second attribute combination, so the check has something to find."""
    second = fx.history.filter(F.col("route").isNull()).withColumn("product", F.lit("B"))
    return duplicate_key_check(union_strict(fx.history, second))


# --- sort and union ---------------------------------------------------------------------


@query("sort_multi", with_views("SELECT city, date, packid, route, value_lc FROM history ORDER BY route DESC NULLS LAST, date, value_lc DESC"))
def sort_multi(fx: Fixtures) -> DataFrame:
    return sort_rows(fx.history.select("city", "date", "packid", "route", "value_lc"), "-route", "date", "-value_lc")


@query(
    "union_by_name",
    with_views("""
    SELECT pchc, city, est, NULL AS hospital, 0 AS _src FROM universe
    UNION ALL SELECT pchc, city, NULL, hospital, 1 FROM place_lookup"""),
)
def union_by_name(fx: Fixtures) -> DataFrame:
    return tag_rows([fx.universe.select("pchc", "city", "est"), fx.place_lookup.select("pchc", "city", "hospital")])


@query(
    "replace_slice",
    with_views("""
    SELECT city, date, packid, value_lc FROM history WHERE city <> 'NATION_20'
    UNION ALL SELECT 'NATION_20', date, packid, value_lc / 2 FROM history WHERE city = 'NATION_0'"""),
)
def replace_slice_query(fx: Fixtures) -> DataFrame:
    rows = fx.history.select("city", "date", "packid", "value_lc")
    new = rows.filter(F.col("city") == "NATION_0").withColumns({"city": F.lit("NATION_20"), "value_lc": F.col("value_lc") / 2})
    return replace_slice(rows, "city", ["NATION_20"], new)


# --- reshape ------------------------------------------------------------------------------


@query(
    "pivot_fill0",
    with_views(
        "SELECT pchc, " + ", ".join(f'sum(CASE WHEN date = \'{m}\' THEN sales ELSE 0 END) AS "{m}"' for m in MONTHS) + " FROM sales GROUP BY pchc"
    ),
)
def pivot_fill0(fx: Fixtures) -> DataFrame:
    return pivot_wider(sum_by(fx.sales, ["pchc", "date"], ["sales"]), ["pchc"], "date", ["sales"], members=MONTHS, fill=0.0)


@query(
    "pivot_two_measures",
    with_views(
        "SELECT city, packid, "
        + ", ".join(f'sum(CASE WHEN quarter = \'{q}\' THEN {m} END) AS "{m}_{q}"' for q in QUARTERS for m in ("sales", "units"))
        + " FROM sales GROUP BY city, packid"
    ),
)
def pivot_two_measures(fx: Fixtures) -> DataFrame:
    rows = sum_by(fx.sales, ["city", "packid", "quarter"], ["sales", "units"])
    return pivot_wider(rows, ["city", "packid"], "quarter", ["sales", "units"], members=QUARTERS)


_EXTERNAL_LONG = " UNION ALL ".join(
    f"SELECT pack_id, '{q}' AS quarter, '{m}' AS measure, \"{q}_{m}\" AS value FROM external"
    for q in QUARTERS
    for m in ("UNIT", "SU", "RENMINBI")
)


@query("unpivot_split", with_views(_EXTERNAL_LONG))
def unpivot_split(fx: Fixtures) -> DataFrame:
    columns = [c for c in fx.external.columns if c.endswith(("UNIT", "SU", "RENMINBI"))]
    return pivot_longer_split(fx.external, ["pack_id"], columns, ("quarter", "measure"), "value")


@query(
    "long_to_measures",
    with_views("SELECT city, market, packid, date, units AS UNIT, counting_units AS SU, value_lc AS RENMINBI FROM history"),
)
def long_to_measures(fx: Fixtures) -> DataFrame:
    ids, names = ["city", "market", "packid", "date"], {"units": "UNIT", "counting_units": "SU", "value_lc": "RENMINBI"}
    rows = fx.history.select(*ids, *names).withColumnsRenamed(names)
    long = pivot_longer(rows, ids, list(names.values()), "measure", "value")
    return pivot_wider(long, ids, "measure", ["value"], members=list(names.values()))


@query(
    "densify_dates",
    with_views("""
    SELECT u.city, u.market, u.packid, d.quarter, s.sales
    FROM (SELECT DISTINCT city, market, packid FROM panel) u CROSS JOIN (SELECT DISTINCT quarter FROM panel) d
    LEFT JOIN (SELECT city, market, packid, quarter, sum(sales) AS sales FROM panel GROUP BY ALL) s
    ON (u.city, u.market, u.packid, d.quarter) = (s.city, s.market, s.packid, s.quarter)"""),
)
def densify_dates(fx: Fixtures) -> DataFrame:
    rows = sum_by(fx.panel, ["city", "market", "packid", "quarter"], ["sales"])
    return densify(rows, ["city", "market", "packid"], "quarter", ["sales"])


# --- conditions -----------------------------------------------------------------------------


@query(
    "if_else_na",
    with_views("SELECT hospital_name, month, packcode, CASE WHEN volume > 25 THEN 'big' WHEN NOT (volume > 25) THEN 'small' END AS size FROM raw_panel"),
)
def if_else_na(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.select(
        "hospital_name", "month", "packcode", if_else(F.col("volume") > 25, F.lit("big"), F.lit("small")).alias("size")
    )


@query(
    "coalesce_chain",
    with_views("SELECT city, date, market, packid, coalesce(tender_round, route, corp, product_cn) AS label FROM history"),
)
def coalesce_chain(fx: Fixtures) -> DataFrame:
    return fx.history.select(
        "city", "date", "market", "packid", F.coalesce("tender_round", "route", "corp", "product_cn").alias("label")
    )


@query(
    "repeated_key_count",
    with_views("SELECT city, packid, date, market, count(*) OVER (PARTITION BY city, packid, date) AS n FROM history QUALIFY n > 1"),
)
def repeated_key_count(fx: Fixtures) -> DataFrame:
    return keep_repeated(fx.history.select("city", "packid", "date", "market"), ["city", "packid", "date"])


@query(
    "known_sum",
    with_views("SELECT city, month, coalesce(sum(CASE WHEN price = 0 THEN volume END), 0) AS unpriced FROM raw_panel GROUP BY ALL"),
)
def known_sum(fx: Fixtures) -> DataFrame:
    return fx.raw_panel.groupBy("city", "month").agg(sum_known(F.when(F.col("price") == 0, F.col("volume"))).alias("unpriced"))
