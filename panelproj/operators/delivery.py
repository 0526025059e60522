"""Typed delivery table: classification, pack parsing, channel splits, national rollup."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.functions import drop_suffix, first_known, half_even, if_else, is_in, parse_pack, sum_known
from panelproj.functions.missing import _col
from panelproj.operators.relational import exclude_class, fill_from_group, na_join, sum_by, tag_rows
from panelproj.sources import materialize

# Internal column name -> delivery label, in delivery order.
DELIVERY_LABELS = {
    "channel": "Channel",
    "city_en": "City_EN",
    "city": "City",
    "period_type": "Period Type",
    "year": "Year",
    "quarter": "Quarter",
    "date": "Date",
    "atc3": "ATCIII Code",
    "atc4": "ATCIV Code",
    "market": "MKT",
    "category_1": "Category I",
    "category_2": "Category II",
    "molecule": "Molecule composition Name",
    "product_name": "Product Name",
    "product": "Product",
    "product_cn": "Prod_CN_Name",
    "packid": "Pack Code",
    "pack": "Pack Description",
    "pack_form": "Pack Form",
    "pack_strength": "Pack Strength",
    "pack_size": "Pack Size",
    "route": "NFCI Description",
    "corp": "Corporation Description",
    "corp_cn": "Corporation_CN",
    "manufacture_type": "Manufacture Type",
    "tender_round": "VBP",
    "tender_win": "是否是中标品种",
    "originator": "是否是原研",
    "value_lc": "Value LC",
    "units": "Units",
    "counting_units": "Counting Units",
    "value_lc_raw": "Value LC_Raw",
    "units_raw": "Units_Raw",
    "counting_units_raw": "Counting Units_Raw",
}
DELIVERY_COLUMNS = list(DELIVERY_LABELS)
MEASURES = DELIVERY_COLUMNS[-6:]
DIMENSIONS = DELIVERY_COLUMNS[:-6]

# First category by (market, class).
CATEGORY_1 = {
    ("HTN", "C09A"): "RAASi Plain",
    ("HTN", "C09C"): "RAASi Plain",
    ("HTN", "C09B"): "RAASi FDC",
    ("HTN", "C09D"): "RAASi FDC",
    ("HTN", "C02A"): "ANTI-HTN",
    ("HTN", "C02B"): "ANTI-HTN",
    ("HTN", "C02C"): "ANTI-HTN",
    ("HTN", "C03A"): "DIURETICS",
    ("HTN", "C07A"): "BB",
    ("HTN", "C08A"): "CCB",
    ("HTN", "C08B"): "CCB",
    ("Diabetes", "A10H"): "SULPHONYLUREA",
    ("Diabetes", "A10J"): "BIGUANIDE",
    ("Diabetes", "A10K"): "GLITAZONE",
    ("Diabetes", "A10L"): "AG Is",
    ("Diabetes", "A10M"): "METAGLINIDE",
    ("Diabetes", "A10N"): "DPP-IV",
    ("Diabetes", "A10P"): "SGLT2",
    ("Diabetes", "A10S"): "GLP-1",
    ("Diabetes", "A10X"): "OTHERS",
    ("IHD", "C07A"): "BB",
    ("IHD", "C08A"): "CCB",
    ("IHD", "C08B"): "CCB",
    ("IHD", "C01E"): "NITRITES",
    ("Venous Disease", "C05A"): "HD Topical",
    ("Venous Disease", "C05B"): "CVD Topical",
    ("Venous Disease", "C05C"): "VAD Oral",
}
# Second category by class, then by subclass.
CATEGORY_2 = {"C09A": "ACEi PLAIN", "C09C": "ARB PLAIN"}
CATEGORY_2_SUBCLASS = {"C09B3": "A+C FDC", "C09D3": "A+C FDC", "C09B1": "A+D FDC", "C09D1": "A+D FDC"}
# Final labels.
RELABEL_1 = {"ANTI-HTN": "Others", "DIURETICS": "DU", "RAASi Plain": "RAASi PLAIN", "NITRITES": "LAN"}
RELABEL_2 = {
    "A+C FDC": "A+C",
    "A+D FDC": "A+D",
    "ACEi PLAIN": "ACEI",
    "ARB PLAIN": "ARB",
    "AG Is": "AGI",
    "BIGUANIDE": "MET",
    "DPP-IV": "DPP-4",
    "GLITAZONE": "TZD",
    "METAGLINIDE": "GLINIDE",
    "SULPHONYLUREA": "SU",
}
# Share of a class that belongs to a market when it is listed in two.
MARKET_SPLIT = {("HTN", "C07"): 0.75, ("IHD", "C07"): 0.25, ("HTN", "C08"): 0.9, ("IHD", "C08"): 0.1}
# Tender round by (molecule, route) where the molecule alone does not tell.
ROUTE_ROUNDS = {("TRIMETAZIDINE", "口服固体长效"): "第二批", ("TRIMETAZIDINE", "口服固体"): "第三批"}
TCM_ROUTES = {"口服固体": "TCM Oral", "外用制剂": "TCM Topical"}


@dataclass(frozen=True)
class DeliveryRules:
    """Client rules of the delivery; the defaults are the published ones."""

    category_1: Mapping[tuple[str, str], str] = field(default_factory=lambda: CATEGORY_1)
    category_2: Mapping[str, str] = field(default_factory=lambda: CATEGORY_2)
    category_2_subclass: Mapping[str, str] = field(default_factory=lambda: CATEGORY_2_SUBCLASS)
    relabel_1: Mapping[str, str] = field(default_factory=lambda: RELABEL_1)
    relabel_2: Mapping[str, str] = field(default_factory=lambda: RELABEL_2)
    tcm_routes: Mapping[str, str] = field(default_factory=lambda: TCM_ROUTES)
    market_split: Mapping[tuple[str, str], float] = field(default_factory=lambda: MARKET_SPLIT)
    route_rounds: Mapping[tuple[str, str], str] = field(default_factory=lambda: ROUTE_ROUNDS)
    tcm_class: str = "V03B"
    tcm_prefix: str = "V03"
    venous_market: str = "Venous Disease"
    diabetes_market: str = "Diabetes"
    diabetes_label: str = "OAD&GLP-1"
    nitrate_market: str = "IHD"
    nitrate_class: str = "C01D"
    nitrate_molecule: str = "TRIMETAZIDINE"
    nitrate_labels: tuple[str, str] = ("TMZ", "OTHERS")
    first_as_second: tuple[str, ...] = ("HTN", "Venous Disease")
    main_channel: str = "CHC"
    national: str = "National"


def _mapped(c: Column | str, mapping: Mapping[str, object]) -> Column:
    """Value of a small literal map, NULL where the key is missing or unknown."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), _col(c))


def _mapped_pair(a: Column | str, b: Column | str, mapping: Mapping[tuple[str, str], object]) -> Column:
    key = F.concat(_col(a), F.lit("|"), _col(b))
    return _mapped(key, {f"{x}|{y}": v for (x, y), v in mapping.items()})


def classify(df: DataFrame, rules: DeliveryRules | None = None) -> DataFrame:
    """Two category levels; each step reads the result of the one before."""
    rules = rules or DeliveryRules()
    market, atc3, molecule = F.col("market"), F.col("atc3"), F.col("molecule")
    venous, diabetes = market == rules.venous_market, market == rules.diabetes_market
    nitrate = (market == rules.nitrate_market) & (atc3 == rules.nitrate_class)
    first = (
        F.when(nitrate & (molecule == rules.nitrate_molecule), rules.nitrate_labels[0])
        .when(nitrate & (molecule != rules.nitrate_molecule), rules.nitrate_labels[1])
        .when(venous & F.startswith(atc3, F.lit(rules.tcm_prefix)), "TCM")
        .otherwise(_mapped_pair(market, atc3, rules.category_1))
    )
    c1, c2 = F.col("category_1"), F.col("category_2")
    return (
        df.withColumn("category_1", first)
        .withColumn("category_2", F.coalesce(_mapped(atc3, rules.category_2), _mapped("atc4", rules.category_2_subclass)))
        .withColumn("category_2", if_else(diabetes, c1, c2))
        .withColumn("category_1", F.when(diabetes, rules.diabetes_label).otherwise(F.coalesce(_mapped(c1, rules.relabel_1), c1)))
        .withColumn("category_2", F.coalesce(_mapped(c2, rules.relabel_2), c2))
        .withColumn("category_2", F.when(venous, F.when(c1 == "TCM", _mapped("route", rules.tcm_routes))).otherwise(c2))
        .withColumn("category_2", F.when(c2.isNull() & is_in(market, rules.first_as_second), c1).otherwise(c2))
    )


def split_markets(df: DataFrame, measures: Mapping[str, str], rules: DeliveryRules | None = None) -> DataFrame:
    """Scale measures of classes listed in two markets by the market's share."""
    rules = rules or DeliveryRules()
    share = F.coalesce(_mapped_pair("market", F.substring("atc3", 1, 3), rules.market_split), F.lit(1.0))
    return df.withColumns({new: F.col(old) * share for new, old in measures.items()})


def origin_flags(df: DataFrame) -> DataFrame:
    local = F.col("type") != "L"
    return df.withColumns(
        {"originator": if_else(local, F.lit("原研"), F.lit("仿制")), "manufacture_type": if_else(local, F.lit("MNC"), F.lit("Local"))}
    )


def city_table(
    facts: DataFrame, master: DataFrame, tenders: DataFrame, city_names: DataFrame, rules: DeliveryRules | None = None
) -> DataFrame:
    """Quarterly city rows with product attributes and rounded, split measures."""
    keys = ["channel", "year", "quarter", "province", "city", "market", "packid"]
    rows = sum_by(facts, keys, ["sales", "units"])
    rows = na_join(rows, city_names.select("city", "city_en"), ["city"], "left")
    rows = na_join(rows, master, ["packid"], "left")
    rows = na_join(rows, tenders.select("city", "molecule", "packid", "tender_win"), ["city", "molecule", "packid"], "left")
    rows = split_markets(classify(parse_pack(origin_flags(rows)), rules), {"sales_adj": "sales", "units_adj": "units"}, rules)
    rows = rows.withColumns(
        {
            "units_adj": half_even("units_adj"),
            "units": half_even("units"),
            "value_lc": half_even("sales_adj", 2),
            "value_lc_raw": half_even("sales", 2),
        }
    )
    rows = rows.withColumns(
        {
            "counting_units": half_even(F.col("pack_size") * F.col("units_adj")),
            "counting_units_raw": half_even(F.col("pack_size") * F.col("units")),
            "units_raw": F.col("units"),
            "units": F.col("units_adj"),
            "period_type": F.lit("QTR"),
            "date": F.col("quarter"),
            "quarter": F.substring("quarter", 5, 2),
            "product_name": F.col("product"),
            "product": drop_suffix("product", 3),
            "tender_round": F.lit(None).cast("string"),
        }
    )
    return rows.select(*DELIVERY_COLUMNS)


def national_rollup(cities: DataFrame, rules: DeliveryRules | None = None) -> DataFrame:
    """National member summed from the main channel's city rows, followed by all city rows (`_src` 0 / 1)."""
    rules = rules or DeliveryRules()
    firsts = ["manufacture_type", "tender_win", "originator"]
    keys = [c for c in DIMENSIONS if c in cities.columns and c not in ("city_en", "city", "tender_round", *firsts)]
    order = ["channel", "date", "city", "market", "packid"]
    total = (
        cities.filter(F.col("channel") == rules.main_channel)
        .groupBy(*keys)
        .agg(
            *[first_known(c, [*order, c]).alias(c) for c in firsts if c in cities.columns],
            *[sum_known(m).alias(m) for m in MEASURES if m in cities.columns],
        )
        .withColumns({"city_en": F.lit(rules.national), "city": F.lit(rules.national)})
    )
    return tag_rows([total, cities])


def format_delivery(
    facts: DataFrame,
    master: DataFrame,
    tenders: DataFrame,
    rounds: DataFrame,
    city_names: DataFrame,
    *,
    target_cities: Sequence[str],
    tcm_products: Sequence[str],
    rules: DeliveryRules | None = None,
) -> DataFrame:
    """Projected facts -> delivery rows of one or more quarters.

    The city rows feed the national member and the detail, so they are written once to
    the shared folder.
    """
    rules = rules or DeliveryRules()
    cities = materialize(city_table(facts, master, tenders, city_names, rules), "city-rows")
    rows = national_rollup(cities, rules).drop("tender_round")
    rows = na_join(rows, rounds, ["city", "molecule"], "left")
    by_route = _mapped_pair("molecule", "route", rules.route_rounds)
    rows = rows.withColumn("tender_round", F.coalesce(by_route, "tender_round"))
    rows = exclude_class(rows, "atc3", rules.tcm_class, "product_name", tcm_products)
    rows = rows.filter(is_in("city", [rules.national, *target_cities]))
    for m in ("value_lc", "units", "counting_units"):
        rows = rows.filter((F.col(m) > 0) & (F.col(m) < float("inf")))
    # National rows follow their grouping keys, city rows channel, date, city, market and pack.
    grouped = [c for c in DIMENSIONS if c in rows.columns and c not in ("city_en", "city", "tender_round", "manufacture_type", "tender_win", "originator")]
    placed = ["channel", "date", "city", "market", "packid"]
    national = F.col("_src") == 0
    keys = {f"__k{i}": F.when(national, F.col(g).cast("string")).otherwise(F.col(placed[i]) if i < len(placed) else None) for i, g in enumerate(grouped)}
    named = fill_from_group(
        rows.withColumn("__cn", F.col("product_cn")).withColumns(keys), ["product"], {"product_cn": first_known("__cn", ["_src", *keys, "__cn"])}
    )
    return named.select(*DELIVERY_COLUMNS)


def label_delivery(df: DataFrame) -> DataFrame:
    """Rename to the delivery labels."""
    return df.select(*[F.col(c).alias(label) for c, label in DELIVERY_LABELS.items() if c in df.columns])
