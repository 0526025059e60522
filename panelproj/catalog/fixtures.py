"""Panel-shaped views over the order tables, as Spark frames.

region -> province, nation -> city, market segment -> district, customer -> centre,
part type -> class and market, brand + size -> 7-character pack code, order date ->
period. Amounts are whole numbers, so sums do not depend on their order.

Which centres report is a property of the data, not of the keys: a city outside EUROPE
has a panel when it has at least the average number of suppliers; there all HOUSEHOLD
centres report, and of the others (MACHINERY never) those with a balance of 5000 or more.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelproj.functions import month_to_quarter, quarter_shift
from panelproj.operators.dims import product_master, tender_packs, tender_rounds
from panelproj.operators.relational import flag_membership, spread, sum_by
from panelproj.operators.standardize import FACT_KEYS
from panelproj.sources import materialize

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
PART_ROWS = 500_000  # order lines in one part of a large table
PACK_ROWS = 5_000  # packs whose pairs are one part's work
QUARTERS = [f"{y}Q{q}" for y in range(1995, 2002) for q in range(1, 5)][:27]
MONTHS = [f"{y}{m:02d}" for y in range(1995, 2002) for m in range(1, 13)][:80]
ATC4 = {"ECONOMY": "C09A1", "STANDARD": "C07A0", "SMALL": "C08A0", "LARGE": "A10H0", "MEDIUM": "C05A0", "PROMO": "V03B1"}
MARKET = {
    "ECONOMY": "HTN", "STANDARD": "HTN", "SMALL": "IHD", "LARGE": "Diabetes", "MEDIUM": "Venous Disease", "PROMO": "Venous Disease",
}
TRACKED = {"AFRICA": "NATION_0", "ASIA": "NATION_2"}
ROUND_LABELS = {1: "4+7", 2: "扩围", 3: "第二批", 4: "第三批"}


def case(c: str, mapping: dict) -> Column:
    out: Column = F.lit(None)
    for key, value in mapping.items():
        out = F.when(F.col(c) == key, F.lit(value)).otherwise(out)
    return out


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def parts(self) -> int | None:
        """Parts for joins and groupings of all order lines; none where the session's cores hold them in smaller ones."""
        parts = -(-self.table("lineitem").count() // PART_ROWS)
        return parts if parts > self.spark.sparkContext.defaultParallelism else None

    @cached_property
    def pack_blocks(self) -> int:
        """Parts for joins in which every pack meets very many rows."""
        return max(1, -(-self.table("part").count() // PACK_ROWS))

    @cached_property
    def places(self) -> DataFrame:
        """Centres with their place."""
        nation = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey",
            "c_acctbal",
            F.col("r_name").alias("province"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("district"),
            F.replace("c_name", F.lit("Customer#"), F.lit("C")).alias("pchc"),
            F.floor("c_acctbal").cast("double").alias("est"),
            F.concat_ws(
                " ", "c_name", F.when(F.col("c_mktsegment") == "MACHINERY", "station").otherwise("centre")
            ).alias("hospital"),
        )

    @cached_property
    def packs(self) -> DataFrame:
        brand = F.lpad(F.replace("p_brand", F.lit("Brand#"), F.lit("")), 5, "0")
        return self.table("part").select(
            "p_partkey",
            "p_type",
            "p_name",
            "p_size",
            "p_retailprice",
            F.concat(brand, F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("packid"),
            F.concat(F.lit("MOL"), brand).alias("molecule"),
            F.concat(F.lit("PROD"), brand).alias("product"),
            case("p_type", ATC4).alias("atc4"),
            F.substring(case("p_type", ATC4), 1, 4).alias("atc3"),
            case("p_type", MARKET).alias("market"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("date"))
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            F.floor("l_extendedprice").cast("double").alias("sales"),
        )
        # Lines move twice, to their order with its centre and to their pack; what follows from the month comes last.
        placed = spread(orders, self.parts, "o_custkey").join(self.places, F.col("o_custkey") == F.col("c_custkey"))
        rows = spread(lines, self.parts, "l_orderkey").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        rows = spread(rows, self.parts, "l_partkey").join(self.packs, F.col("l_partkey") == F.col("p_partkey"))
        return rows.withColumns({"year": F.substring("date", 1, 4), "quarter": month_to_quarter("date"), "units": F.col("l_quantity")})

    @cached_property
    def raw_panel(self) -> DataFrame:
        """Dirty export: name suffixes, unpadded or missing codes, missing volume, zero price."""
        return self.sales.select(
            F.when(F.col("o_orderstatus") == "P", "P2").otherwise("P1").alias("project"),
            F.col("year").cast("int").alias("year"),
            "quarter",
            F.concat_ws("/", F.substring("date", 1, 4), F.substring("date", 5, 2)).alias("month"),
            F.concat("province", F.lit("省")).alias("province"),
            F.when(F.col("city") == "NATION_4", "市辖区").otherwise(F.concat("city", F.lit("市"))).alias("city"),
            F.col("district").alias("county"),
            F.col("hospital").alias("hospital_name"),
            F.col("atc4").alias("atc4_code"),
            F.col("molecule").alias("molecule_desc"),
            F.when(F.col("l_tax") != 0, F.col("packid").cast("int").cast("string")).alias("packcode"),
            F.when(F.col("l_returnflag") != "N", F.col("units")).alias("volume"),
            F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.col("sales") / F.col("units")).alias("price"),
            F.col("sales").alias("value"),
        )

    @cached_property
    def place_lookup(self) -> DataFrame:
        """Registered centres (positive balance) by cleaned place and name."""
        city = F.when(F.col("city") == "NATION_4", "北京").otherwise(F.col("city"))
        return self.places.filter(F.col("c_acctbal") > 0).select(
            "province", city.alias("city"), "district", "hospital", "pchc"
        )

    @cached_property
    def market_listing(self) -> DataFrame:
        """Class and molecule to market; two classes are listed in two markets, V03 in none."""
        listed = self.packs.filter(F.col("p_type") != "PROMO").select("atc3", "molecule", "market")
        shared = self.packs.filter(F.col("atc3").isin("C07A", "C08A")).select(
            "atc3", "molecule", F.when(F.col("market") == "HTN", "IHD").otherwise("HTN").alias("market")
        )
        return listed.unionByName(shared)

    @cached_property
    def panel_cities(self) -> DataFrame:
        nation, supplier = self.table("nation"), self.table("supplier")
        nation = nation.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        per_city = nation.join(supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy(
            F.col("n_name").alias("city"), F.col("r_name").alias("province")
        ).agg(F.count("s_suppkey").alias("n"))
        average = per_city.agg(F.avg("n")).scalar()
        return per_city.filter((F.col("n") >= average) & (F.col("province") != "EUROPE")).select("city")

    @cached_property
    def panel_sales(self) -> DataFrame:
        reports = (F.col("district") == "HOUSEHOLD") | ((F.col("district") != "MACHINERY") & (F.col("c_acctbal") >= 5000))
        return self.sales.filter(reports).join(self.panel_cities, "city", "left_semi")

    @cached_property
    def panel(self) -> DataFrame:
        """Canonical facts of the reporting centres, all periods."""
        rows = spread(self.panel_sales, self.parts, *FACT_KEYS)
        return sum_by(rows, FACT_KEYS, ["units", "sales"]).withColumn("flag", F.lit(0))

    @cached_property
    def universe(self) -> DataFrame:
        centres = self.places.filter(F.col("est") > 0).select("pchc", "province", "city", "district", "est")
        return flag_membership(centres, self.panel_sales, ["pchc"], "flag_sample")

    @cached_property
    def written_panel(self) -> DataFrame:
        """The panel as a stored table, for queries that read it several times."""
        return materialize(self.panel, "fact-panel")

    @cached_property
    def written_universe(self) -> DataFrame:
        """The universe as a stored table; its sampled centres are those of the panel, whose keys hold the centre."""
        centres = self.places.filter(F.col("est") > 0).select("pchc", "province", "city", "district", "est")
        return materialize(flag_membership(centres, self.written_panel, ["pchc"], "flag_sample"), "centre-universe")

    @cached_property
    def registry(self) -> DataFrame:
        """Centre sizes from balances and from open orders, with place suffixes."""
        place = [
            F.concat("province", F.lit("省")).alias("province"), F.concat("city", F.lit("市")).alias("city"), "district", "pchc",
        ]
        orders = self.table("orders").filter(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(
            F.sum(F.floor("o_totalprice")).cast("double").alias("o_est")
        )
        placed = self.places.join(orders, F.col("c_custkey") == F.col("o_custkey"))
        return self.places.select(*place, "est").unionByName(placed.select(*place, F.col("o_est").alias("est")))

    @cached_property
    def tier_listing(self) -> DataFrame:
        """City tiers with missing values and a repeated city."""
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("city"))
        suppliers = nation.join(self.table("supplier"), F.col("s_nationkey") == F.col("n_nationkey"))
        mean = F.avg(F.floor("s_acctbal"))
        tiers = suppliers.groupBy("city").agg(
            F.when(mean >= 4700, 1.0).when(mean >= 4300, 2.0).when(mean >= 4000, 3.0).alias("city_tier")
        )
        unknown = suppliers.filter(F.col("s_acctbal") < 0).select("city", F.lit(None).cast("double").alias("city_tier")).distinct()
        extra = nation.filter(F.col("city") == "NATION_7").select("city", F.lit(2.0).alias("city_tier"))
        return tiers.unionByName(unknown).unionByName(extra)

    @cached_property
    def tiers(self) -> DataFrame:
        from panelproj.operators.dims import city_tier

        return city_tier(self.tier_listing, ["city_tier"])

    @cached_property
    def city_names(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_name").alias("city"), F.replace("n_name", F.lit("NATION_"), F.lit("City ")).alias("city_en")
        )

    @cached_property
    def history(self) -> DataFrame:
        """Delivery-like rows of every quarter; codes are unpadded."""
        # Text attributes come from numbers, so that the grouping can hash.
        prefix, version = F.substring("packid", 1, 5), F.max("l_linenumber").cast("string")
        low, high = F.min(F.ascii("l_returnflag")), F.max(F.ascii("l_returnflag"))
        line, p = F.max(F.ascii("l_linestatus")), F.col("p_size")
        first_class = F.min(F.when(F.col("atc3") == "C09A", 1).when(F.col("atc3") == "C05A", 1).otherwise(2))
        return (
            self.sales.groupBy("city", "year", "quarter", "market", "packid")
            .agg(
                F.when(F.col("market") == "Diabetes", "A10H").when(F.col("market") == "IHD", "C08A")
                .when((F.col("market") == "HTN") & (first_class == 1), "C09A").when(F.col("market") == "HTN", "C07A")
                .when(first_class == 1, "C05A").otherwise("V03B").alias("atc3"),
                F.concat(F.lit("MOL"), prefix).alias("molecule"),
                F.concat(F.lit("PROD"), prefix, F.lit(" v"), version).alias("product_name"),
                F.concat(F.lit("PROD"), prefix).alias("product"),
                F.when(high == 82, F.concat(F.lit("cn v"), version)).alias("product_cn"),
                F.when(low == 65, "oral").when(low == 78, "topical").alias("route"),
                F.when(line == 79, F.concat(F.lit("CORP "), F.chr(low))).alias("corp"),
                F.when(F.min("l_discount") == 0, "R1").alias("tender_round"),
                F.sum("sales").alias("value_lc"),
                F.sum("units").alias("units"),
                F.sum(F.col("units") * p).alias("counting_units"),
            )
            .select(
                F.lit("CHC").alias("channel"),
                F.replace("city", F.lit("NATION_"), F.lit("City ")).alias("city_en"),
                "city",
                F.lit("QTR").alias("period_type"),
                "year",
                F.substring("quarter", 5, 2).alias("quarter"),
                F.col("quarter").alias("date"),
                "atc3",
                "market",
                F.col("market").alias("category_2"),
                "molecule",
                "product_name",
                "product",
                "product_cn",
                F.col("packid").cast("int").cast("string").alias("packid"),
                "route",
                "corp",
                "tender_round",
                "value_lc",
                "units",
                "counting_units",
                F.col("value_lc").alias("value_lc_raw"),
                F.col("units").alias("units_raw"),
                F.col("counting_units").alias("counting_units_raw"),
            )
        )

    @cached_property
    def quarter(self) -> str:
        """The last quarter with orders."""
        return self.table("orders").agg(month_to_quarter(F.date_format(F.max("o_orderdate"), "yyyyMM")).alias("q")).first()["q"]

    @cached_property
    def written_history(self) -> DataFrame:
        """The history as a stored table, as deliveries are."""
        return materialize(self.history, "history")

    def recent(self, quarters: int) -> tuple[DataFrame, DataFrame]:
        """The history before the last quarter and the last quarter, of so many quarters in all; only their sales are aggregated."""
        dates = [quarter_shift(self.quarter, -i) for i in range(quarters)]
        rows = self.history.filter(F.col("date").isin(dates))
        return rows.filter(F.col("date") < self.quarter), rows.filter(F.col("date") == self.quarter).withColumn("packid", F.lpad("packid", 7, "0"))

    @cached_property
    def past(self) -> DataFrame:
        return self.written_history.filter(F.col("date") < self.quarter)

    @cached_property
    def current(self) -> DataFrame:
        return self.written_history.filter(F.col("date") == self.quarter).withColumn("packid", F.lpad("packid", 7, "0"))

    @cached_property
    def residual(self) -> DataFrame:
        """One residual product per city and quarter."""
        rows = self.history.filter(F.col("atc3") == "V03B")
        keys = ["channel", "city_en", "city", "period_type", "year", "quarter", "date"]
        measures = [c for c in rows.columns if c.startswith(("value_lc", "units", "counting_units"))]
        return sum_by(rows, keys, measures).withColumns(
            {"molecule": F.lit("Others"), "category_2": F.lit("TCM"), "market": F.lit("Venous Disease"), "packid": F.lit("99")}
        )

    @cached_property
    def external(self) -> DataFrame:
        """Wide external panel: one row per pack, quarter x measure columns."""
        measures = {"UNIT": F.col("units"), "SU": F.col("units") * F.col("p_size"), "RENMINBI": F.col("sales")}
        sums = [
            F.sum(F.when(F.col("quarter") == q, value)).alias(f"{q}_{name}") for q in QUARTERS for name, value in measures.items()
        ]
        return self.sales.groupBy(F.col("packid").alias("pack_id")).agg(
            F.min("atc3").alias("atc3"), F.min("molecule").alias("molecule"), F.min("product").alias("product"), *sums
        )

    @cached_property
    def product_sources(self) -> list[DataFrame]:
        """Three partial attribute sources over the part table."""
        text = F.when(F.col("p_type") == "PROMO", "SYRUP").when(F.col("p_type") == "SMALL", "CAP  20MG X").otherwise(
            F.concat(F.lit("TAB FILM  "), F.col("p_size").cast("string"), F.lit("MG  "), F.floor(F.col("p_retailprice") / 100).cast("string"))
        )
        long_name = F.concat("product", F.lit("  "), F.upper(F.substring("p_name", 1, 3)))
        first = self.packs.select(
            "packid", F.concat(F.lit("CORP "), "p_type").alias("corp"),
            F.when(F.col("p_type").isin("SMALL", "LARGE"), "L").when(F.col("p_type") != "PROMO", "I").alias("type"),
            "atc3", "atc4", "molecule", long_name.alias("product"), text.alias("pack"),
        ).distinct()
        second = self.packs.filter(F.col("p_size") >= 10).select(
            "packid", "atc3", F.concat(F.lit("class "), "atc3").alias("atc3_cn"), "molecule",
            F.concat(F.lit("m "), "molecule").alias("molecule_cn"), long_name.alias("product"),
            F.when(F.col("p_type") != "MEDIUM", F.concat(F.lit("cn "), "p_name")).alias("product_cn"),
            F.when(F.col("p_type") == "LARGE", "口服固体").when(F.col("p_type") == "PROMO", "外用制剂").alias("route"),
        ).distinct()
        third = self.packs.filter(F.col("p_type") == "PROMO").select(
            "packid", F.concat(F.lit("sup "), "p_name").alias("product_cn"), F.lit("外用制剂").alias("route")
        ).distinct()
        return [first, second, third]

    @cached_property
    def corporations(self) -> DataFrame:
        return self.packs.select(F.concat(F.lit("CORP "), "p_type").alias("name"), F.concat(F.lit("公司 "), "p_type").alias("namec")).distinct()

    @cached_property
    def fallback_names(self) -> DataFrame:
        return self.packs.groupBy("packid").agg(
            F.concat(F.lit("alt "), F.min("p_name")).alias("product_cn"), F.lit("口服固体").alias("route")
        )

    @cached_property
    def master(self) -> DataFrame:
        return product_master(self.product_sources, self.corporations, self.fallback_names)

    @cached_property
    def tender_parts(self) -> DataFrame:
        """Awards in four rounds: what was sold without discount, by return and line status."""
        rounds = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).when(F.col("l_linestatus") == "F", 3).otherwise(4)
        return self.sales.filter(F.col("l_discount") == 0).select(
            rounds.alias("sheet"),
            "province",
            F.concat(F.lit("m "), "molecule").alias("molecule_cn"),
            F.col("packid").cast("int").cast("string").alias("pack_id"),
            F.datediff(F.last_day(F.to_date("date", "yyyyMM")), F.to_date(F.lit("1899-12-30"))).alias("award_serial"),
        )

    @cached_property
    def tenders(self) -> DataFrame:
        return tender_packs(self.tender_parts, self.product_sources[0], city_of_province=TRACKED)

    @cached_property
    def rounds(self) -> DataFrame:
        return tender_rounds(self.tenders, labels=ROUND_LABELS, merge_national=("扩围", "4+7"), exclude_molecules=["MOL00001"])
