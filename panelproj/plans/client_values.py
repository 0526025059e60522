"""Client parameters of the published delivery; every operator takes them as arguments."""

from panelproj.plans.delivery_run import Parameters

# Fixed values.
TARGET_CITIES = ["北京", "上海", "杭州", "南京"]
EXCLUDE_DONOR_PROVINCES = ["北京", "上海"]
EXCLUDE_MARKET_CLASSES = ["A10C", "A10D"]
SECOND_CHANNEL = "CHS"
SECOND_CHANNEL_PATTERN = "服务站"
IMPUTE_REGION = "福建"
IMPUTE_MARKET = "Venous Disease"
MISSING_CITY = "上海"
PROXY_CITY = "北京"
RESIDUAL_MOLECULE = "TCM Others"
TENDER_CITY_OF_PROVINCE = {"北京": "北京", "上海": "上海", "浙江": "杭州", "江苏": "南京"}
TENDER_ROUNDS = {1: "4+7", 2: "扩围", 3: "第二批", 4: "第三批"}
TENDER_NATIONAL_MERGE = ("扩围", "4+7")
TENDER_EXCLUDE_MOLECULES = ["TRIMETAZIDINE"]
TENDER_REVIEW_SHEET = 4
TENDER_REVIEW_MOLECULES = ["METFORMIN", "VILDAGLIPTIN", "TRIMETAZIDINE", "VALSARTAN", "CAPTOPRIL"]
BENCHMARK_YEARS = ["2018", "2019", "2020"]
TCM_PRODUCTS = [
    "PU JI              S4I",
    "GANG TAI           SYO",
    "FU ZHI QING        GGS",
    "MUSK HEMORRHOIDS   HMA",
    "SHEXIANG ZHICHUAN  HMA",
    "JIN XUAN ZHI KE    HMA",
    "FU FANG JING JIE   RGZ",
    "ZHI JI             G.Z",
    "NIUHUANG ZHIQING   HJD",
    "JIUHUA ZHICHUANG   JRJ",
    "HUAIYU QINGRE ZHIX HMA",
    "XIAO ZHI           LZF",
]


def published_parameters(quarter: str) -> Parameters:
    """The published run's parameters for one quarter."""
    return Parameters(
        quarter=quarter,
        target_cities=TARGET_CITIES,
        impute_region=IMPUTE_REGION,
        impute_market=IMPUTE_MARKET,
        missing_city=MISSING_CITY,
        proxy_city=PROXY_CITY,
        residual_molecule=RESIDUAL_MOLECULE,
        exclude_donor_provinces=EXCLUDE_DONOR_PROVINCES,
        tcm_products=TCM_PRODUCTS,
    )
