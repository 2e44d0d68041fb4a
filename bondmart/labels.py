"""Label strings and codes the reports are keyed on.

Fixed values: the strings and codes below must equal the ones the original
nightly jobs read and write, or dashboards reading the report tables break.
They are stated once, in natural order, and every function takes them from
here (most functions also accept an override argument).
"""

# ---- fixed values -------------------------------------------------------

# market name of pledged repo in the market/closing-type feed
PLEDGED_REPO_MARKET = "质押式回购"
# market id of pledged repo in the deal and removed-deal feeds
PLEDGED_REPO_MKT_ID = "109"
# prefix that turns a removed-deal suffix into a repo event id
EVENT_ID_PREFIX = "11002"
# deal status "cancelled"
CANCELLED_STATUS = "2"
# removed-deal feed: kind and reason of a failed settlement
FAILED_KIND = "2"
FAILED_REASON = "1"
# interbank deposit feed: flag of an interbank deal
INTERBANK_FLAG = "1"
# master/slave relation: valid relation kind, valid status, open end date
RELATION_KIND_VALID = "1"
RELATION_STATUS_VALID = "C"
OPEN_END_DATE = "9999-12-31"

# products reported in the price tables
REPORTED_PRODUCTS = ("R001", "R007", "R014")
# currencies kept for cash-bond deals (after trim)
CASH_CURRENCIES = ("CNY", "-")

# participant (join) types of the root roll-up
JT_ALL = "全部"
JT_INSTITUTION = "机构"
JT_MONEY_FUND = "货币市场基金"
JT_PRODUCT = "产品"

# 4-way bond category: kept parent types, everything else is "other"
BOND4_KEPT = ("利率债", "同业存单", "信用债")
BOND_OTHER = "其他"
# rate bonds carry no credit rating
RATE_BOND = "利率债"

# 8-way bond category: raw name -> reported name (anything else: BOND_OTHER)
BOND8_MAP = (
    ("国债", "国债"),
    ("同业存单", "同业存单"),
    ("政策性金融债", "政策性金融债"),
    ("地方政府债", "地方政府债"),
    ("超短期融资券", "短期融资券（包含超短融）"),
    ("短期融资券", "短期融资券（包含超短融）"),
    ("中期票据", "中期票据"),
    ("企业债", "企业债"),
)

# rating buckets, best first, with the raw spellings of the upper two
RATING_AAA = "AAA"
RATING_AA_PLUS = "AA+"
RATING_LOW = "AA及以下"
RATING_AAA_SPELLINGS = ("AAA",)
RATING_AA_PLUS_SPELLINGS = ("AA+", "A-1+", "AA＋")

# maturity buckets in years: (lower bound exclusive, label), highest first;
# at or below 1 year -> MATURITY_LOWEST
MATURITY_BUCKETS = (
    (10, "十年以上"),
    (7, "七年至十年"),
    (5, "五年至七年"),
    (3, "三年至五年"),
    (1, "一年至三年"),
)
MATURITY_LOWEST = "一年及以下"

# deal strategy from the matching status feed
STRATEGY_NORMAL = "正常"
STRATEGY_TACTICAL = "策略性交易"
NORMAL_MATCH_STATUSES = ("0", "4")

# collateral: below this total face value the raw face is used as ratio
ZERO_FACE_EPS = "0.000000001"

# separators of set-valued columns
REPO_SET_SEP = ","
CASH_SET_SEP = "#"

# labels for unresolved lookups in the cash job
UNRESOLVED = "None"
NO_BOND_TYPE = "empty"

# ---- sides (our own names) ---------------------------------------------

SIDE_REPO = "REPO"
SIDE_RVRSE = "RVRSE"
SIDE_BUY = "BUY"
SIDE_SELL = "SELL"
