"""Labels, code lists and limits that fix the meaning of the results."""

from decimal import Decimal

# --- Fixed values: order life cycle ------------------------------------------
ORDER_STATUSES = [
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
]
DELIVERED = "delivered"
CANCELLED = "canceled"
CREDIT_CARD = "credit_card"

# --- Fixed values: regions ---------------------------------------------------
CORE_STATES = ["SP", "RJ"]
CUSTOMER_REGIONS = {
    "southeast": ["SP", "RJ", "MG", "ES"],
    "south": ["PR", "SC", "RS"],
    "northeast": ["BA", "PE", "CE", "RN"],
    "center_west": ["DF", "GO", "MT", "MS"],
}
CUSTOMER_REGION_OTHER = "other"
SELLER_REGIONS = {
    "sudeste": ["SP", "RJ", "MG"],
    "sul": ["PR", "SC", "RS"],
    "nordeste": ["BA", "PE", "CE"],
    "centro_oeste": ["DF", "GO", "MT"],
}
SELLER_REGION_OTHER = "outros"

# --- Fixed values: product labels and weight limits (grams) ------------------
CATEGORY_LABELS = {
    "electronics": "电子产品",
    "home_appliance": "家用电器",
    "furniture_decor": "家具装饰",
    "books": "图书",
    "sports_leisure": "运动休闲",
    "toys": "玩具",
    "health_beauty": "健康美容",
    "computers_accessories": "电脑配件",
    "watches_gifts": "钟表礼品",
    "auto": "汽车用品",
}
CATEGORY_OTHER = "其他"
UNKNOWN_CATEGORY = "unknown"
UNKNOWN_CATEGORY_LABEL = "未知品类"
HEAVY_FROM_G = 2000
MEDIUM_FROM_G = 500
WEIGHT_TIERS = ("heavy", "medium", "light", "unknown")

# --- Fixed values: review scores and monthly health --------------------------
SCORES = [1, 2, 3, 4, 5]
BAD_UP_TO = 2
NEUTRAL = 3
GOOD_FROM = 4
HEALTH_LEVELS = [(4.2, "excellent"), (3.8, "good"), (3.5, "warning")]
HEALTH_LOWEST = "critical"
HEALTH_UNKNOWN = "unknown"

# --- Fixed values: customer value segments -----------------------------------
TILES = 4
SEGMENT_HIGH_VALUE = "高价值客户"
SEGMENT_KEEP = "重要保持客户"
SEGMENT_WIN_BACK = "重要挽留客户"
SEGMENT_NEW = "新客/低价值"
SEGMENT_LOST = "流失客户"
SEGMENT_GENERAL = "一般客户"

# --- Fixed values: seller tiers (delivered GMV) ------------------------------
SELLER_TIERS = [(100000, "A_核心卖家"), (20000, "B_重点卖家")]
SELLER_TIER_ACTIVE = "C_普通卖家"
SELLER_TIER_IDLE = "D_无成交"
RISK_SCORE_BELOW = 3

# --- Fixed values: metric catalog --------------------------------------------
# id, Chinese name, English name, domain, unit, definition, source, owner
# The definitions of KPI004 and KPI007 say what their values count.
KPI_TEXTS = [
    ("KPI001", "GMV（标准口径）", "gmv_delivered", "交易域", "BRL",
     "仅统计 order_status = delivered 的订单金额，为对外统一口径",
     "ads_gmv_monthly.gmv_delivered", "数据团队"),
    ("KPI002", "GMV（含全部订单）", "gmv_all", "交易域", "BRL",
     "含全部状态订单，仅用于对账对比，【不对外发布】",
     "ads_gmv_monthly.gmv_all", "数据团队"),
    ("KPI003", "GMV口径差异", "gmv_gap", "交易域", "BRL",
     "含全部订单口径 减 标准口径，衡量取消订单对营收的影响",
     "ads_gmv_monthly 计算得出", "数据团队"),
    ("KPI004", "订单总量", "total_orders", "交易域", "单",
     "事实表 fct_orders 的去重订单数，无明细的订单不计入",
     "ads_gmv_monthly.total_orders", "数据团队"),
    ("KPI005", "平均客单价", "avg_order_value", "交易域", "BRL",
     "标准口径GMV / 已送达订单数",
     "ads_gmv_monthly.avg_order_value 均值", "数据团队"),
    ("KPI006", "平均取消率", "cancel_rate", "交易域", "%",
     "取消订单数 / 订单总量 × 100%",
     "ads_gmv_monthly.cancel_rate_pct 均值", "数据团队"),
    ("KPI007", "客户总数", "customer_total", "客户域", "人",
     "有已送达订单的客户数（按 customer_id 口径）",
     "dws_customer_rfm", "数据团队"),
    ("KPI008", "复购客户数", "repeat_customer", "客户域", "人",
     "下单次数 > 1 的客户数",
     "dws_customer_rfm.frequency", "数据团队"),
    ("KPI009", "复购率", "repeat_rate", "客户域", "%",
     "复购客户数 / 客户总数 × 100%",
     "dws_customer_rfm 计算得出", "数据团队"),
    ("KPI010", "平均评分", "avg_review_score", "评价域", "分",
     "1-5 分制，5 分最高。取每笔订单最新一条评价（is_latest_review = TRUE）",
     "fct_reviews.review_score", "数据团队"),
    ("KPI011", "好评率", "good_rate", "评价域", "%",
     "评分 >= 4 的评价占比。口径约定：4-5 好评、3 中评、1-2 差评",
     "ads_review_analysis.good_rate_pct", "数据团队"),
    ("KPI012", "差评率", "bad_rate", "评价域", "%",
     "评分 <= 2 的评价占比，为先行预警指标",
     "ads_review_analysis.bad_rate_pct", "数据团队"),
    ("KPI013", "卖家总数", "seller_total", "卖家域", "家",
     "平台注册卖家总数",
     "dws_seller_performance", "数据团队"),
    ("KPI014", "活跃卖家数", "active_seller", "卖家域", "家",
     "统计周期内 GMV > 0 的卖家数",
     "dws_seller_performance.gmv_delivered", "数据团队"),
    ("KPI015", "实收金额", "paid_amount", "支付域", "BRL",
     "支付表 payment_value 合计，用于与应收（GMV）对账。已排除孤儿支付",
     "fct_payments.payment_value", "财务/数据团队"),
    ("KPI016", "覆盖月份数", "month_count", "参照", "月",
     "数据覆盖的自然月数量，反映数据集时间跨度",
     "ads_gmv_monthly", "数据团队"),
]
KPI_PERIOD = "全周期"
KPI_FREQUENCY = "每日"
KPI_DOMAINS = ["交易域", "客户域", "评价域", "卖家域", "支付域", "参照"]

# --- Fixed values: late data -------------------------------------------------
LOOKBACK_DAYS = 7

# --- Fixed values: quality limits --------------------------------------------
ORDER_AMOUNT_RANGE = (Decimal("0"), Decimal("200000"))

EARTH_RADIUS_KM = 6371.0
