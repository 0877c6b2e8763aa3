"""Labels, edges and word lists that decide the warehouse's results."""

from __future__ import annotations

from tallymill.functions.clean import Bands

# Sentinel-date replacements
CHRISTMAS_2023 = "2023-12-25"
OCTOBER_2022 = "2022-10-15"
NEW_YEAR_2016 = "2016-01-01"
OLDEST_PLAUSIBLE = "2015-01-01"
IMPUTE_FROM, IMPUTE_TO = "1978-01-01", "2010-12-31"
EPOCH_PLACEHOLDER = "1900-01-01"

# sales
WALK_IN = "WALK-IN-CUSTOMER"
UNKNOWN = "Unknown"
CAMPAIGN_PREFIX = "CMP"
DISCOUNT_TIERS = Bands(
    "<",
    (
        (0, "No Discount", "="),
        (0.05, "Small Discount (<5%)"),
        (0.10, "Standard Discount (5-10%)"),
        (0.20, "Large Discount (10-20%)"),
    ),
    "Heavy Discount (>20%)",
)
LINE_VALUE_TIERS = Bands(
    ">=",
    (
        (500000, "Premium Line (500K+ KES)"),
        (100000, "High Value Line (100K-500K)"),
        (50000, "Medium Value Line (50K-100K)"),
        (10000, "Low Value Line (10K-50K)"),
    ),
    "Small Item (<10K KES)",
)
TRANSACTION_TIERS = Bands(
    ">=",
    (
        (1000000, "High Value (1M+ KES)"),
        (500000, "Medium-High (500K-1M KES)"),
        (100000, "Medium (100K-500K KES)"),
        (50000, "Low-Medium (50K-100K KES)"),
    ),
    "Low Value (<50K KES)",
)
DAY_TIMES = Bands(
    "between",
    (
        ((6, 11), "Morning (6AM-11AM)"),
        ((12, 16), "Afternoon (12PM-4PM)"),
        ((17, 20), "Evening (5PM-8PM)"),
    ),
    "Late Night (9PM-5AM)",
)
PAYMENT_METHODS = {
    "Mixed (Cash + Card)": ["Mixed"],
    "Card": ["Card"],
    "Cash": ["Cash"],
    "Mobile Money": ["Mobile Money"],
    "Cheque": ["Cheque"],
}
PAYMENT_WORDS = ["Card", "Cash", "Mobile Money", "Cheque", "Mixed"]

# customers
SEGMENTS = ["Platinum", "Gold", "Silver", "Bronze"]
CHANNELS = ["Online", "Store", "Referral", "Social Media", "Email"]
AGE_BANDS = Bands(
    "between",
    (
        (18, "Under 18", "<"),
        ((18, 24), "18-24"),
        ((25, 34), "25-34"),
        ((35, 49), "35-49"),
        ((50, 64), "50-64"),
    ),
    "65+",
)
TENURE_BANDS = Bands(
    "<",
    (
        (30, "New (<30 days)"),
        (90, "Recent (30-90 days)"),
        (180, "Regular (3-6 months)"),
        (365, "Established (6-12 months)"),
    ),
    "Loyal (>1 year)",
)
GENERATIONS = Bands(
    "between",
    (
        ((1997, 2012), "Gen Z"),
        ((1981, 1996), "Millennial"),
        ((1965, 1980), "Gen X"),
        ((1945, 1964), "Boomer"),
    ),
    "Other/Unknown",
)
YOUNGEST_GENERATION, YOUNGEST_FROM = "Gen Alpha", 2013
SENTIMENTS = Bands(
    ">=", ((4, "Positive"), (3, "Neutral", "="), (2, "Negative", "<=")), "Unknown"
)
RATING_LABELS = Bands(
    "=",
    ((5, "Excellent"), (4, "Good"), (3, "Average"), (2, "Poor"), (1, "Very Poor")),
    "Invalid",
)

# loyalty
EARN_WORDS = {
    "Earn": ["earn", "earning", "earned", "credit"],
    "Redeem": ["redeem", "redemption", "redeemed", "debit"],
}
EARN_TIERS = Bands(
    ">=",
    (
        (1000, "High earner (1000+ points)"),
        (500, "Medium earner (500-999 points)"),
        (100, "Low earner (100-499 points)"),
        (0, "Small earner (1-99 points)", ">"),
    ),
    None,
)
BIG_REDEMPTION, BIG_REDEMPTION_TIER = 1000, "High redemption (1000+ points)"
NO_ACTIVITY = "No significant activity"
POINT_STATUS = Bands(
    ">=",
    (
        (5000, "VIP - High points"),
        (1000, "Active - Good points"),
        (100, "Low points"),
        (0, "Minimal points", ">"),
    ),
    None,
)
ORDER_SOURCES = {"ORD-": "E-commerce order", "TXN-": "POS transaction"}

# ledger
ACCOUNT_CLASSES = {
    "Assets": ["1"],
    "Liabilities": ["2"],
    "Equity": ["3"],
    "Revenue": ["4"],
    "Cost of Goods Sold": ["5"],
    "Operating Expenses": ["6"],
    "Other Income/Expense": ["7"],
}

# stock
#: Texts kept with quarantined stock movements.
MOVEMENT_TEXTS = ("raw_movement_date", "raw_quantity", "raw_unit_cost_kes")
OUTBOUND = ["SALE", "TRANSFER_OUT", "ADJUSTMENT_OUT"]
INBOUND = ["RECEIPT", "TRANSFER_IN", "ADJUSTMENT_IN", "RETURN"]
STOCK_LEVELS = Bands(
    "between",
    (
        (0, "Negative stock alert", "<"),
        (0, "Zero stock", "="),
        ((1, 50), "Low stock"),
        ((51, 200), "Adequate stock"),
        (200, "Excess stock", ">"),
    ),
    "Unknown",
)
DEMAND = Bands(
    "between",
    (
        (100, "High demand - Reorder now", ">"),
        ((30, 100), "Normal demand"),
        ((1, 29), "Low demand - Reduce stock"),
        (0, "No recent activity", "="),
    ),
    "Insufficient data",
)
CAUTION_FACTOR = 1.2

# Promotions and procurement
DISCOUNT_KINDS = {
    "Fixed Amount (KES)": ["fixed", "amount"],
    "Percentage (%)": ["percentage", "percent", "%"],
}
CAMPAIGN_LENGTHS = Bands(
    "<=",
    (
        (7, "Flash Sale (≤7 days)"),
        (30, "Short Campaign (8-30 days)"),
        (90, "Standard Campaign (31-90 days)"),
    ),
    "Long Campaign (>90 days)",
)
PO_STATUS = {"Completed": ["Closed"], "In Progress": ["Open"], "Cancelled": ["Cancelled"]}
NOTE_KINDS = {"Damaged": "Damaged Goods", "Wrong": "Wrong Items", "OK": "Good Condition"}
PROBLEM_NOTES = ["Damaged in transit", "Wrong items", "Shortage"]

# Products and economy
MARGIN_BANDS = Bands("<", ((20, "low"), ((20, 40), "medium", "between"), (40, "high", ">")), None)

# Characters of an id that, with its day, name a chunk of one key's rows in running windows
CHUNK_PREFIX = 9
