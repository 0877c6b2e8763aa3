"""Silver tables about customers, suppliers, stores, products and staff."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions import clean, compat, contact
from tallymill.operators.keys import dense_key
from tallymill.operators.versions import open_first_version
from tallymill.operators.windows import best_per_key, lag_fill
from tallymill.plans import vocab as v


def _usable_date(c: Column, key: Column) -> Column:
    """A real date, or a repeatable imputed one."""
    good = c.rlike("^[0-9-]*$") & ~c.isin(clean.BAD_DATE, v.EPOCH_PLACEHOLDER)
    parsed = F.when(good, clean.as_date(c))
    return F.coalesce(parsed, clean.imputed_date(key, v.IMPUTE_FROM, v.IMPUTE_TO))


def crm(raw: DataFrame, as_of: date, phone_compat: bool = True) -> DataFrame:
    """One row per customer: active ones first, then the latest registration."""
    key = F.col("customer_id")
    ranked = ("customer_id", "churn_date", "registration_date")
    others = [F.col(c).asc_nulls_last() for c in raw.columns if c not in ranked]
    unique = best_per_key(
        raw.where(~key.contains("DUP")),
        ["customer_id"],
        [
            F.col("churn_date").isNotNull(),
            F.col("registration_date").desc_nulls_last(),
            F.col("churn_date").asc_nulls_first(),
            *others,
        ],
    )
    now = compat.today(as_of)
    first, last = compat.capitalise(F.col("first_name")), compat.capitalise(F.col("last_name"))
    phone = contact.digits(F.col("phone"))
    email = contact.mail_host(F.col("email"), "example", "gmail")
    named = unique.select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat_ws(" ", F.coalesce(first, F.lit("")), F.coalesce(last, F.lit(""))).alias("full_name"),
        clean.parity_choice("Male", "Female", F.col("first_name"), F.col("last_name")).alias("gender"),
        _usable_date(F.col("birth_date"), key).alias("birth_date"),
        contact.local_phone(phone, phone_compat).alias("phone"),
        email.alias("email"),
        compat.capitalise(F.col("county")).alias("county"),
        compat.capitalise(F.col("town")).alias("town"),
        clean.allow(F.col("customer_segment"), v.SEGMENTS, "Standard").alias("customer_segment"),
        clean.allow(F.col("acquisition_channel"), v.CHANNELS, "Other").alias("acquisition_channel"),
        _usable_date(F.col("registration_date"), key).alias("registration_date"),
        F.when(F.col("churn_date").isNotNull(), _usable_date(F.col("churn_date"), key)).alias("churn_date"),
        clean.allow(F.col("loyalty_tier"), v.SEGMENTS, "Bronze").alias("loyalty_tier"),
        F.coalesce("communication_preferences", F.lit("Email")).alias("communication_preferences"),
        F.col("feedback_score").try_cast("decimal(5,2)").alias("feedback_score"),
        F.left(phone, F.lit(3)).alias("phone_prefix"),
        contact.phone_valid(phone).alias("is_phone_valid"),
        contact.email_domain(email).alias("email_domain"),
        contact.email_valid(email).alias("is_email_valid"),
    )
    registered, left = F.col("registration_date"), F.coalesce("churn_date", now)
    age, tenure = compat.years_between_starts(F.col("birth_date"), now), compat.days_between(registered, left)
    return named.withColumns(
        {
            "age": age,
            "age_band": clean.band(age, v.AGE_BANDS),
            "is_churned": F.coalesce(F.col("churn_date") <= now, F.lit(False)),
            "tenure_days": tenure,
            "tenure_months": compat.months_between_starts(registered, left),
            "tenure_band": clean.band(tenure, v.TENURE_BANDS),
            "registration_year": F.year(registered),
            "registration_month": F.month(registered),
            "registration_quarter": F.quarter(registered),
        }
    )


def suppliers(raw: DataFrame, as_of: date) -> DataFrame:
    name = F.col("supplier_name")
    return raw.where(clean.not_dup(F.col("supplier_id"))).select(
        "supplier_id",
        clean.fix_date(F.col("valid_from"), v.NEW_YEAR_2016).alias("valid_from"),
        clean.open_end(clean.fix_date(F.col("valid_to"), v.NEW_YEAR_2016), as_of).alias("valid_to"),
        "supplier_name",
        F.coalesce("contact_person", name).alias("contact_person"),
        F.replace(F.col("phone"), F.lit("+254"), F.lit("")).alias("phone"),
        F.replace(F.col("email"), F.lit("contact"), F.lower(F.left(name, F.lit(2)))).alias("email"),
        "payment_terms",
        clean.as_int(F.col("lead_time_days")).alias("lead_time_days"),
        "category",
        "tax_id",
    )


def stores(raw: DataFrame, as_of: date, brand: str = "", brand_code: str = "") -> DataFrame:
    """Store versions. ``brand`` is the chain name that store names begin with; it
    is swapped for ``brand_code``, and the town is what follows the code."""
    kept = raw.where(clean.not_dup(F.col("store_id")))
    name = F.replace(F.col("store_name"), F.lit(brand), F.lit(brand_code)) if brand else F.col("store_name")

    def fixed(c: str) -> Column:
        return clean.fix_date(F.col(c), v.CHRISTMAS_2023)

    typed = kept.select(
        "store_id",
        clean.open_end(fixed("valid_from"), as_of).alias("valid_from"),
        clean.open_end(fixed("valid_to"), as_of).alias("valid_to"),
        name.alias("store_name"),
        "county",
        F.substr(name, F.lit(len(brand_code) + 1)).alias("town"),
        "format",
        clean.as_int(F.col("size_sqm")).alias("size_sqm"),
        fixed("opening_date").alias("opening_date"),
        clean.open_end(fixed("closing_date"), as_of).alias("closing_date"),
        clean.yes_no(F.col("is_active") == "TRUE").alias("is_active"),
    )
    order = [F.col("store_id"), F.col("valid_from"), F.col("valid_to"), F.col("store_name")]
    keyed = dense_key(typed, order, "store_key")
    # the fill looks at the store row before
    return lag_fill(keyed, "format", [F.col("store_key")], [F.floor(F.col("store_key") / 100_000)])


def products(raw: DataFrame, as_of: date) -> DataFrame:
    """Product versions; a product's first one is valid from the start of the books."""

    def fixed(c: str) -> Column:
        return clean.open_end(clean.fix_date(F.col(c), v.CHRISTMAS_2023), as_of)

    margin = clean.as_float(F.col("margin_percentage"))
    typed = raw.select(
        clean.strip_dup(F.col("product_id")).alias("product_id"),
        "product_name",
        "brand",
        "category",
        "subcategory",
        clean.strip_dup(F.col("supplier_id")).alias("supplier_id"),
        clean.as_float(F.col("unit_cost_kes")).alias("unit_cost_kes"),
        clean.as_float(F.col("retail_price_kes")).alias("retail_price_kes"),
        margin.alias("margin_percentage"),
        clean.band(margin, v.MARGIN_BANDS).alias("margin_band"),
        fixed("introduction_date").alias("introduction_date"),
        fixed("valid_from").alias("valid_from"),
        fixed("valid_to").alias("valid_to"),
        fixed("discontinued_date").alias("discontinued_date"),
        "is_active",
        clean.yes_no(F.col("valid_to").isNull()).alias("is_current_version"),
        F.col("valid_from").alias("_from"),
    )
    order = [F.col("_from"), *[F.col(c) for c in typed.columns if c != "_from"]]
    return open_first_version(
        typed, "product_id", order, [F.left(F.col("_from"), F.lit(4))], ["introduction_date", "valid_from"]
    ).drop("_from")


def feedback(raw: DataFrame, as_of: date) -> DataFrame:
    day, rating = F.col("feedback_date"), F.col("rating")
    typed = raw.where(F.col("feedback_id").isNotNull()).select(
        F.col("feedback_id").alias("feedback_key"),
        "feedback_id",
        clean.strip_dup(F.col("customer_id")).alias("customer_id"),
        clean.as_date(F.col("date")).alias("feedback_date"),
        clean.as_int(F.col("rating")).alias("rating"),
        F.trim("category").alias("category"),
    )
    late = day > compat.today(as_of)
    return typed.withColumns(
        {
            **compat.month_parts(day, "feedback"),
            "rating_label": clean.band(rating, v.RATING_LABELS),
            "sentiment": clean.band(rating, v.SENTIMENTS),
            "is_future_dated": F.coalesce(late, F.lit(False)).cast("int"),
            "quality_flag": clean.first_failing(
                [
                    ("Invalid rating", ~rating.between(1, 5)),
                    ("Missing category", ~clean.present(F.col("category"))),
                    ("Future date", late),
                    ("Suspicious old date", day < F.lit(v.OLDEST_PLAUSIBLE).cast("date")),
                ]
            ),
        }
    )


def service_interactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "interaction_id",
        clean.strip_dup(F.col("customer_id")).alias("customer_id"),
        clean.fix_date(F.col("interaction_date"), v.CHRISTMAS_2023).alias("interaction_date"),
        "channel",
        "issue_type",
        clean.as_int(F.col("resolution_time_minutes")).alias("resolution_time_minutes"),
        clean.as_float(F.col("satisfaction_score")).alias("satisfaction_score"),
    )


def loyalty_transactions(raw: DataFrame, as_of: date) -> DataFrame:
    key, customer = F.col("transaction_id"), F.col("customer_id")
    typed = raw.where(key.isNotNull() & customer.isNotNull()).select(
        key.alias("loyalty_transaction_key"),
        "transaction_id",
        clean.strip_dup(customer).alias("customer_id"),
        "order_id",
        clean.fix_date(F.col("date"), v.CHRISTMAS_2023).alias("transaction_date"),
        F.lower(F.trim("transaction_type")).alias("_type"),
        clean.as_int(F.col("points_earned")).alias("points_earned_raw"),
        F.abs(clean.as_int(F.col("points_redeemed"))).alias("points_redeemed"),
        clean.as_int(F.col("points_balance")).alias("points_balance"),
    )
    kind, day = F.col("_type"), F.col("transaction_date")
    earned, spent, balance = F.col("points_earned_raw"), F.col("points_redeemed"), F.col("points_balance")
    order = F.col("order_id")
    source = F.when(~clean.present(order), F.lit("No linked order"))
    for prefix, label in v.ORDER_SOURCES.items():
        source = source.when(order.startswith(prefix), F.lit(label))
    other_kind = (
        F.when(earned < 0, "Adjustment (Negative)")
        .when((spent > 0) & (kind == "earn"), "Mixed - Review")
        .otherwise("Other")
    )
    named = typed.withColumns(
        {
            "transaction_type": clean.recode(kind, v.EARN_WORDS, other_kind),
            "order_source_type": source.otherwise("Unknown source"),
            "points_activity_tier": F.coalesce(
                clean.band(earned, v.EARN_TIERS),
                F.when(spent >= v.BIG_REDEMPTION, F.lit(v.BIG_REDEMPTION_TIER)),
                F.lit(v.NO_ACTIVITY),
            ),
            "customer_point_status": F.coalesce(
                clean.band(balance, v.POINT_STATUS),
                F.when((balance == 0) & (kind == "redeem"), F.lit("Points exhausted")),
                F.when(balance < 0, F.lit("Negative balance - Data error")),
                F.lit("No points"),
            ),
            **compat.month_parts(day, "transaction"),
            "quality_flag": clean.first_failing(
                [
                    ("Future date - Invalid", day > compat.today(as_of)),
                    ("Negative earn - Possible adjustment", (earned < 0) & (kind == "earn") & (spent == 0)),
                    ("Negative balance - Data error", balance < 0),
                    ("Invalid transaction type", ~kind.isin("earn", "redeem")),
                    ("Invalid redemption amount", (kind == "redeem") & (spent <= 0)),
                    ("No points movement", (kind == "earn") & (earned <= 0) & (spent == 0)),
                ]
            ),
        }
    )
    change = F.when(F.col("transaction_type") == "Redeem", -spent).otherwise(earned)
    return named.withColumn("points_change", change).drop("_type")


def competitors(raw: DataFrame) -> DataFrame:
    return raw.select("competitor_id", "competitor_name")


def competitor_quarterly(raw: DataFrame) -> DataFrame:
    """Revenue and market share share the last column."""
    packed = F.col("market_share_pct")
    typed = raw.select(
        "competitor_id",
        "quarter",
        clean.as_long(clean.packed(packed, 0, 2)).alias("revenue_kes"),
        clean.as_float(clean.packed(packed, 1, 2)).alias("market_share_pct"),
    )
    order = [F.col("quarter"), F.col("competitor_id"), F.col("revenue_kes"), F.col("market_share_pct")]
    return dense_key(typed, order, "comp_qtr_key")


def competitor_stores(raw: DataFrame) -> DataFrame:
    return raw.select("competitor_store_id", "competitor_id", "location", "county", "size_category")


def gis_counties(raw: DataFrame) -> DataFrame:
    return raw.select(
        "county",
        clean.as_int(F.col("population")).alias("population"),
        clean.as_int(F.col("avg_income_kes")).alias("avg_income_kes"),
        clean.as_float(F.col("latitude")).alias("latitude"),
        clean.as_float(F.col("longitude")).alias("longitude"),
    )


def gis_locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        "location_id",
        "county",
        "location_name",
        "location_type",
        *[clean.as_float(F.col(c)).alias(c) for c in ("latitude", "longitude", "accessibility_score")],
    )


def hr(raw: DataFrame, as_of: date) -> DataFrame:
    """Staff versions; the typed columns and what follows from them."""
    now = compat.today(as_of)
    typed = raw.where(clean.not_dup(F.col("employee_id"))).select(
        "employee_id",
        clean.open_end(clean.fix_date(F.col("valid_from"), v.CHRISTMAS_2023), as_of).alias("valid_from"),
        clean.open_end(clean.fix_date(F.col("valid_to"), v.CHRISTMAS_2023), as_of).alias("valid_to"),
        compat.capitalise(F.col("first_name")).alias("first_name"),
        compat.capitalise(F.col("last_name")).alias("last_name"),
        "gender",
        clean.fix_date(F.col("birth_date"), v.CHRISTMAS_2023).alias("birth_date"),
        clean.fix_date(F.col("hire_date"), v.CHRISTMAS_2023).alias("hire_date"),
        "department",
        "job_title",
        clean.as_int(F.col("salary")).alias("salary"),
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        "shift_pattern",
        F.when(F.col("valid_to").isNull(), "Active").otherwise("Left").alias("employment_status"),
    )
    age, hired = compat.years_between_starts(F.col("birth_date"), now), F.col("hire_date")
    tenure = compat.days_between(hired, now)
    return typed.withColumns(
        {
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "age": age,
            "age_band": clean.band(age, v.AGE_BANDS),
            "tenure_days": tenure,
            "tenure_months": compat.months_between_starts(hired, now),
            "tenure_band": clean.band(tenure, v.TENURE_BANDS),
            "hire_year": F.year(hired),
            "hire_month": F.month(hired),
            "hire_quarter": F.quarter(hired),
        }
    )


def employee_shifts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "shift_id",
        "employee_id",
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        clean.fix_date(F.col("shift_date"), v.CHRISTMAS_2023).alias("shift_date"),
        "shift_type",
        "start_time",
        "end_time",
        clean.as_float(F.col("hours_worked")).alias("hours_worked"),
        clean.as_int(F.col("overtime_hours")).alias("overtime_hours"),
    )


def time_tracking(raw: DataFrame) -> DataFrame:
    stamp = F.replace(F.col("timestamp"), F.lit("T"), F.lit(" "))
    return raw.select(
        "event_id",
        "employee_id",
        clean.strip_dup(F.col("store_id")).alias("store_id"),
        stamp.try_cast("timestamp_ntz").alias("event_time"),
        clean.as_date(F.left(stamp, F.lit(10))).alias("event_date"),
        "event_type",
    )
