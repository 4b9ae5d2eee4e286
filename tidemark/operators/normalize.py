"""Value normalisation operators (B3-B10, B19): all single projections of native expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ..functions.ids import gid_to_long
from ..functions.timefmt import money_amount, parse_instant
from .nested import _field


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _truthy_struct(c: Column, dtype: StructType) -> Column:
    """A parsed JSON object counts as present only if it is non-NULL and has any non-NULL field.

    Mirrors the truthiness test on dicts (``{}`` is falsy); presence of a key holding ``null`` cannot be
    seen after a struct parse.
    """
    if not dtype.fields:
        return c.isNotNull()
    any_field = None
    for f in dtype.fields:
        cond = c.getField(f.name).isNotNull()
        any_field = cond if any_field is None else (any_field | cond)
    return c.isNotNull() & any_field


# ---------------------------------------------------------------------------------------------
# B7 polymorphic discount value
# ---------------------------------------------------------------------------------------------

def discount_value_fields(value: Column) -> dict[str, Column]:
    """``{percentage}`` -> percentage; ``{amount, currencyCode}`` -> fixed_amount; otherwise no type.

    ``valueAmount`` is NULL for an empty amount string (falsy), as in the source transform.
    """
    is_pct = value.getField("percentage").isNotNull()
    is_amt = value.getField("amount").isNotNull()
    vtype = F.when(is_pct, F.lit("percentage")).when(is_amt, F.lit("fixed_amount"))
    return {
        "valueType": vtype,
        "valuePercentage": F.when(is_pct, value.getField("percentage").cast("double")),
        "valueAmount": F.when(~is_pct & is_amt, money_amount(value.getField("amount"))),
        "valueCurrencyCode": F.when(~is_pct & is_amt, value.getField("currencyCode")),
    }


def normalize_discount_applications(df: DataFrame, field: str = "discountApplications") -> DataFrame:
    """Add ``index`` and the four ``value*`` fields to each element; drop the raw ``value``."""
    f = _field(df.schema, field)
    if f is None:
        return df
    elem_t = f.dataType.elementType

    def per_elem(x: Column, i: Column) -> Column:
        keep = [x.getField(e.name).alias(e.name) for e in elem_t.fields if e.name != "value"]
        vals = discount_value_fields(x.getField("value"))
        return F.struct(*keep, i.cast("bigint").alias("index"), *[v.alias(k) for k, v in vals.items()])

    return df.withColumn(field, F.transform(_c(field), per_elem))


# ---------------------------------------------------------------------------------------------
# B5 / B6 customer contact + spend
# ---------------------------------------------------------------------------------------------

def flatten_customer_contact(df: DataFrame) -> DataFrame:
    """defaultEmailAddress / defaultPhoneNumber / amountSpent -> flat columns; originals dropped."""
    e = _c("defaultEmailAddress")
    out = df.select(
        *[_c(n) for n in df.columns if n not in ("defaultEmailAddress", "defaultPhoneNumber", "amountSpent")],
        e.getField("emailAddress").alias("email"),
        e.getField("marketingState").alias("emailMarketingConsentState"),
        e.getField("marketingOptInLevel").alias("emailMarketingOptInLevel"),
        e.getField("marketingUpdatedAt").alias("emailMarketingConsentUpdatedAt"),
        _c("defaultPhoneNumber").getField("phoneNumber").alias("phone"),
        _c("amountSpent").getField("amount").alias("totalSpent"),
        _c("amountSpent").getField("currencyCode").alias("totalSpentCurrency"),
    )
    return out


def flatten_order_customer_spend(df: DataFrame) -> DataFrame:
    """customer.amountSpent -> customer.totalSpent / customer.totalSpentCurrency (when queried)."""
    cust = _field(df.schema, "customer")
    if cust is None or _field(cust.dataType, "amountSpent") is None:
        return df
    c = _c("customer")
    spent = c.getField("amountSpent")
    return df.withColumn(
        "customer",
        c.withField("totalSpent", spent.getField("amount"))
        .withField("totalSpentCurrency", spent.getField("currencyCode"))
        .dropFields("amountSpent"),
    )


# ---------------------------------------------------------------------------------------------
# B8 collection rule set
# ---------------------------------------------------------------------------------------------

def classify_collections(df: DataFrame) -> DataFrame:
    """ruleSet -> collectionType ('smart' / 'custom'), ruleSetAppliedDisjunctively, indexed rules."""
    f = _field(df.schema, "ruleSet")
    rs = _c("ruleSet")
    present = _truthy_struct(rs, f.dataType)
    rules = F.transform(
        F.coalesce(rs.getField("rules"), F.array().cast(f.dataType["rules"].dataType)),
        lambda r, i: F.struct(
            i.cast("bigint").alias("index"),
            r.getField("column").alias("column"),
            r.getField("relation").alias("relation"),
            r.getField("condition").alias("condition"),
        ),
    )
    return df.select(
        *[_c(n) for n in df.columns if n != "ruleSet"],
        F.when(present, F.lit("smart")).otherwise(F.lit("custom")).alias("collectionType"),
        rs.getField("appliedDisjunctively").alias("ruleSetAppliedDisjunctively"),
        rules.alias("rules"),  # NULL ruleSet -> coalesce gives an empty list
    )


# ---------------------------------------------------------------------------------------------
# B9 / B10 shop profile
# ---------------------------------------------------------------------------------------------

# Source field -> shop column renames.
SHOP_FIELD_RENAMES = {
    "name": "name",
    "email": "email",
    "myshopifyDomain": "myshopify_domain",
    "currencyCode": "currency",
    "ianaTimezone": "iana_timezone",
    "timezoneAbbreviation": "timezone_abbreviation",
    "checkoutApiSupported": "checkout_api_supported",
    "taxesIncluded": "taxes_included",
    "taxShipping": "tax_shipping",
    "createdAt": "created_at",
    "updatedAt": "updated_at",
    "contactEmail": "contact_email",
    "description": "description",
    "customerAccounts": "customer_accounts",
}

# currencyFormats field -> column.
SHOP_FORMAT_COLUMNS = {
    "moneyFormat": "money_format",
    "moneyInEmailsFormat": "money_in_emails_format",
    "moneyWithCurrencyFormat": "money_with_currency_format",
    "moneyWithCurrencyInEmailsFormat": "money_with_currency_in_emails_format",
}

# Features field -> column.
SHOP_FEATURE_COLUMNS = {
    "avalaraAvatax": "has_avalara_avatax",
    "branding": "branding",
    "captcha": "has_captcha",
    "dynamicRemarketing": "has_dynamic_remarketing",
    "eligibleForSubscriptionMigration": "eligible_for_subscription_migration",
    "eligibleForSubscriptions": "eligible_for_subscriptions",
    "giftCards": "has_gift_cards_feature",
    "harmonizedSystemCode": "has_harmonized_system_code",
    "legacySubscriptionGatewayEnabled": "has_legacy_subscription_gateway",
    "liveView": "has_live_view",
    "paypalExpressSubscriptionGatewayStatus": "paypal_express_subscription_status",
    "reports": "has_reports",
    "sellsSubscriptions": "sells_subscriptions",
    "showMetrics": "show_metrics",
    "storefront": "has_storefront_feature",
    "unifiedMarkets": "has_unified_markets",
}

# Bundles / cart-transform sub-fields -> column.
SHOP_BUNDLE_COLUMNS = {
    "eligibleForBundles": "bundles_eligible",
    "ineligibilityReason": "bundles_ineligibility_reason",
    "sellsBundles": "bundles_sells",
}
SHOP_CART_COLUMNS = {
    "expandOperation": "cart_transform_expand",
    "mergeOperation": "cart_transform_merge",
    "updateOperation": "cart_transform_update",
}
SHOP_SOURCE_TAG = "shopify_graphql"
# Plan names, in precedence order (plus, then partner development, else unknown).
PLAN_PLUS, PLAN_PARTNER, PLAN_UNKNOWN = "shopify_plus", "partner_development", "unknown"


def _get(c: Column, dtype: DataType, name: str) -> Column:
    """Field access that yields a typed NULL when the raw schema lacks the field."""
    if isinstance(dtype, StructType) and _field(dtype, name) is not None:
        return c.getField(name)
    return F.lit(None)


def shop_profile(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One shop node per row -> the flat ``shop`` row (renames, plan CASE, formats, features, JSON text)."""
    s = df.schema
    cols: list[Column] = [gid_to_long(_c("id")).alias("id")]
    for src, dst in SHOP_FIELD_RENAMES.items():
        if _field(s, src) is not None:
            cols.append(_c(src).alias(dst))
        else:
            cols.append(F.lit(None).cast("string").alias(dst))

    pd_t = _field(s, "primaryDomain").dataType
    cols.append(F.when(_truthy_struct(_c("primaryDomain"), pd_t), _c("primaryDomain").getField("host")).alias("domain"))

    epc = _c("enabledPresentmentCurrencies")
    cols.append(F.when(F.size(epc) > 0, F.to_json(epc)).alias("enabled_presentment_currencies"))

    plan_t = _field(s, "plan").dataType
    plan = _c("plan")
    has_plan = _truthy_struct(plan, plan_t)
    plus = plan.getField("shopifyPlus")
    partner = plan.getField("partnerDevelopment")
    cols += [
        F.when(has_plan, partner).alias("plan_partner_development"),
        F.when(has_plan, plus).alias("plan_shopify_plus"),
        F.when(has_plan, F.when(plus, F.lit(PLAN_PLUS))
               .when(partner, F.lit(PLAN_PARTNER))
               .otherwise(F.lit(PLAN_UNKNOWN))).alias("plan_name"),
    ]

    fmt_t = _field(s, "currencyFormats").dataType
    fmt = _c("currencyFormats")
    has_fmt = _truthy_struct(fmt, fmt_t)
    cols += [F.when(has_fmt, _get(fmt, fmt_t, k)).alias(v) for k, v in SHOP_FORMAT_COLUMNS.items()]

    feat_t = _field(s, "features").dataType
    feat = _c("features")
    has_feat = _truthy_struct(feat, feat_t)
    cols.append(F.when(has_feat, F.to_json(feat, {"ignoreNullFields": "false"})).alias("features_json"))
    cols += [F.when(has_feat, _get(feat, feat_t, k)).alias(v) for k, v in SHOP_FEATURE_COLUMNS.items()]
    bun_t = feat_t["bundles"].dataType
    bun = feat.getField("bundles")
    has_bun = has_feat & _truthy_struct(bun, bun_t)
    cols += [F.when(has_bun, _get(bun, bun_t, k)).alias(v) for k, v in SHOP_BUNDLE_COLUMNS.items()]
    ops_t = feat_t["cartTransform"].dataType["eligibleOperations"].dataType
    ops = feat.getField("cartTransform").getField("eligibleOperations")
    has_ops = has_feat & _truthy_struct(feat.getField("cartTransform"), feat_t["cartTransform"].dataType) \
        & _truthy_struct(ops, ops_t)
    cols += [F.when(has_ops, _get(ops, ops_t, k)).alias(v) for k, v in SHOP_CART_COLUMNS.items()]

    edges = _c("currencySettings").getField("edges")
    settings = F.transform(edges, lambda e: F.struct(
        e.getField("node").getField("currencyCode").alias("currency_code"),
        e.getField("node").getField("currencyName").alias("currency_name"),
        e.getField("node").getField("enabled").alias("enabled"),
        e.getField("node").getField("rateUpdatedAt").alias("rate_updated_at"),
    ))
    cols.append(F.when(F.size(edges) > 0, F.to_json(settings, {"ignoreNullFields": "false"}))
                .alias("currency_settings"))
    cols.append(F.lit(SHOP_SOURCE_TAG).alias("source"))
    cols.append((loaded_at if loaded_at is not None else F.current_timestamp()).alias("_loaded_at"))
    return df.select(*cols)


# ---------------------------------------------------------------------------------------------
# B4 typed projection
# ---------------------------------------------------------------------------------------------

def typed_value(c: Column, target: str) -> Column:
    """Cast one raw value to a declared logical type without failing the job on bad input."""
    if target == "timestamp":
        return parse_instant(c.cast("string"))
    if target == "double":
        return money_amount(c.cast("string"))
    return c.try_cast(target)


def typed_projection(df: DataFrame, columns: Sequence[tuple[str, str]],
                     not_null: Iterable[str] = ()) -> DataFrame:
    """Select exactly the declared ``(name, type)`` columns in order; absent ones become typed NULLs.

    NOT NULL columns fail the job (``raise_error``, evaluated per row on the executors; no extra pass).
    """
    required = set(not_null)
    present = set(df.columns)
    out = []
    for name, dtype in columns:
        if name in present:
            v = typed_value(_c(name), dtype) if dict(df.dtypes)[name] != dtype else _c(name)
        else:
            v = F.lit(None).cast(dtype)
        if name in required:
            v = F.when(v.isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {name}"))).otherwise(v)
        out.append(v.alias(name))
    return df.select(*out)


def conform(df: DataFrame, declared: StructType, extras: bool = True) -> DataFrame:
    """The declared columns in order, absent ones as typed NULLs, others cast; then, if ``extras``, what else ``df`` has."""
    have, out = dict(df.dtypes), []
    for f in declared.fields:
        kind = f.dataType.simpleString()
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append((_c(f.name) if have[f.name] == kind else typed_value(_c(f.name), kind)).alias(f.name))
    known = set(declared.names)
    more = [_c(c) for c in df.columns if c not in known and (extras or c.startswith("__"))]
    return df.select(*out, *more)
