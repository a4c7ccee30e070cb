"""Subscription billing: posted items by month, product revenue after discounts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.periods import period_start
from forecourt.operators.aggregates import conditional_sums
from forecourt.operators.filters import posted_billing
from forecourt.operators.joins import SALTS, left_lookup, tagged_totals
from forecourt.operators.spread import spread_join

# Discount column -> charge name.
DISCOUNTS = {
    "discount": "Discount",
    "dsp_discount": "DSP Discount",
    "saas_discount": "SaaS Discount",
    "held_billing_discount": "Held Billing Discount",
}

# Amounts have nine decimals, as the payload rule ``numeric``.
AMOUNT = "decimal(28,9)"


def posted_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.where(posted_billing(None, "status", "reversed")).select(F.col("id").alias("invoiceid"))


def billings_monthly(items: DataFrame, invoices: DataFrame, subscriptions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Posted, non-zero items with their month and account number."""
    charged = items.where(F.col("chargeamount") != 0)
    posted = spread_join(charged, posted_invoices(invoices), ["invoiceid"], salts=SALTS, null_safe=False)
    subs = subscriptions.select("id", F.col("id").alias("_sub"), F.col("creatoraccountid").alias("_account"))
    rows = left_lookup(posted, subs, "subscriptionid", "id")
    rows = left_lookup(rows, accounts.select("id", "accountnumber"), "_account", "id")
    return rows.select(
        F.col("accountnumber").alias("master_business_id"),
        F.col("_sub").alias("subscriptionid"),
        period_start(F.col("servicestartdate"), "month").alias("date"),
        "accountingcode",
        "chargename",
        "chargeamount",
        "quantity",
    )


def saas_revenue_monthly(items: DataFrame, invoices: DataFrame, subscriptions: DataFrame, products: Mapping[str, str]) -> DataFrame:
    """Per account, subscription and month: price and four discounts of each product.

    ``products`` maps output prefix -> charge name. The figures equal those of
    joining each item to its discounts one by one, where several discounts of
    a kind repeat the row: an item with n_k discounts of kind k stands for the
    product of the max(n_k, 1), and a discount of kind k repeats by all other
    kinds. One aggregate of the discounts replaces the four self joins.
    """
    totals = tagged_totals(items, "appliedtoinvoiceitemid", "chargename", "chargeamount", DISCOUNTS)
    base = items.where(F.col("chargename").isin(*products.values()))
    base = spread_join(base, posted_invoices(invoices), ["invoiceid"], salts=SALTS, null_safe=False)
    subs = subscriptions.select("id", F.col("creatoraccountid").alias("accountid"))
    rows = left_lookup(base, subs, "subscriptionid", "id")
    rows = left_lookup(rows, totals, "id", "_to", salts=1)
    copies = {k: F.greatest(F.coalesce(F.col(f"{k}_n"), F.lit(0)), F.lit(1)).cast("decimal(38,0)") for k in DISCOUNTS}

    def times(value, skip=None):
        # Whole units and decimals are multiplied apart, so that no digit is lost however many copies there are; what
        # doesn't fit is an error, not NULL.
        n = reduce(F.try_multiply, [c for k, c in copies.items() if k != skip]).try_cast("decimal(28,0)")
        amount = value.try_cast(AMOUNT)
        units = F.when(amount < 0, F.ceil(amount)).otherwise(F.floor(amount)).cast("decimal(19,0)")
        whole = F.try_multiply(units, n).try_cast("decimal(37,9)")
        rest = ((amount - units).cast("decimal(9,9)") * n).try_cast("decimal(37,9)")
        exact = whole + rest
        lost = value.isNotNull() & (exact.isNull() | (value != amount))
        return F.when(lost, F.raise_error(F.concat(F.lit("amount out of range: "), value))).otherwise(exact)

    money = {"_price": times(F.col("chargeamount"))}
    for k in DISCOUNTS:
        money[f"_{k}"] = times(F.coalesce(F.col(k), F.lit(0)), skip=k)
    rows = rows.select("accountid", "subscriptionid", period_start(F.col("servicestartdate"), "month").alias("servicestartdate"), "chargename", *[c.alias(n) for n, c in money.items()])
    return conditional_sums(rows, ["accountid", "subscriptionid", "servicestartdate"], "chargename", products, {n[1:]: n for n in money})
