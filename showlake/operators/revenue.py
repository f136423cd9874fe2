"""Payments, refunds and lifetime value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY, count_if, micros, money_sum, month_of, pct, ratio
from ..functions.frames import in_range
from ..sources.tables import Tables
from .subscriptions import day_before


def net() -> Column:
    return F.col("amount") - F.col("refund_amount")


def _earned(T: Tables, include_refunded: bool) -> DataFrame:
    """Completed payments.

    A refund changes a payment's status, so by default a refunded payment is in
    neither gross nor net; ``include_refunded`` keeps it in both.
    """
    kept = ["completed", "refunded"] if include_refunded else ["completed"]
    return T["payments"].filter(F.col("payment_status").isin(kept))


def monthly_revenue(T: Tables, months: int, as_of: dt.date, include_refunded: bool = False) -> DataFrame:
    """Gross, refunds and net per month with growth over the previous month present."""
    monthly = (
        in_range(_earned(T, include_refunded), "paid_at", day_before(as_of, months))
        .groupBy(month_of("paid_at").alias("revenue_month"))
        .agg(
            money_sum(F.col("amount")).alias("gross_revenue"),
            money_sum(F.col("refund_amount")).alias("total_refunded"),
            money_sum(net()).alias("net_revenue"),
        )
    )
    # One row per month of the asked range, so a window without key is small.
    before = F.lag("net_revenue").over(Window.orderBy("revenue_month"))
    return (
        monthly.withColumn("_before", before)
        .withColumn(
            "net_revenue_growth_pct",
            pct(F.col("net_revenue") - F.col("_before"), F.col("_before"), scale=2),
        )
        .drop("_before")
        .orderBy(F.desc("revenue_month"))
    )


def plan_revenue(T: Tables, start: dt.date, end: dt.date, include_refunded: bool = False) -> DataFrame:
    """Revenue per plan with its share of the total.

    Payments are summed per subscription first, so a subscription with very
    many payments reaches the join as one row.
    """
    per_subscription = (
        in_range(_earned(T, include_refunded), "paid_at", start, end)
        .groupBy("subscription_id")
        .agg(
            F.count("payment_id").alias("n"),
            F.sum("amount").alias("gross"),
            F.sum("refund_amount").alias("refunded"),
        )
    )
    per_plan = (
        per_subscription.join(T["subscriptions"].select("subscription_id", "plan_id"), "subscription_id")
        .groupBy("plan_id")
        .agg(F.sum("n").alias("n"), F.sum("gross").alias("gross"), F.sum("refunded").alias("refunded"))
        .join(T["subscription_plans"].select("plan_id", "plan_name"), "plan_id")
        .groupBy("plan_name")
        .agg(
            F.sum("n").alias("payment_count"),
            money_sum(F.col("gross")).alias("gross_revenue"),
            money_sum(F.col("refunded")).alias("total_refunded"),
        )
        .withColumn("net_revenue", (F.col("gross_revenue") - F.col("total_refunded")).cast(MONEY))
    )
    # One row per plan.
    total = F.sum("net_revenue").over(Window.partitionBy())
    return per_plan.withColumn("pct_of_total_revenue", pct(F.col("net_revenue"), total, scale=2)).orderBy(
        F.desc("net_revenue"), F.asc("plan_name")
    )


def refund_stats(T: Tables) -> DataFrame:
    """Share of payments with a refund and the days refunds took."""
    took = (micros("refunded_at") - micros("paid_at")).cast("decimal(20,0)")
    day = F.lit(86_400_000_000).cast("decimal(11,0)")  # microseconds
    sums = T["payments"].filter(F.col("payment_status").isin("completed", "refunded")).agg(
        count_if(F.col("refund_amount") > 0).alias("refunded_payments"),
        F.count("*").alias("total_payments"),
        F.sum(took).alias("_micros"),
        F.count(took).cast("decimal(19,0)").alias("_n"),
    )
    return sums.select(
        "refunded_payments",
        "total_payments",
        pct(F.col("refunded_payments"), F.col("total_payments"), 2).alias("refund_rate_pct"),
        ratio(F.col("_micros"), F.col("_n") * day, 1).alias("avg_days_to_refund"),
    )


def failed_payments(T: Tables, start: dt.date, end: dt.date) -> DataFrame:
    """Failed payments to follow up, newest first."""
    plans = (
        T["subscriptions"]
        .select("subscription_id", "plan_id")
        .join(T["subscription_plans"].select("plan_id", "plan_name"), "plan_id")
    )
    return (
        in_range(T["payments"], "created_at", start, end)
        .filter(F.col("payment_status") == "failed")
        .select("payment_id", "user_id", "subscription_id", "amount", "payment_method", "created_at")
        .join(T["users"].select("user_id", "email"), "user_id")
        .join(plans, "subscription_id")
        .select("user_id", "email", "payment_id", "amount", "payment_method", "created_at", "plan_name")
        .orderBy(F.desc("created_at"), F.asc("payment_id"))
    )


def ltv(T: Tables, k: int = 10, include_refunded: bool = False) -> DataFrame:
    """Users by net revenue over their whole time."""
    sums = (
        _earned(T, include_refunded)
        .groupBy("user_id")
        .agg(
            money_sum(net()).alias("lifetime_net_revenue"),
            F.count("payment_id").alias("total_payments"),
            F.min("paid_at").alias("first_payment"),
            F.max("paid_at").alias("last_payment"),
        )
    )
    return (
        sums.join(T["users"].select("user_id", "email"), "user_id")
        .select("user_id", "email", "lifetime_net_revenue", "total_payments", "first_payment", "last_payment")
        .orderBy(F.desc("lifetime_net_revenue"), F.asc("user_id"))
        .limit(k)
    )


def revenue_by_method(T: Tables) -> DataFrame:
    return (
        _earned(T, False)
        .groupBy("payment_method")
        .agg(money_sum(F.col("amount")).alias("total_amount"), F.count("*").alias("transaction_count"))
        .orderBy(F.desc("total_amount"), F.asc("payment_method"))
    )


def failed_payment_totals(T: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Number and value of recent failures; the value of none is NULL."""
    recent = in_range(T["payments"], "created_at", as_of - dt.timedelta(days=days))
    failed = recent.filter(F.col("payment_status") == "failed")
    return failed.agg(
        F.count("*").alias("failed_payment_count"), money_sum(F.col("amount")).alias("failed_payment_value")
    )
