"""Subscription, churn and account-base reports.

Subscriptions are counted per plan id before plans are joined: there are only a
few plans, so joining first would put most rows under one key.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY, at, between, count_if, month_of, pct, ratio
from ..functions.frames import in_range
from ..sources.tables import Tables


def is_cancelled() -> Column:
    return F.col("status") == "cancelled"


def is_active() -> Column:
    return F.col("status") == "active"


def day_before(as_of: dt.date, months: int) -> dt.date:
    """The same day ``months`` earlier (last day of a shorter month)."""
    years, month = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    return dt.date(years, month + 1, min(as_of.day, calendar.monthrange(years, month + 1)[1]))


def months_before(as_of: dt.date, months: int) -> Column:
    """Midnight of the same day ``months`` earlier."""
    return at(day_before(as_of, months))


def cancellations_mom(T: Tables, months: int, as_of: dt.date) -> DataFrame:
    """Cancellations per month against the previous month that had any."""
    monthly = (
        T["subscriptions"]
        .filter(is_cancelled() & (F.col("cancelled_at") >= months_before(as_of, months)))
        .groupBy(month_of("cancelled_at").alias("cancel_month"))
        .agg(F.count("*").alias("cancellations"))
    )
    # One row per month of the asked range, so a window without key is small.
    previous = F.lag("cancellations").over(Window.orderBy("cancel_month"))
    return (
        monthly.withColumn("prev_month_cancellations", previous)
        .withColumn(
            "pct_change_mom",
            pct(F.col("cancellations") - F.col("prev_month_cancellations"), F.col("prev_month_cancellations")),
        )
        .orderBy(F.desc("cancel_month"))
    )


def cancellation_reasons(T: Tables) -> DataFrame:
    """Reasons with their share of all cancellations."""
    cancelled = T["subscriptions"].filter(is_cancelled())
    total = cancelled.agg(F.count("*")).scalar()
    return (
        cancelled.groupBy("cancellation_reason")
        .agg(F.count("*").alias("occurrences"))
        .select(
            F.coalesce("cancellation_reason", F.lit("Not specified")).alias("reason"),
            "occurrences",
            pct(F.col("occurrences"), total).alias("pct_of_total_cancellations"),
        )
        .orderBy(F.desc("occurrences"), F.asc("reason"))
    )


def _churn_columns(size: str, cancelled: str) -> list[Column]:
    return [
        F.col("n").alias(size),
        F.col("gone").alias(cancelled),
        pct(F.col("gone"), F.col("n"), 2).alias("churn_rate_pct"),
    ]


def cohort_churn(T: Tables, month: dt.date | None = None) -> DataFrame:
    """Share of the subscriptions started in a month (every month if None) that were cancelled."""
    cohort = month_of("start_date").alias("cohort_month")
    rows = T["subscriptions"]
    if month is not None:
        first = month.replace(day=1)
        rows = rows.filter((F.col("start_date") >= F.lit(first)) & (F.col("start_date") < F.add_months(F.lit(first), 1)))
    return (
        rows.groupBy(cohort)
        .agg(F.count("*").alias("n"), count_if(is_cancelled()).alias("gone"))
        .select("cohort_month", *_churn_columns("cohort_size", "cancelled_count"))
        .orderBy("cohort_month")
    )


def plan_churn(T: Tables, start: dt.date, end: dt.date) -> DataFrame:
    """Churn per plan of the subscriptions started in a date range."""
    counts = (
        T["subscriptions"]
        .filter(F.col("start_date").between(F.lit(start), F.lit(end)))
        .groupBy("plan_id")
        .agg(F.count("*").alias("n"), count_if(is_cancelled()).alias("gone"))
    )
    return (
        _name_plans(T, counts)
        .groupBy("plan_name")
        .agg(F.sum("n").alias("n"), F.sum("gone").alias("gone"))
        .select("plan_name", *_churn_columns("total_subscriptions", "cancelled"))
        .orderBy(F.desc("churn_rate_pct"), F.asc("plan_name"))
    )


def _name_plans(T: Tables, rows: DataFrame) -> DataFrame:
    return rows.join(T["subscription_plans"].select("plan_id", "plan_name"), "plan_id")


def at_risk(T: Tables) -> DataFrame:
    """Active subscriptions that will not renew, soonest billing first."""
    return (
        _name_plans(T, T["subscriptions"].filter(is_active() & ~F.col("auto_renew")))
        .join(T["users"].select("user_id", "email"), "user_id")
        .select("user_id", "email", "plan_name", "next_billing_date", "end_date", "subscription_id")
        .orderBy(F.asc_nulls_last("next_billing_date"), F.asc("subscription_id"))
        .drop("subscription_id")
    )


def _active_by_plan_and_cycle(T: Tables) -> DataFrame:
    counts = (
        T["subscriptions"].filter(is_active()).groupBy("plan_id", "billing_cycle").agg(F.count("*").alias("n"))
    )
    plans = T["subscription_plans"].select("plan_id", "plan_name", "price_monthly", "price_yearly")
    return counts.join(plans, "plan_id")


def _times(price: str) -> Column:
    return (F.col("n") * F.col(price)).cast(MONEY)


def mrr_by_plan(T: Tables) -> DataFrame:
    """Recurring revenue of the monthly billed, per plan."""
    return (
        _active_by_plan_and_cycle(T)
        .filter("billing_cycle = 'monthly'")
        .groupBy("plan_name", "price_monthly")
        .agg(F.sum("n").alias("n"))
        .select("plan_name", F.col("n").alias("active_subscribers"), _times("price_monthly").alias("mrr"))
        .orderBy(F.desc("mrr"), F.asc("plan_name"))
    )


def total_mrr(T: Tables) -> DataFrame:
    monthly = _active_by_plan_and_cycle(T).filter("billing_cycle = 'monthly'")
    return monthly.agg(F.sum(_times("price_monthly")).cast(MONEY).alias("total_mrr"))


def arr_by_plan(T: Tables) -> DataFrame:
    """Yearly revenue per plan; yearly billed at the yearly price, others twelve months."""
    yearly = F.when(F.col("billing_cycle") == "yearly", _times("price_yearly")).otherwise(
        (F.col("n") * F.col("price_monthly") * 12).cast(MONEY)
    )
    return (
        _active_by_plan_and_cycle(T)
        .groupBy("plan_name")
        .agg(F.sum(yearly).cast(MONEY).alias("arr"))
        .orderBy(F.desc_nulls_first("arr"), F.asc("plan_name"))
    )


def churned_users(T: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Users with a cancellation in the last ``days``."""
    since = at(as_of - dt.timedelta(days=days))
    lost = T["subscriptions"].filter(is_cancelled() & (F.col("cancelled_at") >= since))
    return lost.agg(F.countDistinct("user_id").alias("churned_users"))


def churn_rate(T: Tables, as_of: dt.date, days: int = 30) -> DataFrame:
    """Recently churned users against users subscribed for at least ``days``."""
    since = as_of - dt.timedelta(days=days)
    lost = is_cancelled() & (F.col("cancelled_at") >= at(since))
    old = F.col("start_date") <= F.lit(since)
    per_user = (
        T["subscriptions"]
        .filter(lost | old)
        .groupBy("user_id")
        .agg(F.max(F.when(lost, 1)).alias("lost"), F.max(F.when(old, 1)).alias("old"))
    )
    return per_user.agg(F.count("lost").alias("churned"), F.count("old").alias("base")).select(
        "churned", "base", pct(F.col("churned"), F.col("base"), 2).alias("churn_rate_pct")
    )


def plan_distribution(T: Tables) -> DataFrame:
    """Active subscribers per plan with their share."""
    active = T["subscriptions"].filter(is_active()).groupBy("plan_id").agg(F.count("*").alias("n"))
    named = _name_plans(T, active).groupBy("plan_name").agg(F.sum("n").alias("active_subscribers"))
    # One row per plan.
    total = F.sum("active_subscribers").over(Window.partitionBy())
    return named.withColumn("pct_of_active_base", pct(F.col("active_subscribers"), total)).orderBy(
        F.desc("active_subscribers"), F.asc("plan_name")
    )


def status_breakdown(T: Tables) -> DataFrame:
    return _counted(T["subscriptions"], "status", "subscription_count")


def at_profile_limit(T: Tables) -> DataFrame:
    """Subscribed users with as many profiles as their plan allows."""
    counts = T["profiles"].groupBy("user_id").agg(F.count("profile_id").alias("profile_count"))
    plans = T["subscription_plans"].select("plan_id", "plan_name", "max_profiles")
    return (
        T["subscriptions"]
        .filter(is_active())
        .select("user_id", "plan_id")
        .join(plans, "plan_id")
        .join(counts, "user_id")
        .filter(F.col("profile_count") >= F.col("max_profiles"))
        .select("user_id", "plan_name", "profile_count", "max_profiles")
    )


def signups_monthly(T: Tables, as_of: dt.date, months: int = 12) -> DataFrame:
    return (
        T["users"]
        .filter(F.col("created_at") >= months_before(as_of, months))
        .groupBy(month_of("created_at").alias("signup_month"))
        .agg(F.count("*").alias("new_users"))
        .orderBy("signup_month")
    )


def optout_rate(T: Tables) -> DataFrame:
    """Active subscriptions that switched renewal off."""
    sums = (
        T["subscriptions"]
        .filter(is_active())
        .agg(count_if(~F.col("auto_renew")).alias("opted_out"), F.count("*").alias("total_active"))
    )
    return sums.withColumn("opt_out_rate_pct", pct(F.col("opted_out"), F.col("total_active")))


def _counted(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc(column))


def device_types(T: Tables) -> DataFrame:
    return _counted(T["user_devices"], "device_type", "device_count")


def os_types(T: Tables) -> DataFrame:
    return _counted(T["user_devices"].filter(F.col("os_type").isNotNull()), "os_type", "device_count")


def _total(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def download_adoption(T: Tables) -> DataFrame:
    """Profiles that ever downloaded, of all profiles."""
    sums = T["downloads"].agg(F.countDistinct("profile_id").alias("profiles_with_downloads"))
    return sums.withColumn("total_profiles", _total(T["profiles"])).withColumn(
        "adoption_pct", pct(F.col("profiles_with_downloads"), F.col("total_profiles"))
    )


def profiles_per_user(T: Tables) -> DataFrame:
    profiles = T["profiles"].agg(F.count("*").alias("n"))
    return profiles.select(ratio(F.col("n"), _total(T["users"]), 2).alias("avg_profiles_per_user"))


def devices_per_user(T: Tables) -> DataFrame:
    devices = T["user_devices"].agg(F.count("*").alias("n"))
    return devices.select(ratio(F.col("n"), _total(T["users"]), 2).alias("avg_devices_per_user"))


def exec_dashboard(T: Tables, start: dt.date, end: dt.date) -> DataFrame:
    """One row of headline figures for a date range.

    As written by the model, a cancellation counts by its date whatever the
    subscription's status is now, and only payments still completed are revenue.
    """
    dates = (F.lit(start), F.lit(end))
    subs = (
        T["subscriptions"]
        .agg(
            count_if(F.col("start_date").between(*dates)).alias("new_subscriptions"),
            count_if(between("cancelled_at", start, end)).alias("cancellations"),
        )
    )
    users = T["users"].filter(between("created_at", start, end))
    paid = in_range(T["payments"], "paid_at", start, end).filter(F.col("payment_status") == "completed")
    net = F.sum(F.col("amount") - F.col("refund_amount")).cast(MONEY)
    watched = in_range(T["watch_history"], "watched_at", start, end)
    views = watched.agg(F.struct(F.count("*").alias("n"), F.countDistinct("profile_id").alias("viewers"))).scalar()
    rated = (
        T["ratings"]
        .filter(between("created_at", start, end))
        .groupBy("content_id")
        .agg(F.sum("rating_value").alias("s"), F.count("rating_value").alias("n"))
        .join(T["content"].select("content_id"), "content_id", "left_semi")
        .agg(ratio(F.sum("s"), F.sum("n"), 2))
    )
    return subs.select(
        _total(users).alias("new_users"),
        "new_subscriptions",
        "cancellations",
        paid.agg(F.coalesce(net, F.lit(0).cast(MONEY))).scalar().alias("net_revenue"),
        views["n"].alias("total_views"),
        views["viewers"].alias("active_viewers"),
        rated.scalar().alias("avg_new_rating"),
    )
