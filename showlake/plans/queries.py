"""Every read operator as a named query over the derived platform tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import at
from ..operators import browse, engagement, kids, latest, ratings, revenue, search, subscriptions
from ..sources.derive import EVENTS_AS_OF, ORDERS_AS_OF
from ..sources.tables import Tables

Query = Callable[[Tables], DataFrame]

FROM, TO = dt.date(1996, 1, 1), dt.date(2000, 12, 31)
SEARCH_FROM, SEARCH_TO = dt.date(2024, 1, 3), dt.date(2024, 1, 28)
TERM = "ring"


def _pairs(T: Tables) -> DataFrame:
    return T["ratings"].select("profile_id", "content_id")


def _kids(T: Tables) -> DataFrame:
    return T["profiles"].filter("is_kids").select("profile_id")


def _kept(T: Tables, log: str, kind: latest.Latest, until: dt.datetime) -> Tables:
    """The log's place taken by a state of its older rows that the newer ones were merged into."""
    moment = F.col(kind.order[0])
    state = kind.of(T[log].filter(moment < at(until)))
    return T.replace(**{log: kind.advanced(state, T[log].filter(moment >= at(until)))})


OLDER, OLDER_SEARCHES = dt.datetime(2000, 6, 1), dt.datetime(2024, 1, 20)


def _sessions(T: Tables, kind: latest.Latest) -> Tables:
    return _kept(T, "watch_history", kind, OLDER)


def _last_of(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each key's last row of a page; ``order`` is the page's, turned round."""
    return rows.selectExpr("*", f"row_number() over (partition by {key} order by {', '.join(order)}) as _n").filter("_n = 1").drop("_n")


def _second_genre_page(T: Tables) -> DataFrame:
    last = _last_of(browse.titles_by_genre(T), "genre_id", ["release_date asc nulls last", "content_id desc"])
    return browse.titles_by_genre(T, after=last)


def _second_list_page(T: Tables) -> DataFrame:
    last = _last_of(browse.my_list_view(T, limit=2), "profile_id", ["added_at", "content_id desc"])
    return browse.my_list_view(T, limit=2, after=last)


def _users(T: Tables) -> DataFrame:
    return T["users"].filter("account_status = 'active'").select("user_id")


READS: dict[str, Query] = {
    "r01_catalog_search": lambda T: browse.catalog_search(T, TERM),
    "r02_search_count": lambda T: browse.search_count(T, TERM),
    "r03_autocomplete": lambda T: browse.autocomplete(T, "s"),
    "r04_titles_by_genre": lambda T: browse.titles_by_genre(T),
    "r05_titles_with_all_genres": lambda T: browse.titles_with_all_genres(T, [1, 4]),
    "r06_titles_by_language": lambda T: browse.titles_by_language(T, "Audio"),
    "r07_title_languages": lambda T: browse.title_languages(T),
    "r08_available_in": lambda T: browse.available_in(T, ORDERS_AS_OF),
    "r09_leaving_soon": lambda T: browse.leaving_soon(T, ORDERS_AS_OF, 60),
    "r10_resume_points": lambda T: browse.resume_points(T),
    "r10_resume_points_asked": lambda T: browse.resume_points(
        T, T["downloads"].select("profile_id", "content_id", "episode_id")
    ),
    "r11_continue_watching": lambda T: browse.continue_watching(T),
    "r11_continue_watching_asked": lambda T: browse.continue_watching(T, _kids(T)),
    "r10_resume_points_kept": lambda T: browse.resume_points(_sessions(T, latest.RESUME)),
    "r11_continue_watching_kept": lambda T: browse.continue_watching(_sessions(T, latest.UNFINISHED)),
    "r35_recent_watches_kept": lambda T: browse.recent_watches(_sessions(T, latest.RECENT_WATCHES)),
    "r36_recent_searches_kept": lambda T: browse.recent_searches(
        _kept(T, "search_history", latest.RECENT_SEARCHES, OLDER_SEARCHES)
    ),
    "r04_titles_by_genre_next": _second_genre_page,
    "r15_my_list_next": _second_list_page,
    "r15_my_list_hot": lambda T: browse.my_list_view(T, split_hot=True),
    "r15_my_list_asked": lambda T: browse.my_list_view(T, _kids(T)),
    "r21_billing_history_asked": lambda T: browse.billing_history(T, _users(T)),
    "r25_user_devices_asked": lambda T: browse.user_devices(T, _users(T)),
    "r11_unfinished": lambda T: browse.continue_watching(T, k=None, started_only=False),
    "r12_next_episode": lambda T: browse.next_episode(T),
    "r13_ratings_for": lambda T: browse.ratings_for(T, T["my_list"].select("profile_id", "content_id")),
    "r14_title_reviews": lambda T: browse.title_reviews(T),
    "r14_title_reviews_gen2": lambda T: browse.title_reviews(T, limit=None, gen=2),
    "r15_my_list_view": lambda T: browse.my_list_view(T),
    "r15_my_list_all": lambda T: browse.my_list_view(T, limit=None, active_only=False),
    "r16_in_my_list": lambda T: browse.in_my_list(T, _pairs(T)),
    "r17_download_quota": lambda T: browse.download_quota(T),
    "r18_device_downloads": lambda T: browse.device_downloads(T),
    "r19_profile_quota": lambda T: browse.profile_quota(T),
    "r20_account_profiles": lambda T: browse.account_profiles(T),
    "r21_billing_history": lambda T: browse.billing_history(T),
    "r22_active_subscription": lambda T: browse.active_subscription(T, ORDERS_AS_OF),
    "r23_subscription_history": lambda T: browse.subscription_history(T),
    "r24_lookup_payments": lambda T: browse.lookup(
        T, "payments", T["payments"].filter("payment_status = 'refunded'").select("transaction_id")
    ),
    "r25_user_devices": lambda T: browse.user_devices(T),
    "r26_title_search": lambda T: browse.title_search(T, TERM),
    "r27_content_detail": lambda T: browse.content_detail(T),
    "r28_cast_list": lambda T: browse.cast_list(T),
    "r28_cast_list_asked": lambda T: browse.cast_list(T, T["content"].filter("status = 'Active'").select("content_id")),
    "r29_filmography": lambda T: browse.filmography(T),
    "r30_actor_search": lambda T: browse.actor_search(T, "9"),
    "r31_admin_content_list": lambda T: browse.admin_content_list(T, limit=None),
    "r31_admin_content_page": lambda T: browse.admin_content_list(T, "Active", TERM),
    "r32_availability_matrix": lambda T: browse.availability_matrix(T, ORDERS_AS_OF),
    "r34_plan_impact": lambda T: browse.plan_impact(T),
    "r35_recent_watches": lambda T: browse.recent_watches(T),
    "r36_recent_searches": lambda T: browse.recent_searches(T),
    "r37_preferences": lambda T: browse.preferences(T),
    "r38_due_for_renewal": lambda T: browse.due_for_renewal(T, dt.date(2001, 8, 15)),
    "k01_kids_browse": lambda T: kids.kids_browse(T),
    "k01_kids_browse_per_system": lambda T: kids.kids_browse(T, mode="per_system"),
    "k02_effective_ceiling": lambda T: kids.effective_ceiling(T),
    "k03_playback_allowed": lambda T: kids.playback_allowed(T, _pairs(T)),
    "k04_kids_genre_row": lambda T: kids.kids_genre_row(T),
    "k04_one_genre": lambda T: kids.kids_genre_row(T, 4),
    "k05_kids_home": lambda T: kids.kids_home(T),
    "k06_kids_fallback": lambda T: kids.kids_fallback(T),
    "k07_kids_search": lambda T: kids.kids_search(T, TERM),
    "k08_kids_profiles": lambda T: kids.kids_profiles(T),
    "a01_title_engagement": lambda T: engagement.title_engagement(T, FROM, TO),
    "a02_daily_trend": lambda T: engagement.daily_trend(T, FROM, TO),
    "a03_episode_dropoff": lambda T: engagement.episode_dropoff(T),
    "a04_title_reach": lambda T: engagement.title_reach(T, FROM, TO),
    "a05_genre_completion": lambda T: engagement.genre_completion(T, FROM, TO),
    "a06_cancellations_mom": lambda T: subscriptions.cancellations_mom(T, 60, ORDERS_AS_OF),
    "a07_cancellation_reasons": lambda T: subscriptions.cancellation_reasons(T),
    "a08_cohort_churn": lambda T: subscriptions.cohort_churn(T),
    "a09_plan_churn": lambda T: subscriptions.plan_churn(T, FROM, TO),
    "a10_at_risk": lambda T: subscriptions.at_risk(T),
    "a11_monthly_revenue": lambda T: revenue.monthly_revenue(T, 60, ORDERS_AS_OF),
    "a11_monthly_revenue_with_refunded": lambda T: revenue.monthly_revenue(T, 60, ORDERS_AS_OF, True),
    "a12_plan_revenue": lambda T: revenue.plan_revenue(T, FROM, TO),
    "a13_refund_stats": lambda T: revenue.refund_stats(T),
    "a14_failed_payments": lambda T: revenue.failed_payments(T, FROM, TO),
    "a15_ltv": lambda T: revenue.ltv(T),
    "a16_top_rated": lambda T: ratings.top_rated(T),
    "a17_weighted_rating": lambda T: ratings.weighted_rating(T, 10),
    "a18_top_rated_in_genre": lambda T: ratings.top_rated_in_genre(T),
    "a19_controversial": lambda T: ratings.controversial(T),
    "a20_search_top": lambda T: search.search_top(T, SEARCH_FROM, SEARCH_TO),
    "a21_search_zero": lambda T: search.search_zero(T, SEARCH_FROM, SEARCH_TO),
    "a22_search_conversion": lambda T: search.search_conversion(T, SEARCH_FROM, SEARCH_TO, 30),
    "a22_search_conversion_day": lambda T: search.search_conversion(T, SEARCH_FROM, SEARCH_TO, 1440, None),
    "a23_trending_searches": lambda T: search.trending_searches(T, EVENTS_AS_OF),
    "a24_exec_dashboard": lambda T: subscriptions.exec_dashboard(T, FROM, TO),
    "b01_top_watched": lambda T: engagement.top_watched(T),
    "b02_genre_hours": lambda T: engagement.genre_hours(T),
    "b03_mrr_by_plan": lambda T: subscriptions.mrr_by_plan(T),
    "b04_total_mrr": lambda T: subscriptions.total_mrr(T),
    "b05_arr_by_plan": lambda T: subscriptions.arr_by_plan(T),
    "b06_churned_users": lambda T: subscriptions.churned_users(T, ORDERS_AS_OF),
    "b07_churn_rate": lambda T: subscriptions.churn_rate(T, ORDERS_AS_OF),
    "b08_completion_by_title": lambda T: engagement.completion_by_title(T),
    "b09_unwatched_content": lambda T: engagement.unwatched_content(T),
    "b10_like_pct": lambda T: ratings.like_pct(T),
    "b11_most_disliked": lambda T: ratings.like_pct(T, "asc"),
    "b12_device_types": lambda T: subscriptions.device_types(T),
    "b13_os_types": lambda T: subscriptions.os_types(T),
    "b14_revenue_by_method": lambda T: revenue.revenue_by_method(T),
    "b15_plan_distribution": lambda T: subscriptions.plan_distribution(T),
    "b16_status_breakdown": lambda T: subscriptions.status_breakdown(T),
    "b17_at_profile_limit": lambda T: subscriptions.at_profile_limit(T),
    "b18_signups_monthly": lambda T: subscriptions.signups_monthly(T, ORDERS_AS_OF),
    "b19_top_searches": lambda T: search.top_searches(T),
    "b20_availability_by_country": lambda T: engagement.availability_by_country(T, ORDERS_AS_OF),
    "b21_titles_per_genre": lambda T: engagement.titles_per_genre(T),
    "b22_titles_per_category": lambda T: engagement.titles_per_category(T),
    "b23_download_adoption": lambda T: subscriptions.download_adoption(T),
    "b24_category_performance": lambda T: engagement.category_performance(T),
    "b25_failed_payment_totals": lambda T: revenue.failed_payment_totals(T, ORDERS_AS_OF),
    "b26_optout_rate": lambda T: subscriptions.optout_rate(T),
    "b27_favourite_genre_hot": lambda T: engagement.favourite_genre(T, split_hot=True),
    "b27_favourite_genre": lambda T: engagement.favourite_genre(T),
    "b28_listed_unwatched": lambda T: engagement.listed_unwatched(T),
    "b29_profiles_per_user": lambda T: subscriptions.profiles_per_user(T),
    "b30_devices_per_user": lambda T: subscriptions.devices_per_user(T),
    "b31_top_actors": lambda T: engagement.top_actors(T),
    "b32_releases_monthly": lambda T: engagement.releases_monthly(T),
}
