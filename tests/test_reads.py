"""Semantics a large comparison can miss, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from showlake.operators import browse, engagement, kids, ratings, revenue, search, subscriptions
from showlake.sources.tables import rating_levels

D, TS = dt.date, dt.datetime
AS_OF = D(2024, 6, 15)


@pytest.fixture(scope="module")
def content(make):
    return make(
        "content_id long, title string, description string, content_type string, content_category string, "
        "release_date date, age_certification string, status string, poster_url string, trailer_url string, "
        "duration_minutes int, created_at timestamp_ntz, updated_at timestamp_ntz",
        (1, "Light", "a", "Movie", "X", D(2020, 1, 1), "G", "Active", None, None, 90, TS(2020, 1, 1), TS(2020, 1, 1)),
        (2, "Night", "light", "Series", None, D(2021, 1, 1), "TV-Y", "Active", None, None, None, TS(2020, 1, 1), TS(2020, 1, 2)),
        (3, "Delight", "b", "Movie", "X", None, "NC-17", "Active", None, None, 80, TS(2020, 1, 1), TS(2020, 1, 3)),
        (4, "Lightning", "c", "Movie", "Y", D(2022, 1, 1), None, "Inactive", None, None, 70, TS(2020, 1, 1), TS(2020, 1, 4)),
        (5, "Light", "d", "Movie", "Y", D(2019, 1, 1), None, "Active", None, None, 70, TS(2020, 1, 1), TS(2020, 1, 4)),
    )


@pytest.fixture(scope="module")
def watched(make):
    ddl = (
        "watch_id long, profile_id long, content_id long, episode_id long, watched_at timestamp_ntz, "
        "watch_duration_seconds int, progress_seconds int, completed boolean"
    )
    return make(
        ddl,
        (1, 1, 1, None, TS(2024, 1, 1), 100, 50, False),
        (2, 1, 1, None, TS(2024, 1, 2), 0, 60, False),
        (3, 1, 2, 21, TS(2024, 1, 3), 100, 70, False),
        (4, 1, 2, None, TS(2024, 1, 4), 100, 100, True),
        (5, 2, 2, 22, TS(2024, 1, 5), 3600, 0, False),
        (6, 2, 1, None, TS(2024, 1, 1, 0, 0, 1), 61, 1, True),
    )


@pytest.fixture(scope="module")
def episodes(make):
    return make(
        "episode_id long, season_id long, episode_number int, title string",
        (21, 20, 1, "One"),
        (22, 20, 2, "Two"),
        (24, 20, 4, "Four"),
        (31, 30, 1, "Next"),
    )


@pytest.fixture(scope="module")
def seasons(make):
    return make("season_id long, content_id long, season_number int", (20, 2, 1), (30, 2, 2))


def test_search_ranks_and_empty_ratings(make, content):
    votes = make("rating_id long, content_id long, rating_value int", (1, 3, 4), (2, 3, 5), (3, 5, None))
    out = browse.catalog_search({"content": content, "ratings": votes}, "LIGHT").collect()
    assert [(r.content_id, r.relevance_score) for r in out] == [(1, 3), (5, 3), (3, 2), (2, 1)]
    assert [(r.avg_rating, r.rating_count) for r in out] == [(None, 0), (None, 1), (4.5, 2), (None, 0)]
    second = browse.catalog_search({"content": content, "ratings": votes}, "light", limit=1, offset=1)
    assert [r.content_id for r in second.collect()] == [5]
    assert browse.search_count({"content": content}, "light").first()[0] == 4
    assert [r.title for r in browse.autocomplete({"content": content}, "li").collect()] == ["Light"]


def test_missing_release_date_sorts_first(content):
    assert [r.content_id for r in browse.title_search({"content": content}, "ight").collect()] == [3, 2, 1, 5]


def test_all_genres(make, content):
    tags = make("content_id long, genre_id long", (1, 1), (1, 2), (2, 1), (4, 1), (4, 2))
    T = {"content": content, "content_genres": tags}
    assert [r.content_id for r in browse.titles_with_all_genres(T, [1, 2]).collect()] == [1]
    assert browse.titles_with_all_genres(T, [1, 3]).count() == 0


def test_genre_must_exist(make, content):
    T = {
        "content": content,
        "content_genres": make("content_id long, genre_id long", (1, 1), (2, 9)),
        "genres": make("genre_id long, genre_name string", (1, "Drama")),
        "ratings": make("rating_id long, content_id long, rating_value int"),
    }
    assert browse.titles_by_genre(T, 9).count() == 0
    assert [r.content_id for r in browse.titles_by_genre(T, genre_name="Drama").collect()] == [1]


def test_resume_points_match_missing_episode(make, watched):
    T = {"watch_history": watched}
    everything = {(r.profile_id, r.content_id, r.episode_id): r.watch_id for r in browse.resume_points(T).collect()}
    assert everything == {(1, 1, None): 2, (1, 2, 21): 3, (1, 2, None): 4, (2, 2, 22): 5, (2, 1, None): 6}
    keys = make("profile_id long, content_id long, episode_id long", (1, 2, None))
    assert [r.watch_id for r in browse.resume_points(T, keys).collect()] == [4]


def test_continue_watching(content, watched, episodes):
    T = {"content": content, "watch_history": watched, "episodes": episodes}
    out = {(r.profile_id, r.content_id): r for r in browse.continue_watching(T).collect()}
    assert set(out) == {(1, 1), (1, 2)}
    assert out[1, 1].watched_at == TS(2024, 1, 2) and out[1, 1].pct_complete is None
    assert out[1, 2].episode_title == "One" and out[1, 2].pct_complete == 70.0
    plain = browse.continue_watching(T, k=None, started_only=False)
    assert plain.count() == 3
    assert [r.content_id for r in browse.continue_watching(T, k=1).collect()] == [1]


def test_next_episode_does_not_jump_gaps(episodes, seasons, rows):
    out = browse.next_episode({"episodes": episodes, "seasons": seasons})
    assert rows(out, "episode_id", "next_episode_id", "next_season_id") == [
        (21, 22, 20),
        (22, 31, 30),
        (24, 31, 30),
        (31, None, None),
    ]


def test_reviews_by_generation(make, rows):
    T = {
        "ratings": make(
            "rating_id long, profile_id long, content_id long, rating_value int, is_liked boolean, "
            "review_text string, created_at timestamp_ntz, updated_at timestamp_ntz",
            (1, 1, 1, 5, True, "good", TS(2024, 1, 1), TS(2024, 1, 1)),
            (2, 1, 2, 5, True, "  ", TS(2024, 1, 1), TS(2024, 1, 1)),
            (3, 1, 3, 5, True, None, TS(2024, 1, 1), TS(2024, 1, 1)),
        ),
        "profiles": make("profile_id long, profile_name string", (1, "P")),
    }
    assert rows(browse.title_reviews(T), "rating_id") == [(1,)]
    assert rows(browse.title_reviews(T, gen=2), "rating_id", "is_liked") == [(1, True), (2, True)]


def test_quotas(make, rows):
    T = {
        "subscriptions": make(
            "user_id long, plan_id int, status string", (1, 1, "active"), (2, 1, "active"), (3, 1, "paused")
        ),
        "subscription_plans": make(
            "plan_id int, plan_name string, max_profiles short, max_downloads int", (1, "A", 2, 5)
        ),
        "profiles": make("profile_id long, user_id long", (11, 1), (12, 1)),
        "downloads": make("profile_id long, download_status string", (11, "Active"), (11, "Deleted"), (12, "Active")),
    }
    assert rows(browse.download_quota(T)) == [(1, 5, 2), (2, 5, 0)]
    assert rows(browse.profile_quota(T)) == [(1, 2, 2, False), (2, 2, 0, True)]
    assert rows(subscriptions.at_profile_limit(T)) == [(1, "A", 2, 2)]


def test_active_plans(make):
    plans = make(
        "plan_id int, plan_name string, price_monthly int, is_active boolean",
        (1, "B", 9, True), (2, "A", 5, True), (3, "C", 1, False),
    )
    assert [r.plan_id for r in browse.active_plans({"subscription_plans": plans}).collect()] == [2, 1]


def test_devices_never_seen_come_first(make):
    devices = make(
        "user_id long, device_id long, os_type string, device_type string, last_active_at timestamp_ntz",
        (1, 1, None, "tablet", TS(2024, 1, 1)), (1, 2, None, "tablet", None), (1, 3, None, "tablet", TS(2024, 1, 2)),
    )
    out = browse.user_devices({"user_devices": devices}, make("user_id long", (1,)))
    assert [r.device_id for r in out.collect()] == [2, 3, 1]


def test_detail_of_title_without_genres(make, content):
    T = {
        "content": content,
        "content_genres": make("content_id long, genre_id long", (1, 2), (1, 1)),
        "genres": make("genre_id long, genre_name string", (1, "Drama"), (2, "Action")),
    }
    found = {r.content_id: r.genres for r in browse.content_detail(T).collect()}
    assert found[1] == ["Action", "Drama"] and found[2] == []
    assert {r.content_id: r.genres for r in browse.content_detail(T, null_for_none=True).collect()}[2] == [None]


def test_cast_order(make):
    T = {
        "content_cast": make(
            "content_id long, actor_id long, character_name string, cast_order int, is_main_cast boolean",
            (1, 1, "a", None, False), (1, 2, "b", 2, False), (1, 3, "c", 9, True),
        ),
        "actors": make("actor_id long, actor_name string, photo_url string", (1, "A", None), (2, "B", None), (3, "C", None)),
    }
    keys = make("content_id long", (1,))
    assert [r.actor_id for r in browse.cast_list(T, keys).collect()] == [3, 2, 1]
    assert [r.actor_id for r in browse.cast_list(T, keys, main_first=False).collect()] == [2, 3, 1]


def test_admin_counts_do_not_multiply(make, content):
    T = {
        "content": content,
        "seasons": make("season_id long, content_id long", (20, 2), (30, 2)),
        "content_cast": make("content_id long, actor_id long", (2, 1), (2, 1), (2, 3)),
    }
    out = {r.content_id: (r.season_count, r.cast_count) for r in browse.admin_content_list(T).collect()}
    assert out[2] == (2, 2) and out[1] == (0, 0)
    assert [r.content_id for r in browse.admin_content_list(T, limit=2).collect()] == [4, 5]


def test_window_status_boundaries(make, rows):
    windows = make(
        "content_id long, country_code string, available_from date, available_to date, region_notes string",
        (1, "A", AS_OF, AS_OF + dt.timedelta(1), None),
        (1, "B", D(2024, 1, 1), AS_OF, None),
        (1, "C", AS_OF + dt.timedelta(1), None, None),
        (1, "D", D(2024, 1, 1), None, None),
    )
    T = {"content_availability": windows}
    assert rows(browse.availability_matrix(T, AS_OF), "country_code", "window_status") == [
        ("A", "Live"), ("B", "Expired"), ("C", "Scheduled"), ("D", "Live"),
    ]
    countries = rows(engagement.availability_by_country(T, AS_OF), "country_code")
    assert countries == [("A",), ("B",), ("D",)], "the last day still counts here"


@pytest.fixture(scope="module")
def gated(spark, make, content):
    return {
        "content": content,
        "content_rating_levels": rating_levels(spark),
        "profiles": make(
            "profile_id long, is_kids boolean, age_rating_limit string",
            (1, True, "TV-Y"), (2, True, "G"), (3, True, None), (4, False, "TV-MA"),
        ),
        "profile_preferred_genres": make("profile_id long, genre_id long", (1, 7)),
        "content_genres": make("content_id long, genre_id long", (1, 7), (2, 7), (3, 8)),
        "genres": make("genre_id long, genre_name string", (7, "Seven"), (8, "Eight")),
        "ratings": make("rating_id long, content_id long, rating_value int", (1, 1, 3)),
    }


def test_kids_gate(gated, rows):
    # On the one scale a TV limit lies above every film code.
    assert rows(kids.kids_browse(gated), "profile_id", "content_id") == [(1, 1), (1, 2), (1, 3), (2, 1)]
    split = kids.kids_browse(gated, mode="per_system")
    assert rows(split, "profile_id", "content_id") == [(1, 2), (2, 1)]
    assert rows(kids.kids_browse(gated, k=1), "profile_id", "content_id") == [(1, 3), (2, 1)]
    with pytest.raises(ValueError):
        kids.gate(gated, "other")


def test_kids_lists(gated, make, rows):
    assert rows(kids.kids_home(gated), "profile_id", "content_id", "rank_in_row") == [(1, 1, 2), (1, 2, 1)]
    assert rows(kids.kids_fallback(gated), "profile_id", "content_id", "avg_rating") == [
        (2, 1, 3.0), (4, 1, 3.0), (4, 2, None), (4, 3, None),
    ]
    assert rows(kids.kids_genre_row(gated, 8), "profile_id", "content_id") == [(1, 3), (4, 3)]
    assert rows(kids.kids_search(gated, "delight"), "profile_id", "content_id") == [(1, 3), (4, 3)]
    assert rows(kids.effective_ceiling(gated)) == [(1, 6), (2, 1), (3, 1), (4, 10)]


def test_screens_are_sorted(gated, make, content, watched):
    keys = make("profile_id long", (1,))
    assert [r.content_id for r in kids.kids_browse(gated, keys=keys).collect()] == [3, 2, 1]
    T = {"content": content, "watch_history": watched}
    assert [r.watch_id for r in browse.recent_watches(T, keys, k=3).collect()] == [4, 3, 2]


def test_playback(gated, make, rows):
    pairs = make("profile_id long, content_id long", (1, 1), (2, 2), (3, 1), (4, 4), (9, 1), (1, 99))
    assert rows(kids.playback_allowed(gated, pairs)) == [
        (1, 1, True), (1, 99, False), (2, 2, False), (3, 1, False), (4, 4, False), (9, 1, False),
    ]


def test_range_ends_are_moments(content, watched):
    T = {"content": content, "watch_history": watched}
    one_day = engagement.title_engagement(T, D(2024, 1, 1), D(2024, 1, 1)).collect()
    assert [(r.content_id, r.total_views) for r in one_day] == [(1, 1)], "only midnight itself"
    whole = engagement.title_engagement(T, D(2024, 1, 1), TS(2024, 1, 5, 23, 59)).collect()
    assert [(r.content_id, r.total_views, r.unique_viewers, r.completed_views) for r in whole] == [
        (1, 3, 2, 1), (2, 3, 2, 1),
    ]
    assert whole[0].completion_rate_pct == 33.3 and whole[0].avg_minutes_watched == 0.9


def test_dropoff_with_zero_views(watched, episodes, seasons, rows):
    T = {"watch_history": watched, "episodes": episodes, "seasons": seasons}
    out = engagement.episode_dropoff(T)
    assert rows(out, "season_number", "episode_number", "total_views", "completions", "pct_retained_from_prev_episode") == [
        (1, 1, 1, 0, None), (1, 2, 1, 0, 100.0), (1, 4, 0, 0, 0.0), (2, 1, 0, 0, None),
    ]
    assert {r.completion_rate_pct for r in out.collect()} == {0.0, None}


def test_same_title_is_one_row(content, watched):
    again = watched.withColumn("content_id", F.lit(5).cast("long")).unionByName(watched)
    out = engagement.completion_by_title({"content": content, "watch_history": again}).collect()
    assert {r.title: r.total_sessions for r in out} == {"Light": 9, "Night": 3}


def test_months_without_rows_are_not_filled(make):
    subs = make(
        "user_id long, status string, cancelled_at timestamp_ntz, start_date date",
        (1, "cancelled", TS(2024, 1, 5), D(2023, 1, 1)),
        (2, "cancelled", TS(2024, 3, 5), D(2023, 1, 1)),
        (3, "cancelled", TS(2024, 3, 6), D(2024, 6, 1)),
        (4, "active", None, D(2024, 5, 16)),
    )
    out = subscriptions.cancellations_mom({"subscriptions": subs}, 12, AS_OF).collect()
    assert [(r.cancel_month, r.prev_month_cancellations, r.pct_change_mom) for r in out] == [
        (D(2024, 3, 1), 1, 100.0), (D(2024, 1, 1), None, None),
    ]
    rate = subscriptions.churn_rate({"subscriptions": subs}, AS_OF).first()
    assert (rate.churned, rate.base, rate.churn_rate_pct) == (0, 3, 0.0)


def test_empty_inputs(make):
    subs = make("user_id long, status string, cancelled_at timestamp_ntz, start_date date, auto_renew boolean")
    T = {"subscriptions": subs}
    assert tuple(subscriptions.churn_rate(T, AS_OF).first()) == (0, 0, None)
    assert tuple(subscriptions.optout_rate(T).first()) == (0, 0, None)
    pays = make("payment_status string, created_at timestamp_ntz, amount decimal(10,2)")
    assert tuple(revenue.failed_payment_totals({"payments": pays}, AS_OF).first()) == (0, None)


def test_yearly_price_may_be_missing(make, rows):
    T = {
        "subscriptions": make(
            "plan_id int, status string, billing_cycle string",
            (1, "active", "yearly"), (1, "active", "monthly"), (2, "active", "yearly"), (1, "paused", "yearly"),
        ),
        "subscription_plans": make(
            "plan_id int, plan_name string, price_monthly int, price_yearly int", (1, "A", 2, 20), (2, "B", 3, None)
        ),
    }
    out = {r.plan_name: r.arr for r in subscriptions.arr_by_plan(T).collect()}
    assert out["A"] == 44 and out["B"] is None


def test_negative_growth_and_refund_days(make):
    pays = make(
        "payment_id long, user_id long, payment_status string, amount int, refund_amount int, "
        "paid_at timestamp_ntz, refunded_at timestamp_ntz",
        (1, 1, "completed", 100, 0, TS(2024, 1, 1), None),
        (2, 1, "completed", 90, 40, TS(2024, 3, 1), None),
        (3, 1, "refunded", 100, 100, TS(2024, 3, 10, 1), TS(2024, 3, 11, 13)),
    )
    T = {"payments": pays}
    growth = [r.net_revenue_growth_pct for r in revenue.monthly_revenue(T, 12, AS_OF).collect()]
    assert growth == [-50.0, None]
    stats = revenue.refund_stats(T).first()
    assert (stats.refunded_payments, stats.total_payments, stats.avg_days_to_refund) == (2, 3, 1.5)
    assert revenue.monthly_revenue(T, 12, AS_OF, include_refunded=True).first().gross_revenue == 190


def test_likes_count_whole_titles_only(make, content):
    votes = make(
        "content_id long, is_liked boolean, season_id long, episode_id long, part_id long",
        (1, True, None, None, None), (5, False, None, None, None), (2, True, 20, None, None), (2, True, None, None, 4),
    )
    T = {"content": content, "ratings": votes}
    assert [tuple(r) for r in ratings.like_pct(T).collect()] == [("Light", 2, 50.0)]


def test_weighted_rating(make, content):
    votes = make(
        "rating_id long, content_id long, rating_value int", (1, 1, 5), (2, 2, 1), (3, 2, 2), (4, 2, 1)
    )
    out = {r.content_id: r.weighted_rating for r in ratings.weighted_rating({"content": content, "ratings": votes}, 1).collect()}
    assert out == {1: 3.63, 2: 1.56}, "3.625 and 1.5625, half up"
    spread = ratings.controversial({"content": content, "ratings": votes}, min_votes=1).collect()
    assert [(r.content_id, r.rating_stddev) for r in spread] == [(1, None), (2, 0.58)]


def _brute_conversion(searches, sessions, minutes):
    out = {}
    for query in {s[1] for s in searches}:
        mine = [s for s in searches if s[1] == query]
        hits = {
            w[0]
            for w in sessions
            for s in mine
            if w[1] == s[2] and s[3] <= w[2] <= s[3] + dt.timedelta(minutes=minutes)
        }
        out[query] = (len(mine), len(hits))
    return out


@pytest.mark.parametrize("seed, minutes", [(1, 5), (2, 1), (3, 30), (4, 0)])
def test_conversion_against_all_pairs(make, seed, minutes):
    import random

    rng = random.Random(seed)
    start = TS(2024, 1, 1)

    def moment():
        # Coarse and fine steps, so equal moments and slot edges are hit often.
        return start + dt.timedelta(seconds=rng.choice([60 * rng.randrange(90), rng.randrange(5400)]), microseconds=rng.choice([0, 0, 1, 999999]))

    searches = [(i, f"q{rng.randrange(4)}", rng.choice([1, 1, 1, 2, 3]), moment()) for i in range(150)]
    sessions = [(i, rng.choice([1, 1, 1, 2, 4]), moment()) for i in range(200)]
    T = {
        "search_history": make("search_id long, search_query string, profile_id long, searched_at timestamp_ntz", *searches),
        "watch_history": make("watch_id long, profile_id long, watched_at timestamp_ntz", *sessions),
    }
    out = search.search_conversion(T, D(2024, 1, 1), D(2024, 1, 2), minutes, None)
    assert {r.search_query: (r.total_searches, r.resulting_watches) for r in out.collect()} == _brute_conversion(
        searches, sessions, minutes
    )


def test_trending_without_last_week(make):
    rows = [("old", TS(2024, 6, 2))] * 4 + [("old", TS(2024, 6, 10))] * 6 + [("new", TS(2024, 6, 14))] * 5
    rows += [("rare", TS(2024, 6, 14))] * 4
    T = {"search_history": make("search_query string, searched_at timestamp_ntz", *rows)}
    assert [tuple(r) for r in search.trending_searches(T, AS_OF).collect()] == [("old", 6, 4, 50.0), ("new", 5, 0, None)]
