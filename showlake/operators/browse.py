"""Catalogue and account screens.

Screens that an app asks for one id are computed here for every key at once;
``keys`` (a DataFrame of key columns) narrows them.  Columns behind a NOT NULL
foreign key are looked up after the cut to a page, so the large log is reduced
before it is joined.  ``quality.validate`` checks those keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import contains_ci, is_blank, ratio, starts_ci, window_open
from ..functions.frames import beyond, for_screen, look_up, only_keys, page, split_join, top_per_key
from ..sources.tables import Tables


def newest_release() -> Column:
    return F.desc_nulls_first("release_date")


def active_titles(T: Tables) -> DataFrame:
    return T["content"].filter("status = 'Active'")


def average_ratings(T: Tables, digits: int = 1) -> DataFrame:
    """``content_id, avg_rating, rating_count``; one row per rated title."""
    return (
        T["ratings"]
        .groupBy("content_id")
        .agg(F.sum("rating_value").alias("_sum"), F.count("rating_value").alias("_n"), F.count("rating_id").alias("n"))
        .select(
            "content_id",
            ratio(F.col("_sum"), F.col("_n"), digits).alias("avg_rating"),
            F.col("n").alias("rating_count"),
        )
    )


def catalog_search(T: Tables, term: str, limit: int | None = 10, offset: int = 0) -> DataFrame:
    """Active titles matching in title or description, best match first."""
    score = F.when(starts_ci("title", term), 3).when(contains_ci("title", term), 2).otherwise(1)
    hits = active_titles(T).filter(contains_ci("title", term) | contains_ci("description", term))
    rows = hits.join(average_ratings(T), "content_id", "left").select(
        "content_id",
        "title",
        "content_type",
        "release_date",
        "poster_url",
        "age_certification",
        "avg_rating",
        F.coalesce("rating_count", F.lit(0)).alias("rating_count"),
        score.alias("relevance_score"),
    )
    order = [F.desc("relevance_score"), F.desc_nulls_last("avg_rating"), newest_release(), F.asc("content_id")]
    return page(rows, order, limit, offset)


def search_count(T: Tables, term: str) -> DataFrame:
    hits = active_titles(T).filter(contains_ci("title", term) | contains_ci("description", term))
    return hits.agg(F.count("*").alias("total_matches"))


def autocomplete(T: Tables, prefix: str, k: int = 8) -> DataFrame:
    titles = active_titles(T).filter(starts_ci("title", prefix)).select("title").distinct()
    return titles.orderBy("title").limit(k)


def titles_by_genre(
    T: Tables,
    genre_id: int | None = None,
    genre_name: str | None = None,
    limit: int | None = 10,
    offset: int = 0,
    after: DataFrame | None = None,
) -> DataFrame:
    """One page of active titles per existing genre, newest first.

    ``after`` (genre_id, release_date, content_id) has each genre's last row
    so far and asks for the page behind it, in place of an offset.
    """
    genres = T["genres"].select("genre_id", "genre_name")
    if genre_id is not None:
        genres = genres.filter(F.col("genre_id") == genre_id)
    if genre_name is not None:
        genres = genres.filter(F.col("genre_name") == genre_name)
    tagged = (
        T["content_genres"]
        .join(genres, "genre_id")
        .join(
            active_titles(T).select("content_id", "title", "content_type", "poster_url", "release_date"),
            "content_id",
        )
    )
    order = [newest_release(), F.asc("content_id")]
    tagged = beyond(tagged, ["genre_id"], [("release_date", True), ("content_id", False)], after)
    cut = top_per_key(tagged, ["genre_id"], order, limit, offset)
    rows = cut.join(average_ratings(T).drop("rating_count"), "content_id", "left").select(
        "genre_id", "genre_name", "content_id", "title", "content_type", "poster_url", "release_date", "avg_rating"
    )
    asked = genre_id if genre_id is not None else genre_name
    return for_screen(rows, asked, [F.asc("genre_id"), *order])


def titles_with_all_genres(T: Tables, genre_ids: list[int], limit: int | None = 10, offset: int = 0) -> DataFrame:
    """Active titles that carry every one of ``genre_ids``."""
    wanted = sorted(set(genre_ids))
    complete = (
        T["content_genres"]
        .filter(F.col("genre_id").isin(wanted))
        .groupBy("content_id")
        .agg(F.countDistinct("genre_id").alias("n"))
        .filter(F.col("n") == len(genre_ids))
    )
    rows = active_titles(T).join(complete, "content_id", "left_semi")
    rows = page(rows, [newest_release(), F.asc("content_id")], limit, offset)
    return rows.select("content_id", "title", "poster_url")


def titles_by_language(
    T: Tables,
    kind: str,
    language_id: int | None = None,
    limit: int | None = 10,
    offset: int = 0,
    after: DataFrame | None = None,
) -> DataFrame:
    """Active titles with a track of ``kind`` or 'Both', a page per language; ``after`` (language_id, title, content_id) as in ``titles_by_genre``."""
    tracks = T["content_languages"].filter(F.col("language_type").isin(kind, "Both"))
    if language_id is not None:
        tracks = tracks.filter(F.col("language_id") == language_id)
    rows = (
        tracks.select("language_id", "content_id")
        .distinct()
        .join(active_titles(T).select("content_id", "title", "content_type", "poster_url"), "content_id")
        .select("language_id", "content_id", "title", "content_type", "poster_url")
    )
    order = [F.asc("title"), F.asc("content_id")]
    rows = beyond(rows, ["language_id"], [("title", False), ("content_id", False)], after)
    return for_screen(top_per_key(rows, ["language_id"], order, limit, offset), language_id, order)


def title_languages(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    rows = (
        only_keys(T["content_languages"], keys)
        .join(T["languages"], "language_id")
        .select("content_id", "language_name", "language_code", "language_type", "is_default")
    )
    return for_screen(rows, keys, [F.asc("content_id"), F.desc("is_default"), F.asc("language_name")])


def available_in(
    T: Tables,
    as_of: dt.date,
    country: str | None = None,
    limit: int | None = 10,
    offset: int = 0,
    closed: bool = False,
    after: DataFrame | None = None,
) -> DataFrame:
    """Active titles whose window is open, latest opened first, a page per country; ``after`` (country_code, available_from, content_id) as in ``titles_by_genre``."""
    windows = T["content_availability"].filter(window_open(as_of, "available_from", "available_to", closed))
    if country is not None:
        windows = windows.filter(F.col("country_code") == country.upper())
    rows = windows.join(active_titles(T).select("content_id", "title", "poster_url"), "content_id").select(
        "country_code", "content_id", "title", "poster_url", "available_from", "available_to"
    )
    order = [F.desc("available_from"), F.asc("content_id")]
    rows = beyond(rows, ["country_code"], [("available_from", True), ("content_id", False)], after)
    return for_screen(top_per_key(rows, ["country_code"], order, limit, offset), country, order)


def leaving_soon(T: Tables, as_of: dt.date, days: int, country: str | None = None, k: int | None = 20) -> DataFrame:
    """Active titles whose window ends within ``days`` of ``as_of``, per country."""
    last = as_of + dt.timedelta(days=days)
    windows = T["content_availability"].filter(F.col("available_to").between(F.lit(as_of), F.lit(last)))
    if country is not None:
        windows = windows.filter(F.col("country_code") == country.upper())
    rows = windows.join(active_titles(T).select("content_id", "title", "poster_url"), "content_id").select(
        "country_code", "content_id", "title", "poster_url", "available_to"
    )
    order = [F.asc("available_to"), F.asc("content_id")]
    return for_screen(top_per_key(rows, ["country_code"], order, k), country, order)


def resume_points(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Latest session per profile, title and episode; movies have no episode.

    ``keys`` may hold any of profile_id, content_id and episode_id; a NULL
    episode in it means "no episode".
    """
    log = T["watch_history"]
    if keys is not None:
        match = None
        wanted = keys.select(*[F.col(c).alias(f"_{c}") for c in keys.columns])
        for c in keys.columns:
            same = log[c].eqNullSafe(wanted[f"_{c}"])
            match = same if match is None else match & same
        log = log.join(wanted, match, "left_semi")
    rows = top_per_key(
        log, ["profile_id", "content_id", "episode_id"], [F.desc("watched_at"), F.desc("watch_id")], 1
    )
    return rows.select(
        "profile_id",
        "content_id",
        "episode_id",
        "watch_id",
        "progress_seconds",
        "watch_duration_seconds",
        "completed",
        "watched_at",
    )


def continue_watching(
    T: Tables, keys: DataFrame | None = None, k: int | None = 10, started_only: bool = True
) -> DataFrame:
    """Latest unfinished session per profile and title, lowest title ids first.

    ``started_only=False`` with ``k=None`` is the plain form that also lists
    sessions without progress.
    """
    log = only_keys(T["watch_history"], keys).filter(~F.col("completed"))
    if started_only:
        log = log.filter(F.col("progress_seconds") > 0)
    latest = top_per_key(log, ["profile_id", "content_id"], [F.desc("watched_at"), F.desc("watch_id")], 1)
    cut = top_per_key(latest, ["profile_id"], [F.asc("content_id")], k)
    titles = T["content"].select("content_id", "title", "poster_url", "content_type")
    episodes = T["episodes"].select("episode_id", F.col("title").alias("episode_title"))
    rows = (
        look_up(cut.join(titles, "content_id"), episodes, "episode_id")
        .select(
            "profile_id",
            "content_id",
            "title",
            "poster_url",
            "content_type",
            "episode_id",
            "episode_title",
            "progress_seconds",
            "watch_duration_seconds",
            ratio(F.col("progress_seconds") * 100, F.col("watch_duration_seconds"), 0).alias("pct_complete"),
            "watched_at",
        )
    )
    return for_screen(rows, keys, [F.asc("profile_id"), F.asc("content_id")])


def next_episode(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """What to play after each episode: the next number, else next season's first.

    A gap in the numbering has no successor within the season.
    """
    number = F.col("episode_number")
    here = only_keys(T["episodes"], keys).select("episode_id", "season_id", "episode_number")
    follower = T["episodes"].select(
        "season_id",
        (number - 1).alias("episode_number"),
        F.col("episode_id").alias("_same_id"),
        F.col("title").alias("_same_title"),
    )
    seasons = T["seasons"].select("season_id", "content_id", "season_number")
    opener = (
        T["episodes"]
        .filter(number == 1)
        .join(seasons, "season_id")
        .select(
            "content_id",
            (F.col("season_number") - 1).alias("season_number"),
            F.col("season_id").alias("_later_season"),
            F.col("episode_id").alias("_later_id"),
            F.col("title").alias("_later_title"),
        )
    )
    same = F.col("_same_id").isNotNull()
    return (
        here.join(follower, ["season_id", "episode_number"], "left")
        .join(seasons, "season_id")
        .join(opener, ["content_id", "season_number"], "left")
        .select(
            "episode_id",
            "season_id",
            "episode_number",
            F.coalesce("_same_id", "_later_id").alias("next_episode_id"),
            F.coalesce("_same_title", "_later_title").alias("next_title"),
            F.when(same, F.col("season_id")).otherwise(F.col("_later_season")).alias("next_season_id"),
        )
    )


def ratings_for(T: Tables, keys: DataFrame) -> DataFrame:
    """A profile's own ratings of the asked (profile_id, content_id) pairs."""
    return only_keys(T["ratings"], keys).select(
        "profile_id", "content_id", "rating_value", "review_text", "updated_at"
    )


def title_reviews(
    T: Tables,
    keys: DataFrame | None = None,
    limit: int | None = 10,
    offset: int = 0,
    gen: int = 1,
    after: DataFrame | None = None,
) -> DataFrame:
    """A page of reviews per title, newest first; ``after`` (content_id, the time sorted by, rating_id) as in ``titles_by_genre``.

    Generation 1 leaves out blank texts and sorts by last change; generation 2
    lists every text by its creation.
    """
    written = F.col("review_text").isNotNull()
    if gen == 1:
        written = written & ~is_blank("review_text")
    verdict, stamp = ("rating_value", "updated_at") if gen == 1 else ("is_liked", "created_at")
    rows = only_keys(T["ratings"], keys).filter(written)
    order = [F.desc(stamp), F.asc("rating_id")]
    rows = beyond(rows, ["content_id"], [(stamp, True), ("rating_id", False)], after)
    cut = top_per_key(rows, ["content_id"], order, limit, offset)
    named = cut.join(T["profiles"].select("profile_id", "profile_name"), "profile_id").select(
        "content_id", "rating_id", verdict, "review_text", stamp, "profile_name"
    )
    return for_screen(named, keys, [F.asc("content_id"), *order])


def my_list_view(
    T: Tables,
    keys: DataFrame | None = None,
    limit: int | None = 10,
    offset: int = 0,
    active_only: bool = True,
    after: DataFrame | None = None,
    split_hot: bool = False,
) -> DataFrame:
    """A page of every profile's list, newest entries first; ``after`` (profile_id, added_at, content_id) as in ``titles_by_genre``.

    With ``split_hot`` a title that most profiles list does not gather their
    entries in one task, for one more pass over the lists.
    """
    titles = active_titles(T) if active_only else T["content"]
    titles = titles.select("content_id", "title", "poster_url", "content_type")
    listed = beyond(only_keys(T["my_list"], keys), ["profile_id"], [("added_at", True), ("content_id", False)], after)
    rows = (
        (split_join(listed, titles, "content_id") if split_hot else listed.join(titles, "content_id"))
        .select("profile_id", "my_list_id", "content_id", "title", "poster_url", "content_type", "added_at")
    )
    order = [F.desc("added_at"), F.asc("content_id")]
    return for_screen(top_per_key(rows, ["profile_id"], order, limit, offset), keys, [F.asc("profile_id"), *order])


def in_my_list(T: Tables, pairs: DataFrame) -> DataFrame:
    """``pairs`` (profile_id, content_id) with whether each is on the list."""
    keys = ["profile_id", "content_id"]
    listed = T["my_list"].select(*keys).join(pairs, keys, "left_semi").distinct().withColumn("_on", F.lit(True))
    return pairs.join(listed, keys, "left").select(*keys, F.coalesce("_on", F.lit(False)).alias("in_my_list"))


def _active_plans_of_users(T: Tables, keys: DataFrame | None) -> DataFrame:
    subscriptions = only_keys(T["subscriptions"].filter("status = 'active'"), keys)
    return subscriptions.join(T["subscription_plans"].drop("status", "created_at", "updated_at"), "plan_id")


def download_quota(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Plan allowance against active downloads, per subscribed user."""
    per_profile = (
        T["downloads"]
        .filter("download_status = 'Active'")
        .groupBy("profile_id")
        .agg(F.count("*").alias("n"))
    )
    per_user = (
        per_profile.join(T["profiles"].select("profile_id", "user_id"), "profile_id")
        .groupBy("user_id")
        .agg(F.sum("n").alias("n"))
    )
    return (
        _active_plans_of_users(T, keys)
        .join(per_user, "user_id", "left")
        .select("user_id", "max_downloads", F.coalesce("n", F.lit(0)).alias("current_downloads"))
    )


def device_downloads(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Active downloads per profile and device with the space they take together."""
    active = only_keys(T["downloads"], keys).filter("download_status = 'Active'")
    device = ["profile_id", "device_id"]
    totals = active.groupBy(*device).agg(
        F.sum("file_size_mb").cast("decimal(28,2)").alias("total_storage_used_mb")
    )
    episodes = T["episodes"].select("episode_id", F.col("title").alias("episode_title"))
    rows = (
        look_up(
            active.join(totals, device).join(T["content"].select("content_id", "title", "poster_url"), "content_id"),
            episodes,
            "episode_id",
        )
        .select(
            *device,
            "download_id",
            "title",
            "poster_url",
            "episode_id",
            "episode_title",
            "file_size_mb",
            "downloaded_at",
            "expiry_date",
            "total_storage_used_mb",
        )
    )
    return for_screen(rows, keys, [*map(F.asc, device), F.desc("downloaded_at"), F.asc("download_id")])


def profile_quota(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Profiles in use against the plan's limit, per subscribed user."""
    counts = T["profiles"].groupBy("user_id").agg(F.count("profile_id").alias("n"))
    current = F.coalesce("n", F.lit(0))
    return (
        _active_plans_of_users(T, keys)
        .join(counts, "user_id", "left")
        .select(
            "user_id",
            "max_profiles",
            current.alias("current_profile_count"),
            (current < F.col("max_profiles")).alias("can_create_more"),
        )
    )


def account_profiles(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    rows = only_keys(T["profiles"], keys)
    rows = for_screen(rows, keys, [F.asc("user_id"), F.desc("is_primary"), F.asc("created_at"), F.asc("profile_id")])
    return rows.select(
        "user_id",
        "profile_id",
        "profile_name",
        "avatar_url",
        "is_kids",
        "is_primary",
        F.col("pin_hash").isNotNull().alias("is_pin_protected"),
    )


def billing_history(
    T: Tables,
    keys: DataFrame | None = None,
    limit: int | None = 10,
    offset: int = 0,
    after: DataFrame | None = None,
) -> DataFrame:
    """A page of payments per user with the plan they were for, newest first; ``after`` (user_id, created_at, payment_id) as in ``titles_by_genre``."""
    order = [F.desc("created_at"), F.asc("payment_id")]
    paid = beyond(only_keys(T["payments"], keys), ["user_id"], [("created_at", True), ("payment_id", False)], after)
    cut = top_per_key(paid, ["user_id"], order, limit, offset)
    plans = (
        T["subscriptions"]
        .select("subscription_id", "plan_id")
        .join(T["subscription_plans"].select("plan_id", "plan_name"), "plan_id")
    )
    rows = for_screen(cut.join(plans, "subscription_id"), keys, [F.asc("user_id"), *order])
    return rows.select(
        "user_id",
        "payment_id",
        "amount",
        "currency",
        "payment_status",
        "payment_method",
        "invoice_url",
        "paid_at",
        "plan_name",
    )


def active_subscription(T: Tables, as_of: dt.date, keys: DataFrame | None = None) -> DataFrame:
    """The running subscription of every user and whether it is still a trial."""
    trial = F.col("trial_end_date")
    return _active_plans_of_users(T, keys).select(
        "user_id",
        "subscription_id",
        "plan_name",
        "price_monthly",
        "price_yearly",
        "billing_cycle",
        "start_date",
        "next_billing_date",
        "auto_renew",
        "status",
        "trial_end_date",
        (trial.isNotNull() & (trial >= F.lit(as_of))).alias("is_in_trial"),
    )


def subscription_history(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    rows = (
        only_keys(T["subscriptions"], keys)
        .join(T["subscription_plans"].select("plan_id", "plan_name"), "plan_id")
        .select("user_id", "subscription_id", "plan_name", "status", "start_date", "end_date", "cancellation_reason")
    )
    return for_screen(rows, keys, [F.asc("user_id"), F.desc("start_date"), F.desc("subscription_id")])


def lookup(T: Tables, table: str, keys: DataFrame) -> DataFrame:
    """Whole rows of any table by key."""
    return only_keys(T[table], keys)


def user_devices(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Registered devices; those never seen active come first, then most recent."""
    rows = only_keys(T["user_devices"], keys).select(
        "user_id", "device_id", "os_type", "device_type", "last_active_at"
    )
    return for_screen(rows, keys, [F.asc("user_id"), F.desc_nulls_first("last_active_at"), F.asc("device_id")])


def title_search(T: Tables, term: str) -> DataFrame:
    rows = active_titles(T).filter(contains_ci("title", term))
    return rows.orderBy(newest_release(), F.asc("content_id")).select(
        "content_id", "title", "content_type", "content_category", "release_date", "poster_url"
    )


def content_detail(T: Tables, keys: DataFrame | None = None, null_for_none: bool = False) -> DataFrame:
    """Titles with their genre names.

    ``null_for_none`` writes ``[NULL]`` for a title without genres, which is
    what an array aggregate over an outer join gives.
    """
    names = (
        only_keys(T["content_genres"], keys)
        .join(T["genres"].select("genre_id", "genre_name"), "genre_id")
        .groupBy("content_id")
        .agg(F.sort_array(F.collect_set("genre_name")).alias("genres"))
    )
    nothing = F.array(F.lit(None).cast("string")) if null_for_none else F.array().cast("array<string>")
    return (
        only_keys(T["content"], keys)
        .join(names, "content_id", "left")
        .select(
            "content_id",
            "title",
            "description",
            "content_type",
            "content_category",
            "release_date",
            "duration_minutes",
            "poster_url",
            "trailer_url",
            F.coalesce("genres", nothing).alias("genres"),
        )
    )


def cast_list(T: Tables, keys: DataFrame | None = None, main_first: bool = True) -> DataFrame:
    rows = (
        only_keys(T["content_cast"], keys)
        .join(T["actors"].select("actor_id", "actor_name", "photo_url"), "actor_id")
        .select(
            "content_id", "actor_id", "actor_name", "photo_url", "character_name", "cast_order", "is_main_cast"
        )
    )
    order = [F.asc("content_id"), F.asc_nulls_last("cast_order"), F.asc("actor_id")]
    if main_first:
        order.insert(1, F.desc("is_main_cast"))
    return for_screen(rows, keys, order)


def filmography(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    rows = (
        only_keys(T["content_cast"], keys)
        .join(active_titles(T).select("content_id", "title", "poster_url", "release_date"), "content_id")
        .select("actor_id", "content_id", "title", "poster_url", "release_date", "character_name")
    )
    return for_screen(rows, keys, [F.asc("actor_id"), newest_release(), F.asc("content_id")])


def actor_search(T: Tables, term: str, k: int = 10) -> DataFrame:
    rows = T["actors"].filter(contains_ci("actor_name", term))
    rows = rows.select("actor_id", "actor_name", "date_of_birth", "photo_url")
    return rows.orderBy("actor_name", "actor_id").limit(k)


def admin_content_list(
    T: Tables, status: str | None = None, term: str | None = None, limit: int | None = 10, offset: int = 0
) -> DataFrame:
    """Catalogue table with season and cast counts, last changed first.

    The page is cut first; its titles' seasons and cast are counted apart, so
    no join multiplies rows.
    """
    rows = T["content"].select(
        "content_id", "title", "content_type", "status", "release_date", "created_at", "updated_at"
    )
    if status is not None:
        rows = rows.filter(F.col("status") == status)
    if term is not None:
        rows = rows.filter(contains_ci("title", term))
    order = [F.desc("updated_at"), F.asc("content_id")]
    rows = page(rows, order, limit, offset)
    shown = rows.select("content_id") if limit is not None else None
    seasons = only_keys(T["seasons"], shown).groupBy("content_id").agg(F.countDistinct("season_id").alias("s"))
    cast = only_keys(T["content_cast"], shown).groupBy("content_id").agg(F.countDistinct("actor_id").alias("a"))
    return (
        rows.join(seasons, "content_id", "left")
        .join(cast, "content_id", "left")
        .select(
            *rows.columns,
            F.coalesce("s", F.lit(0)).alias("season_count"),
            F.coalesce("a", F.lit(0)).alias("cast_count"),
        )
        .orderBy(*order)
    )


def availability_matrix(T: Tables, as_of: dt.date, keys: DataFrame | None = None) -> DataFrame:
    """Windows with their state on ``as_of``; the end day itself is over."""
    state = (
        F.when(F.lit(as_of) < F.col("available_from"), "Scheduled")
        .when(F.col("available_to").isNull() | (F.lit(as_of) < F.col("available_to")), "Live")
        .otherwise("Expired")
    )
    rows = only_keys(T["content_availability"], keys).select(
        "content_id",
        "country_code",
        "available_from",
        "available_to",
        "region_notes",
        state.alias("window_status"),
    )
    return for_screen(rows, keys, [F.asc("content_id"), F.asc("country_code"), F.asc("available_from")])


def active_plans(T: Tables) -> DataFrame:
    """Plans open to new customers, cheapest first."""
    return T["subscription_plans"].filter("is_active").orderBy("price_monthly", "plan_id")


def plan_impact(T: Tables) -> DataFrame:
    """Active subscribers of every plan, including plans without any."""
    counts = (
        T["subscriptions"]
        .filter("status = 'active'")
        .groupBy("plan_id")
        .agg(F.count("*").alias("n"))
    )
    return (
        T["subscription_plans"]
        .select("plan_id")
        .join(counts, "plan_id", "left")
        .select("plan_id", F.coalesce("n", F.lit(0)).alias("active_subscribers_on_plan"))
    )


def recent_watches(T: Tables, keys: DataFrame | None = None, k: int = 8) -> DataFrame:
    order = [F.desc("watched_at"), F.desc("watch_id")]
    cut = top_per_key(only_keys(T["watch_history"], keys), ["profile_id"], order, k)
    rows = cut.join(T["content"].select("content_id", "title"), "content_id").select(
        "profile_id", "watch_id", "title", "episode_id", "watched_at", "progress_seconds", "completed"
    )
    return for_screen(rows, keys, [F.asc("profile_id"), *order])


def recent_searches(T: Tables, keys: DataFrame | None = None, k: int = 8) -> DataFrame:
    order = [F.desc("searched_at"), F.desc("search_id")]
    cut = top_per_key(only_keys(T["search_history"], keys), ["profile_id"], order, k)
    rows = for_screen(cut, keys, [F.asc("profile_id"), *order])
    return rows.select("profile_id", "search_query", "searched_at", "result_count")


def preferences(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Stored preferences without their row id and time stamps."""
    hidden = {"preference_id", "created_at", "updated_at"}
    rows = only_keys(T["profile_preferences"], keys)
    return rows.select(*[c for c in rows.columns if c not in hidden])


def due_for_renewal(T: Tables, as_of: dt.date) -> DataFrame:
    return (
        T["subscriptions"]
        .filter("status = 'active' and auto_renew")
        .filter(F.col("next_billing_date") == F.lit(as_of))
        .select("subscription_id", "user_id", "plan_id", "billing_cycle")
    )
