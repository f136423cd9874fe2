"""Change and quality operators as named queries over the derived tables.

The change sets are themselves computed from the test tables, so they grow
with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frames import union_all
from ..operators import changes, quality
from ..sources.constraints import PRIMARY_KEYS
from ..sources.derive import ORDERS_AS_OF
from ..sources.tables import Tables
from . import seeded
from .queries import Query

PAIR = ["profile_id", "content_id"]


def _watch_ratings(T: Tables) -> DataFrame:
    """A vote for every title a profile finished, by how often it did."""
    seen = T["watch_history"].filter("completed").groupBy(*PAIR).agg(
        F.count("*").alias("n"), F.max("watched_at").alias("updated_at")
    )
    return seen.select(
        F.concat_ws("-", F.lit("w"), *[F.col(c).cast("string") for c in PAIR]).alias("rating_id"),
        *PAIR,
        (F.col("n") % 5 + 1).cast("smallint").alias("rating_value"),
        F.lit("seen").alias("review_text"),
        "updated_at",
    )


def upsert_ratings(T: Tables, bulk: bool = True) -> DataFrame:
    votes = T["ratings"].select("rating_id", *PAIR, "rating_value", "review_text", "updated_at")
    return changes.merge_upsert(
        votes, _watch_ratings(T), PAIR, ["rating_value", "review_text"], ORDERS_AS_OF, bulk=bulk
    ).snapshot


def ignore_listed(T: Tables) -> DataFrame:
    started = T["watch_history"].filter("not completed").select(
        F.concat(F.lit("n-"), "watch_id").alias("my_list_id"), *PAIR, F.col("watched_at").alias("added_at")
    )
    order = [F.asc("added_at"), F.asc("my_list_id")]
    return changes.insert_ignore(T["my_list"], started, PAIR, order=order, bulk=True).snapshot


def ignore_active_downloads(T: Tables) -> DataFrame:
    """Downloads started again; only active ones of a movie compete for their key."""
    again = T["downloads"].filter("episode_id is null").withColumns(
        {
            "download_id": F.concat(F.lit("again-"), "download_id"),
            "download_status": F.when(F.col("download_status") == "Expired", "Active").otherwise("Deleted"),
        }
    )
    return changes.insert_ignore(
        T["downloads"],
        again,
        ["profile_id", "content_id", "device_id"],
        where="download_status = 'Active' and episode_id is null",
        order=[F.asc("downloaded_at"), F.asc("download_id")],
    ).changed


def split_reviews(T: Tables) -> DataFrame:
    votes = T["ratings"].select("rating_id", "review_text")
    split = changes.append_valid(votes, "length(trim(review_text)) > 0")
    return split.ok.withColumn("accepted", F.lit(True)).unionByName(
        split.rejected.withColumn("accepted", F.lit(False))
    )


LEVEL = [*PAIR, "season_id", "episode_id", "part_id"]


def upsert_levels(T: Tables) -> DataFrame:
    """Votes on titles and episodes as a whole key in which no season, episode or part equals none."""
    votes = T["ratings"].select("rating_id", *LEVEL, "is_liked", "updated_at")
    seen = T["watch_history"].filter("completed").groupBy(*PAIR, "episode_id").agg(
        F.count("*").alias("n"), F.max("watched_at").alias("updated_at")
    )
    none = F.lit(None).cast("bigint")
    new = seen.select(
        F.concat_ws("-", F.lit("w"), *[F.col(c).cast("string") for c in (*PAIR, "episode_id")]).alias("rating_id"),
        *PAIR, none.alias("season_id"), "episode_id", none.alias("part_id"), (F.col("n") % 2 == 0).alias("is_liked"), "updated_at",
    )
    return changes.merge_upsert(votes, new, LEVEL, ["is_liked"], ORDERS_AS_OF, null_safe=True).snapshot


def ignore_known_actors(T: Tables) -> DataFrame:
    """Actors of the same name and date of birth, or both without one, are known."""
    actors = T["actors"].select("actor_id", "actor_name", "date_of_birth")
    again = actors.filter("actor_id % 2 = 0").select((-F.col("actor_id") - 1).alias("actor_id"), "actor_name", "date_of_birth")
    roles = T["content_cast"].select(F.col("character_name").alias("actor_name"))
    new = again.unionByName(roles, allowMissingColumns=True)
    return changes.insert_ignore(actors, new, ["actor_name", "date_of_birth"], null_safe=True).snapshot


def guarded_rows(T: Tables) -> DataFrame:
    """Rows of three tables, some spoilt, and whether the guards let them in."""
    n, out = F.col("search_id"), []
    spoilt = {
        "search_history": (T["search_history"].withColumn("search_query", F.when(n % 7 == 0, "  ").when(n % 7 != 1, F.col("search_query"))), "search_id"),
        "watch_history": (T["watch_history"].withColumn("progress_seconds", F.col("progress_seconds") - 600), "watch_id"),
        "content": (T["content"].withColumn("duration_minutes", F.when(F.col("content_id") % 2 == 0, F.col("content_id"))), "content_id"),
    }
    for table, (rows, id_) in spoilt.items():
        split = changes.append_valid(rows, changes.LOG_GUARDS[table])
        for part, accepted in ((split.ok, True), (split.rejected, False)):
            out.append(part.select(F.lit(table).alias("table"), F.col(id_).cast("string").alias("id"), F.lit(accepted).alias("accepted")))
    return union_all(out)


def signups(T: Tables) -> DataFrame:
    """Accounts that follow shop events; which one gets which id depends on the engine."""
    new = T["search_history"].select(
        F.concat(F.lit("s"), F.col("search_id").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit("x").alias("password_hash"),
        F.col("search_query").alias("full_name"),
        F.lit(dt.date(1990, 1, 1)).alias("date_of_birth"),
        F.lit("IN").alias("country_code"),
    )
    added = changes.insert_rows(T["users"], new, "users", ["email"], dt.datetime(2024, 1, 31)).changed
    return added.groupBy("account_status", "email_verified", "created_at").agg(
        F.count("*").alias("rows"),
        F.countDistinct("user_id").alias("ids"),
        F.min("user_id").alias("first_id"),
        F.max("user_id").alias("last_id"),
    )


def _sequels(T: Tables) -> Tables:
    """A sequel of every film with genres and tracks."""
    sequels = T["content"].filter("content_type = 'Movie'").select(
        F.concat_ws(" ", "title", F.col("content_id").cast("string")).alias("title"),
        "content_type",
        F.array(F.col("content_id") % 11 + 1, F.col("content_id") % 3 + 1).alias("genre_ids"),
        F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")).alias("language_ids"),
        F.array(F.lit("Audio"), F.lit("Subtitle")).alias("language_types"),
        F.array(F.lit(True), F.lit(False)).alias("is_default"),
    )
    return changes.create_titles(T, sequels, ["title"], dt.datetime(2024, 1, 31))


def new_titles(T: Tables) -> DataFrame:
    """The sequels, counted with what they hang on."""
    after = _sequels(T)
    new = after["content"].filter("title rlike '[0-9]$'").select("content_id")
    new_genres = after["content_genres"].join(new, "content_id", "left_semi").groupBy("genre_id")
    return new_genres.agg(F.count("*").alias("titles"))


def new_title_rows(T: Tables) -> DataFrame:
    """Every genre and track of the sequels under its title; which title gets which id depends on the engine."""
    after = _sequels(T)
    new = after["content"].filter("title rlike '[0-9]$'").select("content_id", "title")
    genres = after["content_genres"].join(new, "content_id").select("title", F.lit("genre").alias("kind"), F.col("genre_id").alias("child"))
    tracks = after["content_languages"].join(new, "content_id").select(
        "title", F.lit("track").alias("kind"), F.col("language_id").alias("child"), "language_type", "is_default"
    )
    return tracks.unionByName(genres, allowMissingColumns=True)


def new_title_ids(T: Tables) -> DataFrame:
    """New ids follow the highest old one without a gap, in both tables that get any."""
    after, out = _sequels(T), []
    for table, id_ in (("content", "content_id"), ("content_languages", "content_language_id")):
        new = after[table].join(T[table].select(id_), id_, "left_anti")
        out.append(
            new.agg(F.count("*").alias("rows"), F.countDistinct(id_).alias("ids"), F.min(id_).alias("first_id"), F.max(id_).alias("last_id"))
            .select(F.lit(table).alias("table"), "rows", "ids", "first_id", "last_id")
        )
    return union_all(out)


def guest_profiles(T: Tables) -> DataFrame:
    """A further profile of every account, with the preferences that it starts with."""
    new = T["users"].select("user_id", F.concat_ws(" ", F.lit("guest of"), F.col("user_id").cast("string")).alias("profile_name"))
    after = changes.create_profiles(T, new, ["user_id"], dt.datetime(2024, 1, 31))
    guests = after["profiles"].filter("profile_name like 'guest of %'")
    likes = after["profile_preferences"].select("profile_id", "audio_language", "default_quality", "ui_theme")
    return guests.join(likes, "profile_id").select(
        "user_id", "profile_name", "is_kids", "is_primary", "audio_language", "default_quality", "ui_theme"
    )

def launch_windows(T: Tables) -> DataFrame:
    """Every released title's window in several countries at once."""
    rows = T["content"].filter(F.col("release_date").isNotNull()).select(
        "content_id",
        F.col("release_date").alias("available_from"),
        F.array(F.lit("us"), F.lit("in"), F.lit("gb")).alias("countries"),
    )
    out = changes.expand_insert(rows, {"countries": "country_code"})
    return out.withColumn("country_code", F.upper("country_code"))


def replace_genres(T: Tables) -> changes.Change:
    """Kids profiles get the genres of their watched titles; unknown ones are left out."""
    kids = T["profiles"].filter("is_kids").select("profile_id")
    watched = T["watch_history"].select(*PAIR).distinct().join(T["content_genres"], "content_id")
    new = watched.select("profile_id", "genre_id").unionByName(
        kids.withColumn("genre_id", F.col("profile_id") % 11 + 90)
    )
    return changes.replace_children(T["profile_preferred_genres"], kids, new, T["genres"], "genre_id")


def toggle_list(T: Tables) -> changes.Change:
    pairs = T["downloads"].groupBy(*PAIR).agg(F.min("downloaded_at").alias("added_at"))
    return changes.toggle(T["my_list"], pairs, PAIR)


def finish_sessions(T: Tables) -> DataFrame:
    """Sessions past half their length are played to the end, those shorter than ten minutes once more as long."""
    half = F.col("progress_seconds") * 2 > F.col("watch_duration_seconds")
    longer = F.col("watch_duration_seconds") < 600
    sessions = T["watch_history"].filter((half | longer) & ~F.col("completed")).select(
        "watch_id",
        F.when(half, F.col("watch_duration_seconds")).alias("progress_seconds"),
        F.when(longer, F.col("watch_duration_seconds") * 2).alias("watch_duration_seconds"),
        F.when(half, F.lit(True)).alias("completed"),
    )
    return changes.record_progress(T["watch_history"], sessions).changed


def ping_downloading_devices(T: Tables) -> DataFrame:
    seen = T["downloads"].select("device_id", F.col("downloaded_at").alias("seen_at"))
    return changes.ping_devices(T["user_devices"], seen).snapshot


def kids_preferences(T: Tables) -> DataFrame:
    """Kids profiles get a bright theme; those with an odd id keep their quality."""
    new = T["profiles"].filter("is_kids").select(
        "profile_id",
        F.lit("light").alias("ui_theme"),
        F.when(F.col("profile_id") % 2 == 0, F.lit("low")).alias("default_quality"),
    )
    return changes.patch(T["profile_preferences"], new, ["profile_id"]).snapshot


def patch_content(T: Tables) -> DataFrame:
    """Titles take the first role name as description and, for some, a new trailer."""
    roles = T["content_cast"].filter("is_main_cast").groupBy("content_id").agg(
        F.min("character_name").alias("description"),
        F.max(F.when(F.col("cast_order").isNull(), F.lit("trailer/new"))).alias("trailer_url"),
    )
    return changes.patch(T["content"], roles, ["content_id"], ORDERS_AS_OF).snapshot


def cancel_off_renewal(T: Tables) -> DataFrame:
    return changes.cancel(T["subscriptions"], "not auto_renew", "not renewed", ORDERS_AS_OF).snapshot


def _incoming_payments(T: Tables) -> DataFrame:
    """One payment per search and one more per tenth, some sent twice or refused."""
    n = F.col("search_id")
    return T["search_history"].select(
        F.concat(F.lit("p-"), n.cast("string")).alias("payment_id"),
        (n + 1).alias("subscription_id"),
        F.concat(F.lit("tx-"), F.floor(n / 2).cast("string")).alias("transaction_id"),
        F.when(F.col("result_count") > 0, "completed").otherwise("failed").alias("payment_status"),
    )


def bill_subscriptions(T: Tables) -> DataFrame:
    columns = ["payment_id", "subscription_id", "transaction_id", "payment_status"]
    done = changes.apply_payments(T["payments"].select(*columns), T["subscriptions"], _incoming_payments(T))
    return done.subscriptions.snapshot


def refund_wallets(T: Tables) -> DataFrame:
    """Refund wallet payments: those without earlier refund twice over, others half."""
    asked = F.when(F.col("refund_amount") == 0, F.col("amount") * 2).otherwise(F.col("amount") / 2)
    refunds = T["payments"].filter("payment_method = 'paypal'").select(
        "payment_id", asked.cast("decimal(10,2)").alias("refund_amount")
    )
    return changes.refund(T["payments"], refunds, ORDERS_AS_OF).snapshot


def last_profile_primary(T: Tables) -> DataFrame:
    chosen = T["profiles"].filter("not is_kids").groupBy("user_id").agg(F.max("profile_id").alias("profile_id"))
    return changes.set_exclusive(T["profiles"], ["user_id"], "profile_id", "is_primary", chosen).snapshot


def upgrade_plans(T: Tables) -> DataFrame:
    """Users who finished a title move to a bigger plan; the new ids depend on the engine."""
    moving = (
        T["profiles"]
        .join(T["watch_history"].filter("completed").select("profile_id"), "profile_id", "left_semi")
        .select("user_id")
        .distinct()
        .withColumns({"plan_id": F.lit(3), "billing_cycle": F.lit("monthly")})
    )
    after = changes.change_plan(T["subscriptions"], moving, ORDERS_AS_OF).snapshot
    return after.select("user_id", "plan_id", "status", "billing_cycle", "start_date", "end_date", "next_billing_date")


def _sizes(T: Tables, names: list[str]) -> DataFrame:
    return union_all(
        [T[name].agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name in names]
    )


def delete_inactive_titles(T: Tables) -> DataFrame:
    """Rows left in every table that hangs on titles."""
    gone = T["content"].filter("status = 'Inactive'").select("content_id")
    after = changes.delete_cascade(T, "content", gone).tables
    below = ["content", "seasons", "episodes", "content_parts", "content_genres", "content_languages",
             "content_cast", "content_availability", "ratings", "watch_history", "my_list", "downloads"]
    return _sizes(after, below)


def _rows_left(T: Tables, names: list[str]) -> DataFrame:
    """The keys of all rows of some tables."""
    each = []
    for name in names:
        key = [F.col(c).cast("string") for c in PRIMARY_KEYS[name]]
        each.append(T[name].select(F.lit(name).alias("table"), F.concat_ws("-", *key).alias("id")))
    return union_all(each)


def delete_inactive_rows(T: Tables) -> DataFrame:
    """Which rows are left in the tables below titles, by their keys."""
    gone = T["content"].filter("status = 'Inactive'").select("content_id")
    after = changes.delete_cascade(T, "content", gone).tables
    return _rows_left(after, ["content", "seasons", "episodes", "content_parts", "content_genres", "content_languages",
                              "content_cast", "content_availability", "ratings", "watch_history", "my_list", "downloads"])


def delete_kids_profiles(T: Tables) -> DataFrame:
    """What is left once kids profiles are gone; an account's primary profile stays."""
    after = changes.delete_profiles(T, T["profiles"].filter("is_kids").select("profile_id")).tables
    return _rows_left(after, ["profiles", "ratings", "watch_history", "my_list", "downloads", "search_history",
                              "profile_preferences", "profile_preferred_genres"])


def delete_devices(T: Tables) -> DataFrame:
    """Devices of every third account and the downloads on them."""
    gone = T["user_devices"].filter("user_id % 3 = 0").select("device_id")
    return _rows_left(changes.delete_cascade(T, "user_devices", gone).tables, ["user_devices", "downloads"])


def delete_pending_users(T: Tables) -> DataFrame:
    """References that forbid deleting accounts that were never activated."""
    gone = T["users"].filter("account_status = 'pending'").select("user_id")
    return changes.delete_cascade(T, "users", gone).blocked


def delete_episodes(T: Tables) -> DataFrame:
    """Sessions once every third episode is gone: they stay and lose their reference."""
    gone = T["episodes"].filter("episode_id % 3 = 0").select("episode_id")
    return changes.delete_cascade(T, "episodes", gone).tables["watch_history"]


def clear_history(T: Tables) -> DataFrame:
    users = T["users"].filter("account_status = 'suspended'").select("user_id")
    profiles = T["profiles"].join(users, "user_id", "left_semi").select("profile_id")
    return changes.delete_keys(T["watch_history"], profiles).snapshot


def quality_rules(kind: str) -> list[quality.Rule]:
    """Rules of both generations, since the derived tables carry both."""
    newer = quality.rules(2, kind)
    return newer + [rule for rule in quality.rules(1, kind) if rule not in newer]


def check(kind: str) -> Query:
    return lambda T: quality.validate(T, quality_rules(kind))


def seeded_check(kind: str) -> Query:
    """The same rules where every one has columns and violations."""
    return lambda T: quality.validate(seeded.seeded(T), quality_rules(kind))


def shipping_windows(T: Tables) -> Tables:
    """Many overlapping windows, taken from what was shipped when."""
    ship = F.col("l_shipdate").cast("date")
    rows = T["lines"].select(
        F.col("id").alias("availability_id"),
        "content_id",
        F.col("l_returnflag").alias("country_code"),
        ship.alias("available_from"),
        F.when(F.col("l_quantity") < 50, F.date_add(ship, (F.col("l_quantity") - 1).cast("int"))).alias("available_to"),
    )
    return T.replace(content_availability=rows)


#: Kinds of rules that are checked on seeded tables as well.
SEEDED = ("v1", "v2", "v3", "v4", "v5", "v6", "v7", "v8")

CHANGES: dict[str, Query] = {
    "d01_merge_upsert": upsert_ratings,
    "d01_merge_upsert_null_safe": upsert_levels,
    "d01_merge_upsert_small": lambda T: upsert_ratings(T, bulk=False),
    "d02_insert_ignore": ignore_listed,
    "d02_insert_ignore_partial": ignore_active_downloads,
    "d02_insert_ignore_null_safe": ignore_known_actors,
    "d03_append_valid": split_reviews,
    "d03_guarded_rows": guarded_rows,
    "d04_insert_rows": signups,
    "d05_create_titles": new_titles,
    "d05_title_rows": new_title_rows,
    "d05_title_ids": new_title_ids,
    "d05_create_profiles": guest_profiles,
    "d05_expand_insert": launch_windows,
    "d06_replace_children": lambda T: replace_genres(T).snapshot,
    "d06_replaced_rows": lambda T: replace_genres(T).signed(),
    "d07_toggle": lambda T: toggle_list(T).snapshot,
    "d07_toggled_rows": lambda T: toggle_list(T).signed(),
    "d08_expire_downloads": lambda T: changes.expire_downloads(T["downloads"], ORDERS_AS_OF).snapshot,
    "d08_cancel": cancel_off_renewal,
    "d08_patch": patch_content,
    "d08_verify_email": lambda T: changes.verify_email(T["users"], "user_id % 2 = 0", ORDERS_AS_OF).snapshot,
    "d08_pause": lambda T: changes.set_status(T["subscriptions"], "auto_renew", "active", "paused", ORDERS_AS_OF).snapshot,
    "d08_resume": lambda T: changes.resume(T["subscriptions"], "user_id % 2 = 0", ORDERS_AS_OF).changed,
    "d08_retire": lambda T: changes.set_status(T["content"], "release_date is null", None, "Inactive", ORDERS_AS_OF).changed,
    "d08_reinstate": lambda T: changes.set_status(T["content"], "content_id % 2 = 0", "Inactive", "Active", ORDERS_AS_OF).changed,
    "d08_remove_downloads": lambda T: changes.remove_downloads(T["downloads"], "device_id % 2 = 0").snapshot,
    "d08_record_progress": finish_sessions,
    "d08_close_windows": lambda T: changes.close_windows(T["content_availability"], "country_code = 'US'", ORDERS_AS_OF).changed,
    "d08_ping_devices": ping_downloading_devices,
    "d08_set_ceiling": lambda T: changes.set_ceiling(T["profiles"], "user_id % 2 = 0", "PG", ORDERS_AS_OF).snapshot,
    "d08_preferences": kids_preferences,
    "d09_renew": lambda T: changes.renew(T["subscriptions"], dt.date(2001, 8, 30), by_cycle=True).snapshot,
    "d09_renew_monthly": lambda T: changes.renew(T["subscriptions"], dt.date(2001, 8, 30)).changed,
    "d09_apply_payments": bill_subscriptions,
    "d10_refund": refund_wallets,
    "d11_set_exclusive": last_profile_primary,
    "d12_change_plan": upgrade_plans,
    "d13_delete_cascade": delete_inactive_titles,
    "d13_rows_left": delete_inactive_rows,
    "d13_delete_profiles": delete_kids_profiles,
    "d13_delete_devices": delete_devices,
    "d13_delete_blocked": delete_pending_users,
    "d13_set_null": delete_episodes,
    "d14_delete_where": lambda T: changes.delete_where(T["search_history"], "result_count = 0").changed,
    "d14_delete_keys": clear_history,
    **{f"{kind}_rules": check(kind) for kind in quality.KINDS},
    **{f"{kind}_seeded": seeded_check(kind) for kind in SEEDED},
    "v9_overlaps": lambda T: quality.validate(shipping_windows(T), quality.overlap_rules()),
    "v9_overlapping_rows": lambda T: quality.violations(shipping_windows(T), quality.overlap_rules()[0]),
    "v10_profiles_over_limit": lambda T: quality.violations(
        T, next(r for r in quality.application_rules() if r.name == "profiles_within_plan")
    ),
}

