"""Keys, references and value rules of the platform tables, as data.

The first generation is described by what differs.  Expressions are Spark SQL
and are true for valid rows; a NULL result passes, as it does for a CHECK.
"""

from __future__ import annotations

from typing import NamedTuple

from . import schemas

# Primary keys.
PRIMARY_KEYS = {
    "genres": ["genre_id"],
    "languages": ["language_id"],
    "actors": ["actor_id"],
    "content": ["content_id"],
    "seasons": ["season_id"],
    "episodes": ["episode_id"],
    "content_parts": ["part_id"],
    "content_genres": ["content_id", "genre_id"],
    "content_languages": ["content_language_id"],
    "content_cast": ["cast_id"],
    "content_availability": ["availability_id"],
    "users": ["user_id"],
    "profiles": ["profile_id"],
    "subscription_plans": ["plan_id"],
    "plan_allowed_devices": ["plan_id", "device_type"],
    "subscriptions": ["subscription_id"],
    "payments": ["payment_id"],
    "user_devices": ["device_id"],
    "ratings": ["rating_id"],
    "watch_history": ["watch_id"],
    "my_list": ["my_list_id"],
    "downloads": ["download_id"],
    "search_history": ["search_id"],
    "profile_preferences": ["preference_id"],
    "profile_preferred_genres": ["profile_id", "genre_id"],
    "content_rating_levels": ["rating_code"],
}

# Further unique keys; rows with a NULL in one never collide.
UNIQUE_KEYS = {
    "genres": [["genre_name"]],
    "languages": [["language_name"], ["language_code"]],
    "seasons": [["content_id", "season_number"]],
    "episodes": [["season_id", "episode_number"]],
    "content_parts": [["content_id", "part_number"]],
    "content_languages": [["content_id", "language_id", "language_type"]],
    "content_cast": [["content_id", "actor_id", "character_name"]],
    "users": [["email"], ["phone_number"]],
    "subscription_plans": [["plan_name"]],
    "payments": [["transaction_id"]],
    "my_list": [["profile_id", "content_id"]],
    "profile_preferences": [["profile_id"]],
}
UNIQUE_KEYS_GEN1 = {
    "content_rating_levels": [["sort_order"]],
    "user_devices": [["user_id", "device_fingerprint"]],
    "ratings": [["profile_id", "content_id"]],
}

# Keys that are unique among the rows of one state.
PARTIAL_UNIQUE = {
    "content_languages": [(["content_id", "language_type"], "is_default")],
    "profiles": [(["user_id"], "is_primary")],
    "subscriptions": [(["user_id"], "status = 'active'")],
    "downloads": [
        (
            ["profile_id", "content_id", "episode_id", "device_id"],
            "download_status = 'Active' and episode_id is not null",
        ),
        (["profile_id", "content_id", "device_id"], "download_status = 'Active' and episode_id is null"),
    ],
}
PARTIAL_UNIQUE_GEN2 = {
    "ratings": [
        (["profile_id", "content_id"], "season_id is null and episode_id is null and part_id is null"),
        (["profile_id", "content_id", "season_id"], "season_id is not null and episode_id is null"),
        (["profile_id", "content_id", "season_id", "episode_id"], "episode_id is not null"),
        (["profile_id", "content_id", "part_id"], "part_id is not null"),
    ]
}


class ForeignKey(NamedTuple):
    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str


CASCADE, SET_NULL, RESTRICT = "cascade", "set null", "restrict"

# References as child.column -> parent.column, by what a delete of the parent does.
_REFERENCES = {
    CASCADE: """
        seasons.content_id content.content_id
        episodes.season_id seasons.season_id
        content_parts.content_id content.content_id
        content_genres.content_id content.content_id
        content_genres.genre_id genres.genre_id
        content_languages.content_id content.content_id
        content_cast.content_id content.content_id
        content_availability.content_id content.content_id
        profiles.user_id users.user_id
        plan_allowed_devices.plan_id subscription_plans.plan_id
        user_devices.user_id users.user_id
        ratings.profile_id profiles.profile_id
        ratings.content_id content.content_id
        ratings.season_id seasons.season_id
        ratings.episode_id episodes.episode_id
        ratings.part_id content_parts.part_id
        watch_history.profile_id profiles.profile_id
        watch_history.content_id content.content_id
        my_list.profile_id profiles.profile_id
        my_list.content_id content.content_id
        downloads.profile_id profiles.profile_id
        downloads.content_id content.content_id
        downloads.device_id user_devices.device_id
        search_history.profile_id profiles.profile_id
        profile_preferences.profile_id profiles.profile_id
        profile_preferred_genres.profile_id profiles.profile_id
        profile_preferred_genres.genre_id genres.genre_id
    """,
    RESTRICT: """
        content_languages.language_id languages.language_id
        content_cast.actor_id actors.actor_id
        subscriptions.user_id users.user_id
        subscriptions.plan_id subscription_plans.plan_id
        payments.subscription_id subscriptions.subscription_id
        payments.user_id users.user_id
    """,
    SET_NULL: """
        watch_history.episode_id episodes.episode_id
        downloads.episode_id episodes.episode_id
        search_history.device_id user_devices.device_id
    """,
}
_REFERENCES_GEN1 = {
    SET_NULL: """
        content.age_certification content_rating_levels.rating_code
        profiles.age_rating_limit content_rating_levels.rating_code
    """,
}


def _parse(references: dict[str, str]) -> list[ForeignKey]:
    out = []
    for action, lines in references.items():
        for line in lines.split("\n"):
            if line.strip():
                (child, column), (parent, key) = (end.split(".") for end in line.split())
                out.append(ForeignKey(child, column, parent, key, action))
    return out


def foreign_keys(gen: int = 2) -> list[ForeignKey]:
    everything = _parse(_REFERENCES) + (_parse(_REFERENCES_GEN1) if gen == 1 else [])
    return [
        fk
        for fk in everything
        if fk.child in schemas.tables(gen)
        and fk.parent in schemas.tables(gen)
        and fk.column in schemas.schema(fk.child, gen).names
    ]


# Allowed values of a column.
_DEVICES = ["smartphone", "tablet", "smart_tv", "laptop", "desktop", "game_console"]
DOMAINS = {
    "content": {"content_type": ["Movie", "Series"], "status": ["Active", "Inactive", "ComingSoon"]},
    "content_languages": {"language_type": ["Audio", "Subtitle", "Both"]},
    "users": {"account_status": ["active", "suspended", "pending"]},
    "subscription_plans": {"video_quality": ["SD", "HD", "Full HD", "4K Ultra HD"]},
    "plan_allowed_devices": {"device_type": _DEVICES},
    "subscriptions": {
        "status": ["active", "paused", "cancelled", "expired"],
        "billing_cycle": ["monthly", "yearly"],
    },
    "payments": {
        "payment_method": ["credit_card", "debit_card", "paypal", "upi", "gift_card"],
        "payment_status": ["pending", "completed", "failed", "refunded", "chargeback"],
    },
    "user_devices": {"device_type": _DEVICES},
    "downloads": {"download_status": ["Active", "Expired", "Deleted"]},
    "profile_preferences": {
        "default_quality": ["auto", "low", "medium", "high", "ultra"],
        "ui_theme": ["dark", "light", "system"],
    },
    "content_rating_levels": {"rating_system": ["Movie", "TV"]},
}

# Numeric ranges.
RANGES = {
    "content": ["duration_minutes > 0"],
    "seasons": ["season_number > 0"],
    "episodes": ["episode_number > 0", "duration_minutes > 0"],
    "content_parts": ["part_number > 0", "duration_minutes > 0"],
    "subscription_plans": [
        "price_monthly > 0",
        "price_yearly > 0",
        "max_screens >= 1",
        "max_profiles >= 1",
        "max_downloads >= 0",
    ],
    "subscriptions": ["discount_pct between 0 and 100"],
    "payments": ["amount > 0", "refund_amount >= 0"],
    "ratings": ["rating_value between 1 and 5"],
    "watch_history": ["watch_duration_seconds >= 0", "progress_seconds >= 0"],
    "downloads": ["file_size_mb > 0"],
    "search_history": ["result_count >= 0"],
}

# Rules between columns of one row.
ROW_RULES = {
    "content": {"series_without_duration": "(content_type = 'Series' and duration_minutes is null) or content_type = 'Movie'"},
    "content_availability": {"window_order": "available_to > available_from"},
    "subscriptions": {
        "billing_date_while_running": "(status in ('active', 'paused') and next_billing_date is not null) "
        "or (status in ('cancelled', 'expired') and next_billing_date is null)",
        "end_after_start": "end_date > start_date",
    },
    "payments": {
        "refund_within_amount": "refund_amount <= amount",
        "card_or_upi": "coalesce(card_last4, card_brand) is null or coalesce(upi_id, upi_app) is null",
    },
    "ratings": {
        "episode_needs_season": "episode_id is null or season_id is not null",
        "part_stands_alone": "part_id is null or coalesce(season_id, episode_id) is null",
    },
}
