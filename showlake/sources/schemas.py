"""Column types, defaults and length limits of the platform tables.

Two generations share most tables.  ``GEN2`` is the base; ``GEN1`` lists what
differs.  Types are Spark DDL, so ``schema()`` is a plain ``StructType``.
"""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructField, StructType

_AUDIT = "created_at timestamp_ntz not null, updated_at timestamp_ntz not null"

# Column names and types of the data model.
GEN2 = {
    "genres": "genre_id bigint not null, genre_name string not null, description string",
    "languages": "language_id bigint not null, language_name string not null, language_code string not null",
    "actors": (
        "actor_id bigint not null, actor_name string not null, date_of_birth date, gender string, "
        "nationality string, bio string, photo_url string"
    ),
    "content": (
        "content_id bigint not null, title string not null, description string, content_type string not null, "
        "content_category string, release_date date, duration_minutes int, poster_url string, "
        f"trailer_url string, status string not null, {_AUDIT}"
    ),
    "seasons": (
        "season_id bigint not null, content_id bigint not null, season_number int not null, title string, "
        f"description string, release_date date, {_AUDIT}"
    ),
    "episodes": (
        "episode_id bigint not null, season_id bigint not null, episode_number int not null, "
        "title string not null, description string, duration_minutes int, release_date date, "
        f"video_url string, thumbnail_url string, {_AUDIT}"
    ),
    "content_parts": (
        "part_id bigint not null, content_id bigint not null, part_number int not null, title string not null, "
        "description string, duration_minutes int, release_date date, video_url string, thumbnail_url string, "
        f"{_AUDIT}"
    ),
    "content_genres": "content_id bigint not null, genre_id bigint not null",
    "content_languages": (
        "content_language_id bigint not null, content_id bigint not null, language_id bigint not null, "
        "language_type string not null, is_default boolean not null"
    ),
    "content_cast": (
        "cast_id bigint not null, content_id bigint not null, actor_id bigint not null, "
        "character_name string not null, cast_order int, is_main_cast boolean not null"
    ),
    "content_availability": (
        "availability_id bigint not null, content_id bigint not null, country_code string not null, "
        "available_from date not null, available_to date, region_notes string"
    ),
    "users": (
        "user_id bigint not null, email string not null, password_hash string not null, "
        "full_name string not null, phone_number string, date_of_birth date not null, "
        "country_code string not null, account_status string not null, email_verified boolean not null, "
        f"avatar_url string, {_AUDIT}"
    ),
    "profiles": (
        "profile_id bigint not null, user_id bigint not null, profile_name string not null, avatar_url string, "
        f"is_kids boolean not null, is_primary boolean not null, {_AUDIT}"
    ),
    "subscription_plans": (
        "plan_id int not null, plan_name string not null, price_monthly decimal(8,2) not null, "
        "price_yearly decimal(8,2), currency string not null, max_screens smallint not null, "
        "max_profiles smallint not null, video_quality string not null, hdr_support boolean not null, "
        "dolby_atmos boolean not null, max_downloads int not null, ads_supported boolean not null, "
        f"is_active boolean not null, {_AUDIT}"
    ),
    "plan_allowed_devices": "plan_id int not null, device_type string not null",
    "subscriptions": (
        "subscription_id bigint not null, user_id bigint not null, plan_id int not null, status string not null, "
        "billing_cycle string not null, start_date date not null, end_date date, next_billing_date date, "
        "auto_renew boolean not null, cancelled_at timestamp_ntz, cancellation_reason string, "
        f"{_AUDIT}"
    ),
    "payments": (
        "payment_id bigint not null, subscription_id bigint not null, user_id bigint not null, "
        "amount decimal(10,2) not null, currency string not null, payment_method string not null, "
        "payment_status string not null, transaction_id string, gateway_name string not null, "
        "gateway_response string, card_last4 string, card_brand string, upi_id string, upi_app string, "
        "billing_address string, invoice_url string, refund_amount decimal(10,2) not null, "
        "refunded_at timestamp_ntz, paid_at timestamp_ntz, created_at timestamp_ntz not null"
    ),
    "user_devices": (
        "device_id bigint not null, user_id bigint not null, os_type string, device_type string not null, "
        "last_active_at timestamp_ntz"
    ),
    "ratings": (
        "rating_id bigint not null, profile_id bigint not null, content_id bigint not null, season_id bigint, "
        f"episode_id bigint, part_id bigint, is_liked boolean not null, review_text string, {_AUDIT}"
    ),
    "watch_history": (
        "watch_id bigint not null, profile_id bigint not null, content_id bigint not null, episode_id bigint, "
        "watched_at timestamp_ntz not null, watch_duration_seconds int not null, "
        "progress_seconds int not null, completed boolean not null"
    ),
    "my_list": (
        "my_list_id bigint not null, profile_id bigint not null, content_id bigint not null, "
        "added_at timestamp_ntz not null"
    ),
    "downloads": (
        "download_id bigint not null, profile_id bigint not null, content_id bigint not null, episode_id bigint, "
        "device_id bigint not null, downloaded_at timestamp_ntz not null, expiry_date date, "
        "file_size_mb decimal(10,2) not null, download_status string not null"
    ),
    "search_history": (
        "search_id bigint not null, profile_id bigint not null, search_query string not null, "
        "searched_at timestamp_ntz not null, result_count int not null, device_id bigint"
    ),
    "profile_preferences": (
        "preference_id bigint not null, profile_id bigint not null, audio_language string not null, "
        "default_quality string not null, notifications_on boolean not null, "
        "new_releases_notif boolean not null, continue_watching boolean not null, ui_theme string not null, "
        "language string not null, autoplay_next boolean not null, autoplay_previews boolean not null, "
        f"{_AUDIT}"
    ),
    "profile_preferred_genres": "profile_id bigint not null, genre_id bigint not null",
}

# What the first generation adds to or drops from a table.
GEN1_ADDS = {
    "content": "age_certification string",
    "users": "preferred_lang string not null, last_login_at timestamp_ntz, deleted_at timestamp_ntz",
    "profiles": (
        "age_rating_limit string, pin_hash string, language string not null, "
        "autoplay_next boolean not null, autoplay_previews boolean not null"
    ),
    "subscriptions": "trial_end_date date, promo_code string, discount_pct decimal(5,2) not null",
    "user_devices": (
        "device_name string not null, os_name string not null, os_version string, app_version string, "
        "browser string, browser_version string, device_fingerprint string not null, push_token string, "
        "is_trusted boolean not null, is_active boolean not null, ip_address string, "
        "registered_at timestamp_ntz not null"
    ),
    "ratings": "rating_value smallint not null",
    "profile_preferences": "data_saver_mode boolean not null",
    "content_rating_levels": (
        "rating_code string not null, rating_system string not null, sort_order smallint not null, "
        "description string"
    ),
}
GEN1_DROPS = {
    "content": ["content_category"],
    "payments": ["upi_id", "upi_app"],
    "user_devices": ["os_type"],
    "ratings": ["season_id", "episode_id", "part_id", "is_liked"],
    "profile_preferences": ["language", "autoplay_next", "autoplay_previews"],
}
GEN1_ABSENT = {"content_parts", "plan_allowed_devices"}

# Column defaults.  NOW stands for the moment of the write.
NOW = object()
DEFAULTS = {
    "content": {"status": "Active", "created_at": NOW, "updated_at": NOW},
    "seasons": {"created_at": NOW, "updated_at": NOW},
    "episodes": {"created_at": NOW, "updated_at": NOW},
    "content_parts": {"created_at": NOW, "updated_at": NOW},
    "content_languages": {"is_default": False},
    "content_cast": {"is_main_cast": False},
    "users": {
        "account_status": "pending",
        "email_verified": False,
        "preferred_lang": "en",
        "created_at": NOW,
        "updated_at": NOW,
    },
    "profiles": {
        "is_kids": False,
        "is_primary": False,
        "language": "en",
        "autoplay_next": True,
        "autoplay_previews": True,
        "created_at": NOW,
        "updated_at": NOW,
    },
    "subscription_plans": {
        "currency": "USD",
        "hdr_support": False,
        "dolby_atmos": False,
        "max_downloads": 0,
        "ads_supported": False,
        "is_active": True,
        "created_at": NOW,
        "updated_at": NOW,
    },
    "subscriptions": {"auto_renew": True, "discount_pct": 0, "created_at": NOW, "updated_at": NOW},
    "payments": {"currency": "USD", "refund_amount": 0, "created_at": NOW},
    "user_devices": {"is_trusted": False, "is_active": True, "registered_at": NOW},
    "ratings": {"created_at": NOW, "updated_at": NOW},
    "watch_history": {
        "watched_at": NOW,
        "watch_duration_seconds": 0,
        "progress_seconds": 0,
        "completed": False,
    },
    "my_list": {"added_at": NOW},
    "downloads": {"downloaded_at": NOW},
    "search_history": {"searched_at": NOW, "result_count": 0},
    "profile_preferences": {
        "audio_language": "en",
        "default_quality": "auto",
        "notifications_on": True,
        "new_releases_notif": True,
        "continue_watching": True,
        "ui_theme": "dark",
        "language": "en",
        "autoplay_next": True,
        "autoplay_previews": True,
        "data_saver_mode": False,
        "created_at": NOW,
        "updated_at": NOW,
    },
}

# Longest text allowed per column.
MAX_LENGTH = {
    "genres": {"genre_name": 100},
    "languages": {"language_name": 100, "language_code": 10},
    "actors": {"actor_name": 255, "gender": 20, "nationality": 100},
    "content": {
        "title": 255,
        "content_type": 20,
        "content_category": 50,
        "age_certification": 10,
        "status": 20,
    },
    "seasons": {"title": 255},
    "episodes": {"title": 255},
    "content_parts": {"title": 255},
    "content_languages": {"language_type": 20},
    "content_cast": {"character_name": 255},
    "content_availability": {"country_code": 10},
    "users": {
        "email": 255,
        "password_hash": 255,
        "full_name": 150,
        "phone_number": 20,
        "country_code": 2,
        "account_status": 20,
        "avatar_url": 500,
        "preferred_lang": 5,
    },
    "profiles": {
        "profile_name": 50,
        "avatar_url": 500,
        "age_rating_limit": 10,
        "pin_hash": 255,
        "language": 5,
    },
    "subscription_plans": {"plan_name": 50, "currency": 3, "video_quality": 20},
    "plan_allowed_devices": {"device_type": 20},
    "subscriptions": {"status": 20, "billing_cycle": 10, "cancellation_reason": 255, "promo_code": 50},
    "payments": {
        "currency": 3,
        "payment_method": 20,
        "payment_status": 20,
        "transaction_id": 255,
        "gateway_name": 50,
        "card_last4": 4,
        "card_brand": 20,
        "upi_id": 100,
        "upi_app": 50,
        "billing_address": 500,
        "invoice_url": 500,
    },
    "user_devices": {
        "os_type": 30,
        "device_type": 20,
        "device_name": 100,
        "os_name": 50,
        "os_version": 20,
        "app_version": 20,
        "browser": 50,
        "browser_version": 20,
        "device_fingerprint": 255,
        "push_token": 500,
        "ip_address": 45,
    },
    "downloads": {"download_status": 20},
    "profile_preferences": {"audio_language": 5, "default_quality": 10, "ui_theme": 10, "language": 5},
    "content_rating_levels": {"rating_code": 10, "rating_system": 10, "description": 255},
}


def tables(gen: int = 2) -> list[str]:
    """Names of the tables of one generation."""
    if gen == 2:
        return list(GEN2)
    return ["content_rating_levels"] + [t for t in GEN2 if t not in GEN1_ABSENT]


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(8,2)": T.DecimalType(8, 2),
    "decimal(10,2)": T.DecimalType(10, 2),
}


def _fields(ddl: str) -> list[StructField]:
    """Fields of a column list; needs no session, unlike ``StructType.fromDDL``."""
    out = []
    for column in ddl.split(", "):
        name, kind, *rest = column.split(" ")
        out.append(StructField(name, _TYPES[kind], nullable=not rest))
    return out


def schema(table: str, gen: int = 2) -> StructType:
    """``StructType`` of a table; ``not null`` columns are non-nullable."""
    if table not in tables(gen):
        raise KeyError(f"generation {gen} has no table {table!r}")
    base = _fields(GEN2[table]) if table in GEN2 else []
    if gen == 2:
        return StructType(base)
    kept = [f for f in base if f.name not in GEN1_DROPS.get(table, [])]
    added = _fields(GEN1_ADDS[table]) if table in GEN1_ADDS else []
    return StructType(kept + added)
