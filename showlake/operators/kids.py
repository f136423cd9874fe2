"""Age-gated selection.

A profile's limit is one of the codes of the rating scale, so every gated list
is computed once per limit and then handed to the profiles that have it.  The
catalogue is never paired with profiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import contains_ci
from ..functions.frames import for_screen, look_up, only_keys, salted_join, top_per_key
from ..sources.tables import Tables
from .browse import active_titles, average_ratings, newest_release

LIMIT = "age_rating_limit"


def gate(T: Tables, mode: str = "reference") -> DataFrame:
    """``(age_rating_limit, age_certification)`` pairs that may be seen.

    ``reference`` compares positions on the one scale on which all film codes
    lie below all TV codes.  ``per_system`` compares only codes of one system.
    The scale is a handful of rows, so its window is too.
    """
    if mode not in ("reference", "per_system"):
        raise ValueError(f"unknown mode {mode!r}")
    split = ["rating_system"] if mode == "per_system" else []
    upto = (
        Window.partitionBy(*split)
        .orderBy("sort_order")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    lower = F.collect_list("rating_code").over(upto)
    scale = T["content_rating_levels"].select(F.col("rating_code").alias(LIMIT), lower.alias("codes"))
    return scale.select(LIMIT, F.explode("codes").alias("age_certification"))


def kids_limits(T: Tables, keys: DataFrame | None = None, kids_only: bool = True) -> DataFrame:
    rows = only_keys(T["profiles"], keys).filter(F.col(LIMIT).isNotNull())
    if kids_only:
        rows = rows.filter("is_kids")
    return rows.select("profile_id", LIMIT)


def _best_per_limit(
    T: Tables, titles: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, mode: str
) -> DataFrame:
    """First ``k`` titles under each limit (and ``keys``).

    Cut per certificate first: at most ``k`` titles of one certificate can be
    among the first ``k`` under any limit.
    """
    rank = F.row_number().over(Window.partitionBy(*keys, "age_certification").orderBy(*order))
    per_code = titles.withColumn("_rn", rank).filter(F.col("_rn") <= k).drop("_rn")
    allowed = per_code.join(gate(T, mode), "age_certification")
    return top_per_key(allowed, [*keys, LIMIT], order, k, rank="rank_in_row")


def _give(profiles: DataFrame, lists: DataFrame, on: Sequence[str], keys: DataFrame | None) -> DataFrame:
    """Hand lists of at most ``k`` rows per key to the profiles that share it."""
    rows = salted_join(profiles, lists, on, ["profile_id"])
    rows_of = [F.asc("genre_name"), F.asc("genre_id")] if "genre_name" in rows.columns else []
    return for_screen(rows, keys, [F.asc("profile_id"), *rows_of, F.asc("rank_in_row")])


def kids_browse(T: Tables, k: int = 10, keys: DataFrame | None = None, mode: str = "reference") -> DataFrame:
    """Newest titles within the limit of every kids profile that has one."""
    titles = active_titles(T).select(
        "content_id", "title", "poster_url", "age_certification", "content_type", "release_date"
    )
    lists = _best_per_limit(T, titles, [], [newest_release(), F.asc("content_id")], k, mode)
    return _give(kids_limits(T, keys), lists, [LIMIT], keys).select(
        "profile_id", "content_id", "title", "poster_url", "age_certification", "content_type"
    )


def effective_ceiling(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Scale position of every profile's limit; the lowest one where none is set."""
    levels = T["content_rating_levels"].select(F.col("rating_code").alias(LIMIT), "sort_order")
    lowest = T["content_rating_levels"].agg(F.min("sort_order")).scalar()
    return (
        look_up(only_keys(T["profiles"], keys).select("profile_id", LIMIT), levels, LIMIT)
        .select("profile_id", F.coalesce("sort_order", lowest).alias("effective_rating_ceiling"))
    )


def playback_allowed(T: Tables, pairs: DataFrame, mode: str = "reference") -> DataFrame:
    """``pairs`` (profile_id, content_id) with whether the profile may play the title.

    False where the profile has no limit or the title no certificate.
    """
    limits = kids_limits(T, kids_only=False)
    certificates = T["content"].select("content_id", "age_certification")
    allowed = gate(T, mode).withColumn("_ok", F.lit(True))
    known = pairs.join(limits, "profile_id", "left").join(certificates, "content_id", "left")
    return (
        look_up(known, allowed, LIMIT, "age_certification")
        .select("profile_id", "content_id", F.coalesce("_ok", F.lit(False)).alias("is_playback_allowed"))
    )


def _tagged_titles(T: Tables) -> DataFrame:
    titles = active_titles(T).select("content_id", "title", "poster_url", "age_certification", "release_date")
    return T["content_genres"].join(titles, "content_id")


def kids_genre_row(
    T: Tables, genre_id: int | None = None, k: int = 10, keys: DataFrame | None = None, mode: str = "reference"
) -> DataFrame:
    """Newest titles of a genre (all genres if None) for every profile with a limit."""
    titles = _tagged_titles(T)
    if genre_id is not None:
        titles = titles.filter(F.col("genre_id") == genre_id)
    lists = _best_per_limit(T, titles, ["genre_id"], [newest_release(), F.asc("content_id")], k, mode)
    return _give(kids_limits(T, keys, kids_only=False), lists, [LIMIT], keys).select(
        "profile_id", "genre_id", "content_id", "title", "poster_url"
    )


def kids_home(T: Tables, k: int = 10, keys: DataFrame | None = None, mode: str = "reference") -> DataFrame:
    """For every preferred genre of every profile with a limit, the newest titles."""
    lists = _best_per_limit(T, _tagged_titles(T), ["genre_id"], [newest_release(), F.asc("content_id")], k, mode)
    named = lists.join(T["genres"].select("genre_id", "genre_name"), "genre_id")
    wishes = T["profile_preferred_genres"].join(kids_limits(T, keys, kids_only=False), "profile_id")
    return _give(wishes, named, ["genre_id", LIMIT], keys).select(
        "profile_id", "genre_id", "genre_name", "content_id", "title", "poster_url", "rank_in_row"
    )


def kids_fallback(T: Tables, k: int = 10, keys: DataFrame | None = None, mode: str = "reference") -> DataFrame:
    """Best rated titles for profiles with a limit but without preferred genres."""
    titles = (
        active_titles(T)
        .select("content_id", "title", "poster_url", "age_certification")
        .join(average_ratings(T).drop("rating_count"), "content_id", "left")
    )
    lists = _best_per_limit(T, titles, [], [F.desc_nulls_last("avg_rating"), F.asc("content_id")], k, mode)
    waiting = kids_limits(T, keys, kids_only=False).join(T["profile_preferred_genres"], "profile_id", "left_anti")
    return _give(waiting, lists, [LIMIT], keys).select("profile_id", "content_id", "title", "poster_url", "avg_rating")


def kids_search(
    T: Tables, term: str, k: int = 10, keys: DataFrame | None = None, mode: str = "reference"
) -> DataFrame:
    """First titles by name that contain ``term``, for every profile with a limit."""
    titles = (
        active_titles(T)
        .filter(contains_ci("title", term))
        .select("content_id", "title", "poster_url", "age_certification")
    )
    lists = _best_per_limit(T, titles, [], [F.asc("title"), F.asc("content_id")], k, mode)
    return _give(kids_limits(T, keys, kids_only=False), lists, [LIMIT], keys).select(
        "profile_id", "content_id", "title", "poster_url", "age_certification"
    )


def kids_profiles(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Kids profiles with the description of their limit."""
    levels = T["content_rating_levels"].select(
        F.col("rating_code").alias(LIMIT), F.col("description").alias("limit_description")
    )
    rows = (
        look_up(only_keys(T["profiles"], keys).filter("is_kids"), levels, LIMIT)
        .select("user_id", "profile_id", "profile_name", "avatar_url", LIMIT, "limit_description")
    )
    return for_screen(rows, keys, [F.asc("user_id"), F.asc("profile_name"), F.asc("profile_id")])
