"""Viewing reports.

The viewing log is summed per title (or episode) before anything is joined to
it: partial sums absorb a title that holds most of the log, and the joins that
follow see one row per title.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import count_if, month_of, pct, ratio
from ..functions.frames import dealt, for_screen, in_range, only_keys, split_join, top_per_key
from ..sources.tables import Tables
from .browse import active_titles


def views() -> Column:
    return F.count("*")


def seconds() -> Column:
    return F.sum("watch_duration_seconds")


def completed() -> Column:
    return count_if(F.col("completed"))


def _watched(T: Tables, start: dt.date | None, end: dt.date | None) -> DataFrame:
    log = T["watch_history"]
    return log if start is None else in_range(log, "watched_at", start, end)


def title_engagement(T: Tables, start: dt.date, end: dt.date, k: int = 10) -> DataFrame:
    """Views, completion, minutes and reach of the most viewed titles."""
    sums = (
        _watched(T, start, end)
        .groupBy("content_id")
        .agg(
            views().alias("total_views"),
            completed().alias("completed_views"),
            seconds().alias("_seconds"),
            F.countDistinct("profile_id").alias("unique_viewers"),
        )
    )
    return (
        sums.join(T["content"].select("content_id", "title", "content_type"), "content_id")
        .select(
            "content_id",
            "title",
            "content_type",
            "total_views",
            "completed_views",
            pct(F.col("completed_views"), F.col("total_views")).alias("completion_rate_pct"),
            ratio(F.col("_seconds"), F.col("total_views") * 60, 1).alias("avg_minutes_watched"),
            "unique_viewers",
        )
        .orderBy(F.desc("total_views"), F.asc("content_id"))
        .limit(k)
    )


def daily_trend(T: Tables, start: dt.date, end: dt.date, keys: DataFrame | None = None) -> DataFrame:
    """Views per title and day."""
    days = (
        only_keys(_watched(T, start, end), keys)
        .groupBy("content_id", F.col("watched_at").cast("date").alias("view_date"))
        .agg(views().alias("views"), F.countDistinct("profile_id").alias("unique_viewers"), seconds().alias("_seconds"))
        .select(
            "content_id",
            "view_date",
            "views",
            "unique_viewers",
            ratio(F.col("_seconds"), F.col("views") * 60, 1).alias("avg_minutes"),
        )
    )
    return for_screen(days, keys, [F.asc("content_id"), F.asc("view_date")])


def episode_dropoff(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Views, completion and share kept from the previous episode, per season.

    ``keys`` may narrow by content_id and season_number.
    """
    sums = (
        T["watch_history"]
        .filter(F.col("episode_id").isNotNull())
        .groupBy("episode_id")
        .agg(F.count("watch_id").alias("views"), completed().alias("completions"))
    )
    seasons = only_keys(T["seasons"].select("season_id", "content_id", "season_number"), keys)
    rows = (
        T["episodes"]
        .select("episode_id", "season_id", "episode_number", F.col("title").alias("episode_title"))
        .join(seasons, "season_id")
        .join(sums, "episode_id", "left")
        .withColumns(
            {
                "total_views": F.coalesce("views", F.lit(0)),
                "completions": F.coalesce("completions", F.lit(0)),
            }
        )
    )
    before = F.lag("total_views").over(Window.partitionBy("season_id").orderBy("episode_number"))
    out = (
        rows.withColumn("_before", before)
        .select(
            "content_id",
            "season_number",
            "episode_number",
            "episode_title",
            "total_views",
            "completions",
            pct(F.col("completions"), F.col("total_views")).alias("completion_rate_pct"),
            pct(F.col("total_views"), F.col("_before")).alias("pct_retained_from_prev_episode"),
        )
    )
    return for_screen(out, keys, [F.asc("content_id"), F.asc("season_number"), F.asc("episode_number")])


def title_reach(T: Tables, start: dt.date, end: dt.date, k: int = 10) -> DataFrame:
    """Titles by number of different viewers."""
    sums = (
        _watched(T, start, end)
        .groupBy("content_id")
        .agg(F.countDistinct("profile_id").alias("unique_viewers"), views().alias("total_views"))
    )
    return (
        sums.join(T["content"].select("content_id", "title"), "content_id")
        .select(
            "content_id",
            "title",
            "unique_viewers",
            "total_views",
            ratio(F.col("total_views"), F.col("unique_viewers"), 2).alias("avg_views_per_viewer"),
        )
        .orderBy(F.desc("unique_viewers"), F.asc("content_id"))
        .limit(k)
    )


def _by_genre(T: Tables, per_title: DataFrame) -> DataFrame:
    """Per-title sums repeated for each genre of the title."""
    return (
        per_title.join(T["content_genres"], "content_id")
        .groupBy("genre_id")
        .agg(*[F.sum(c).alias(c) for c in per_title.columns if c != "content_id"])
        .join(T["genres"].select("genre_id", "genre_name"), "genre_id")
    )


def genre_completion(T: Tables, start: dt.date, end: dt.date) -> DataFrame:
    per_title = (
        _watched(T, start, end).groupBy("content_id").agg(views().alias("total_views"), completed().alias("_done"))
    )
    return (
        _by_genre(T, per_title)
        .groupBy("genre_name")
        .agg(F.sum("total_views").alias("total_views"), F.sum("_done").alias("_done"))
        .select(
            "genre_name", "total_views", pct(F.col("_done"), F.col("total_views")).alias("completion_rate_pct")
        )
        .orderBy(F.desc("completion_rate_pct"), F.asc("genre_name"))
    )


def top_watched(T: Tables, k: int = 10) -> DataFrame:
    """Titles with most sessions."""
    sums = T["watch_history"].groupBy("content_id").agg(views().alias("view_count"))
    return (
        sums.join(T["content"].select("content_id", "title"), "content_id")
        .select("content_id", "title", "view_count")
        .orderBy(F.desc("view_count"), F.asc("content_id"))
        .limit(k)
    )


def genre_hours(T: Tables) -> DataFrame:
    """Hours watched per genre; a title counts in each of its genres."""
    per_title = T["watch_history"].groupBy("content_id").agg(seconds().alias("_seconds"))
    return (
        _by_genre(T, per_title)
        .groupBy("genre_name")
        .agg(F.sum("_seconds").alias("_seconds"))
        .select("genre_name", ratio(F.col("_seconds"), F.lit(3600), 2).alias("total_hours_watched"))
        .orderBy(F.desc("total_hours_watched"), F.asc("genre_name"))
    )


def completion_by_title(T: Tables) -> DataFrame:
    """Completion per title text; titles of the same name are one row."""
    sums = T["watch_history"].groupBy("content_id").agg(views().alias("n"), completed().alias("done"))
    return (
        sums.join(T["content"].select("content_id", "title"), "content_id")
        .groupBy("title")
        .agg(F.sum("n").alias("total_sessions"), F.sum("done").alias("done"))
        .select("title", pct(F.col("done"), F.col("total_sessions")).alias("completion_rate_pct"), "total_sessions")
        .orderBy(F.desc("completion_rate_pct"), F.asc("title"))
    )


def unwatched_content(T: Tables) -> DataFrame:
    """Active titles without a single session."""
    seen = T["watch_history"].select("content_id").distinct()
    return active_titles(T).join(seen, "content_id", "left_anti").select("content_id", "title", "release_date")


def category_performance(T: Tables) -> DataFrame:
    """Hours and watched titles per category."""
    sums = T["watch_history"].groupBy("content_id").agg(seconds().alias("_seconds"))
    titles = T["content"].filter(F.col("content_category").isNotNull()).select("content_id", "content_category")
    return (
        sums.join(titles, "content_id")
        .groupBy("content_category")
        .agg(F.sum("_seconds").alias("_seconds"), F.count("*").alias("titles_in_category"))
        .select(
            "content_category",
            ratio(F.col("_seconds"), F.lit(3600), 2).alias("total_hours_watched"),
            "titles_in_category",
        )
        .orderBy(F.desc("total_hours_watched"), F.asc("content_category"))
    )


def favourite_genre(T: Tables, split_hot: bool = False) -> DataFrame:
    """The genre every profile spent most seconds on; ties go to the first name.

    ``split_hot`` is for catalogues too large to broadcast with titles that
    most profiles watched: those then meet their genres where their rows are,
    for one more pass over the sums.
    """
    per_title = T["watch_history"].groupBy("profile_id", "content_id").agg(seconds().alias("s"))
    names = T["genres"].select("genre_id", "genre_name")
    named = T["content_genres"].select("content_id", "genre_id").join(names, "genre_id").drop("genre_id")
    tagged = split_join(per_title, named, "content_id") if split_hot else per_title.join(named.hint("shuffle_hash"), "content_id")
    # A title's task has few titles of a profile, so sums there would hold nearly every row; a profile has one row per title and genre.
    per_genre = dealt(tagged.select("profile_id", "genre_name", "s"), "profile_id", "genre_name")
    per_genre = per_genre.groupBy("profile_id", "genre_name").agg(F.sum("s").alias("total_seconds"))
    return top_per_key(per_genre, ["profile_id"], [F.desc("total_seconds"), F.asc("genre_name")], 1)


def listed_unwatched(T: Tables) -> DataFrame:
    """List entries whose profile never watched the title, newest first."""
    pair = ["profile_id", "content_id"]
    seen = T["watch_history"].select(*pair).distinct()
    return (
        T["my_list"]
        .join(seen, pair, "left_anti")
        .join(T["profiles"].select("profile_id"), "profile_id", "left_semi")
        .join(T["content"].select("content_id", "title"), "content_id")
        .select("profile_id", "title", "added_at", "my_list_id")
        .orderBy(F.desc("added_at"), F.asc("my_list_id"))
        .drop("my_list_id")
    )


def titles_per_genre(T: Tables) -> DataFrame:
    """Titles per genre, 0 for unused genres."""
    counts = T["content_genres"].groupBy("genre_id").agg(F.count("content_id").alias("n"))
    return (
        T["genres"]
        .join(counts, "genre_id", "left")
        .groupBy("genre_name")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("title_count"))
        .orderBy(F.desc("title_count"), F.asc("genre_name"))
    )


def titles_per_category(T: Tables) -> DataFrame:
    """Titles per category; a missing category is its own group."""
    return (
        T["content"]
        .groupBy("content_category")
        .agg(F.count("*").alias("title_count"))
        .select(F.coalesce("content_category", F.lit("Uncategorized")).alias("content_category"), "title_count")
        .orderBy(F.desc("title_count"), F.asc("content_category"))
    )


def availability_by_country(T: Tables, as_of: dt.date) -> DataFrame:
    """Titles on offer per country; a window's last day still counts."""
    last = F.col("available_to")
    open_ = (F.col("available_from") <= F.lit(as_of)) & (last.isNull() | (F.lit(as_of) <= last))
    return (
        T["content_availability"]
        .filter(open_)
        .groupBy("country_code")
        .agg(F.countDistinct("content_id").alias("titles_available"))
        .orderBy(F.desc("titles_available"), F.asc("country_code"))
    )


def top_actors(T: Tables, k: int = 10) -> DataFrame:
    """Actors in most titles."""
    counts = T["content_cast"].groupBy("actor_id").agg(F.countDistinct("content_id").alias("title_count"))
    return (
        counts.join(T["actors"].select("actor_id", "actor_name"), "actor_id")
        .select("actor_id", "actor_name", "title_count")
        .orderBy(F.desc("title_count"), F.asc("actor_id"))
        .limit(k)
    )


def releases_monthly(T: Tables) -> DataFrame:
    return (
        T["content"]
        .filter(F.col("release_date").isNotNull())
        .groupBy(month_of("release_date").alias("release_month"))
        .agg(F.count("*").alias("titles_released"))
        .orderBy("release_month")
    )
