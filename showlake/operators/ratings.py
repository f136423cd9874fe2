"""Rating reports: stars (generation 1) and likes (generation 2).

Every report sums votes per title first; joins follow on one row per title.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_if, on_level, pct, ratio
from ..functions.frames import top_per_key
from ..sources.tables import Tables


def _votes(T: Tables) -> DataFrame:
    return (
        T["ratings"]
        .groupBy("content_id")
        .agg(
            F.count("rating_id").alias("rating_count"),
            F.count("rating_value").alias("_n"),
            F.sum("rating_value").alias("_sum"),
            F.stddev_samp("rating_value").alias("_spread"),
        )
    )


def average() -> Column:
    return ratio(F.col("_sum"), F.col("_n"), 2)


def _titled(T: Tables, votes: DataFrame, *columns: str) -> DataFrame:
    return votes.join(T["content"].select("content_id", "title", *columns), "content_id")


def top_rated(T: Tables, min_votes: int = 5, k: int = 10) -> DataFrame:
    return (
        _titled(T, _votes(T).filter(F.col("rating_count") >= min_votes), "content_type")
        .select("content_id", "title", "content_type", "rating_count", average().alias("avg_rating"))
        .orderBy(F.desc("avg_rating"), F.desc("rating_count"), F.asc("content_id"))
        .limit(k)
    )


def weighted_rating(T: Tables, m: int = 1, k: int = 10) -> DataFrame:
    """Title averages pulled to the overall average, the more the fewer votes.

    ``v/(m+v)*avg + m/(m+v)*all`` is ``(sum*N + m*S) / (N*(m+v))`` with the
    overall sum S of N votes, which stays exact until the one division.
    """
    votes = _votes(T)
    whole = T["ratings"].agg(F.struct(F.sum("rating_value").alias("s"), F.count("rating_value").alias("n"))).scalar()
    wide = "decimal(22,0)"
    v, s = F.col("rating_count"), F.col("_sum").cast(wide)
    total, count = whole["s"].cast(wide), whole["n"].cast(wide)
    top = (s * count + F.lit(m) * total).cast("decimal(24,0)")
    return (
        _titled(T, votes)
        .select(
            "content_id",
            "title",
            "rating_count",
            average().alias("raw_avg_rating"),
            ratio(top, (count * (v + m)).cast("decimal(22,0)"), 2).alias("weighted_rating"),
        )
        .orderBy(F.desc("weighted_rating"), F.asc("content_id"))
        .limit(k)
    )


def top_rated_in_genre(T: Tables, genre_id: int | None = None, min_votes: int = 5, k: int = 10) -> DataFrame:
    """Best rated titles of a genre, or of every genre if None."""
    tags = T["content_genres"]
    if genre_id is not None:
        tags = tags.filter(F.col("genre_id") == genre_id)
    rows = (
        _titled(T, _votes(T).filter(F.col("rating_count") >= min_votes))
        .join(tags, "content_id")
        .select("genre_id", "content_id", "title", "rating_count", average().alias("avg_rating"))
    )
    return top_per_key(rows, ["genre_id"], [F.desc("avg_rating"), F.asc("content_id")], k)


def controversial(T: Tables, min_votes: int = 5, k: int = 10) -> DataFrame:
    """Titles whose votes spread most."""
    return (
        _titled(T, _votes(T).filter(F.col("rating_count") >= min_votes))
        .select(
            "content_id",
            "title",
            "rating_count",
            average().alias("avg_rating"),
            F.round("_spread", 2).alias("rating_stddev"),
        )
        .orderBy(F.desc_nulls_first("rating_stddev"), F.asc("content_id"))
        .limit(k)
    )


def like_pct(T: Tables, order: str = "desc", min_votes: int = 1) -> DataFrame:
    """Share of likes per title text, votes on whole titles only.

    ``order="desc"`` lists the best liked first, ``"asc"`` the most disliked.
    """
    if order not in ("asc", "desc"):
        raise ValueError(f"unknown order {order!r}")
    votes = (
        T["ratings"]
        .filter(on_level())
        .groupBy("content_id")
        .agg(F.count("*").alias("n"), count_if(F.col("is_liked")).alias("liked"))
    )
    first = F.desc("like_pct") if order == "desc" else F.asc("like_pct")
    return (
        _titled(T, votes)
        .groupBy("title")
        .agg(F.sum("n").alias("total_ratings"), F.sum("liked").alias("liked"))
        .filter(F.col("total_ratings") >= min_votes)
        .select("title", "total_ratings", pct(F.col("liked"), F.col("total_ratings")).alias("like_pct"))
        .orderBy(first, F.desc("total_ratings"), F.asc("title"))
    )
