"""Search reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import at, count_if, micros, pct, ratio
from ..functions.frames import in_range
from ..sources.tables import Tables


def search_top(T: Tables, start: dt.date, end: dt.date, k: int = 10) -> DataFrame:
    """Most frequent searches with what they returned and who asked."""
    return (
        in_range(T["search_history"], "searched_at", start, end)
        .groupBy("search_query")
        .agg(
            F.count("*").alias("search_count"),
            F.sum("result_count").alias("_results"),
            F.count("result_count").alias("_n"),
            F.countDistinct("profile_id").alias("unique_searchers"),
        )
        .select(
            "search_query",
            "search_count",
            ratio(F.col("_results"), F.col("_n"), 1).alias("avg_results_returned"),
            "unique_searchers",
        )
        .orderBy(F.desc("search_count"), F.asc("search_query"))
        .limit(k)
    )


def _most_searched(rows: DataFrame, k: int) -> DataFrame:
    return (
        rows.groupBy("search_query")
        .agg(F.count("*").alias("times_searched"))
        .orderBy(F.desc("times_searched"), F.asc("search_query"))
        .limit(k)
    )


def search_zero(T: Tables, start: dt.date, end: dt.date, k: int = 10) -> DataFrame:
    """Searches that found nothing."""
    searches = in_range(T["search_history"], "searched_at", start, end)
    return _most_searched(searches.filter(F.col("result_count") == 0), k)


def top_searches(T: Tables, k: int = 20) -> DataFrame:
    return _most_searched(T["search_history"], k)


def trending_searches(T: Tables, as_of: dt.date, min_count: int = 5, k: int = 25) -> DataFrame:
    """Searches of the last 7 days against the 7 before, in one pass."""
    week = at(as_of - dt.timedelta(days=7))
    moment = F.col("searched_at")
    now, before = F.col("this_week_searches"), F.col("last_week_searches")
    return (
        in_range(T["search_history"], "searched_at", as_of - dt.timedelta(days=14))
        .groupBy("search_query")
        .agg(count_if(moment >= week).alias("this_week_searches"), count_if(moment < week).alias("last_week_searches"))
        .filter(now >= min_count)
        .withColumn("pct_growth_wow", pct(now - before, before))
        .orderBy(F.desc_nulls_last("pct_growth_wow"), F.asc("search_query"))
        .limit(k)
    )


def search_conversion(
    T: Tables, start: dt.date, end: dt.date, minutes: int = 30, k: int | None = 25
) -> DataFrame:
    """Sessions a profile started within ``minutes`` of a search, per query.

    A session counts once per query, as a distinct count over the joined pairs
    would have it, but no pairs are built.  Time is cut into slots as long as
    the window.  A session in slot b follows a search of its query either in
    slot b itself (at or after the first one there) or in slot b-1 (if the last
    one there is at most ``minutes`` back).  Per profile, query and slot two
    moments therefore decide, and the sessions before or after them are read
    off running counts.
    """
    span = minutes * 60_000_000
    slot = max(span, 1)
    searches = in_range(T["search_history"], "searched_at", start, end)
    sessions = in_range(T["watch_history"], "watched_at", start, _minutes_after(end, minutes))
    group = ["search_query", "profile_id", "slot"]

    t = F.col("t")
    here = F.struct(_floor(t, slot).alias("slot"), t.alias("from"), F.lit(None).cast("bigint").alias("upto"))
    following = F.struct(
        (_floor(t, slot) + slot).alias("slot"),
        F.lit(None).cast("bigint").alias("from"),
        (t + span).alias("upto"),
    )
    bounds = (
        searches.select("search_query", "profile_id", micros("searched_at").alias("t"))
        .select("search_query", "profile_id", F.inline(F.array(here, following)))
        .groupBy(*group)
        .agg(F.min("from").alias("from"), F.max("upto").alias("upto"), F.count("from").alias("searches"))
    )
    ends = F.array(
        F.struct(F.lit("from").alias("kind"), F.col("from").alias("t"), "searches"),
        F.struct(F.lit("upto").alias("kind"), F.col("upto").alias("t"), F.lit(0).cast("bigint").alias("searches")),
    )
    marks = bounds.select(*group, F.inline(ends)).filter("t is not null")

    moments = sessions.select("profile_id", micros("watched_at").alias("t")).groupBy("profile_id", "t")
    counted = moments.agg(F.count("*").alias("n")).withColumn("slot", _floor(t, slot))

    is_from = F.col("kind") == "from"
    per_slot = (
        _running_counts(marks.unionByName(counted, allowMissingColumns=True))
        .groupBy(*group)
        .agg(
            F.sum("searches").alias("searches"),
            F.max(F.when(is_from, F.col("before"))).alias("before"),
            F.max(F.when(is_from, F.col("in_slot"))).alias("in_slot"),
            F.max(F.when(~is_from, F.col("through"))).alias("through"),
        )
    )
    # ``least`` passes over a NULL; sessions that both bounds cover count once.
    early = F.when(F.col("through").isNotNull(), F.least("through", "before")).otherwise(0)
    late = F.coalesce(F.col("in_slot") - F.col("before"), F.lit(0))
    rows = (
        per_slot.groupBy("search_query")
        .agg(F.sum("searches").alias("total_searches"), F.sum(early + late).alias("resulting_watches"))
        .withColumn("conversion_rate_pct", pct(F.col("resulting_watches"), F.col("total_searches")))
        .orderBy(F.desc("total_searches"), F.asc("search_query"))
    )
    return rows if k is None else rows.limit(k)


def _floor(t: Column, unit: int) -> Column:
    """Start of the unit that a moment lies in."""
    return t - F.pmod(t, F.lit(unit))


def _running_counts(rows: DataFrame) -> DataFrame:
    """For every mark the sessions of its slot ``before`` it, ``through`` it and ``in_slot``.

    ``rows`` are marks (with a ``kind``) and sessions counted per moment (with
    ``n``).  Counts run within each second first; then each second's total,
    carried by one row, runs over the seconds of the slot.  A busy profile is
    so spread over its seconds, and no join is needed to read the counts.
    """
    second = Window.partitionBy("profile_id", "slot", "second")
    in_order = second.orderBy("t")
    slot = Window.partitionBy("profile_id", "slot")
    first = F.row_number().over(in_order) == 1
    inside = rows.withColumn("second", _floor(F.col("t"), 1_000_000)).select(
        *rows.columns,
        "second",
        F.sum("n").over(in_order.rangeBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.sum("n").over(in_order.rangeBetween(Window.unboundedPreceding, 0)).alias("through"),
        F.when(first, F.sum("n").over(second)).alias("total"),
        first.alias("first"),
    )
    earlier = slot.orderBy("second").rangeBetween(Window.unboundedPreceding, -1)
    carry = F.coalesce(F.sum("total").over(earlier), F.lit(0))
    return (
        inside.filter(F.col("kind").isNotNull() | F.col("first"))
        .withColumns({"carry": carry, "in_slot": F.coalesce(F.sum("total").over(slot), F.lit(0))})
        .filter("kind is not null")
        .withColumns(
            {
                "before": F.col("carry") + F.coalesce("before", F.lit(0)),
                "through": F.col("carry") + F.coalesce("through", F.lit(0)),
            }
        )
    )


def _minutes_after(moment: dt.date | dt.datetime, minutes: int) -> dt.datetime:
    if not isinstance(moment, dt.datetime):
        moment = dt.datetime(moment.year, moment.month, moment.day)
    return moment + dt.timedelta(minutes=minutes)
