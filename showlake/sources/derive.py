"""Platform tables derived from the driver's star-schema test tables.

The mapping is described in ``FIXTURES.md``.  Each table carries the columns of
both generations that the operators use.  No window runs over a raw key here
and numbers per parent come from ``explode``, so a hot order, customer or part
only meets joins (split by adaptive execution) and partial aggregates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import RATING_LEVELS, Early, Tables

ORDERS_AS_OF = dt.date(2001, 6, 30)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# Types of the driver's test tables.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

PLAN_COLUMNS = (
    "plan_id int, plan_name string, price_monthly decimal(8,2), price_yearly decimal(8,2), "
    "max_profiles smallint, max_downloads int, is_active boolean"
)
PLAN_ROWS = (
    "(1,'Basic',7.99,79.99,1,0,true), (2,'Standard',11.99,119.99,2,25,true), "
    "(3,'Premium',17.99,189.99,4,100,true), (4,'Legacy',5.99,null,3,5,false)"
)


#: Adds columns to rows before they are joined, see ``Early``.
Mark = Callable[[DataFrame], DataFrame]


def _day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int"))


def _ts(column: Column) -> Column:
    return column.cast("timestamp_ntz")


def _numbers(last: int | Column) -> Column:
    last = F.lit(last) if isinstance(last, int) else last.cast("int")
    return F.explode(F.sequence(F.lit(1), last))


def platform_tables(spark: SparkSession, directory: str) -> Tables:
    """Lazily planned platform tables over ``directory/*.parquet``."""
    raw = Tables(
        {
            name: (lambda name=name, ddl=ddl: spark.read.schema(ddl).parquet(f"{directory}/{name}.parquet"))
            for name, ddl in RAW.items()
        }
    )
    t = Tables({})

    def genres() -> DataFrame:
        n = F.col("n_nationkey")
        return raw["nation"].select(
            (n + 1).cast("bigint").alias("genre_id"), F.concat(F.lit("Genre "), "n_name").alias("genre_name")
        )

    def languages() -> DataFrame:
        return raw["region"].select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("language_id"),
            F.concat(F.lit("Language "), "r_name").alias("language_name"),
            F.lower(F.substring("r_name", 1, 2)).alias("language_code"),
        )

    def actors() -> DataFrame:
        s = F.col("s_suppkey")
        return raw["supplier"].select(
            (s + 1).alias("actor_id"),
            F.col("s_name").alias("actor_name"),
            _day("1950-01-01", s * 37 % 15000).alias("date_of_birth"),
            F.concat(F.lit("photo/"), (s + 1).cast("string")).alias("photo_url"),
        )

    def content() -> DataFrame:
        p, twelfth = F.col("p_partkey"), F.col("p_partkey") % 12
        series = F.col("p_size") % 3 == 0
        return raw["part"].select(
            (p + 1).alias("content_id"),
            F.col("p_name").alias("title"),
            F.concat_ws(" ", "p_brand", "p_type").alias("description"),
            F.when(series, "Series").otherwise("Movie").alias("content_type"),
            F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("content_category"),
            F.when(p % 40 != 0, _day("1994-01-01", p * 13 % 2500)).alias("release_date"),
            F.when(twelfth == 0, None)
            .when(twelfth < 3, "G")
            .when(twelfth < 6, "PG")
            .when(twelfth < 8, "R")
            .when(twelfth < 10, "TV-Y")
            .otherwise("TV-MA")
            .alias("age_certification"),
            F.when(~series, F.col("p_size") + 60).alias("duration_minutes"),
            F.when(p % 10 == 7, "Inactive").when(p % 10 == 9, "ComingSoon").otherwise("Active").alias("status"),
            F.concat(F.lit("poster/"), (p + 1).cast("string")).alias("poster_url"),
            F.concat(F.lit("trailer/"), (p + 1).cast("string")).alias("trailer_url"),
            _ts(_day("1994-01-01", p * 3 % 2000)).alias("created_at"),
            _ts(_day("1999-01-01", p * 5 % 700)).alias("updated_at"),
        )

    def seasons() -> DataFrame:
        return (
            t["content"]
            .filter("content_type = 'Series'")
            .select("content_id", _numbers(2).alias("season_number"))
            .select(
                (F.col("content_id") * 10 + F.col("season_number")).alias("season_id"),
                "content_id",
                "season_number",
            )
        )

    def episodes() -> DataFrame:
        return (
            t["seasons"]
            .select("season_id", "content_id", _numbers(4).alias("episode_number"))
            .filter((F.col("content_id") + F.col("episode_number")) % 7 != 0)
            .select(
                (F.col("season_id") * 10 + F.col("episode_number")).alias("episode_id"),
                "season_id",
                "episode_number",
                F.concat(F.lit("Episode "), F.col("episode_number").cast("string")).alias("title"),
            )
        )

    def content_parts() -> DataFrame:
        return (
            t["content"]
            .filter("content_type = 'Movie' and content_id % 10 = 0")
            .select("content_id", _numbers(2).alias("part_number"))
            .select((F.col("content_id") * 10 + F.col("part_number")).alias("part_id"), "content_id", "part_number")
        )

    def content_genres() -> DataFrame:
        p = F.col("p_partkey")
        tags = F.array_distinct(F.array(p % 11 + 1, (p * 7 + 3) % 11 + 1))
        return raw["part"].select((p + 1).alias("content_id"), F.explode(tags).alias("genre_id"))

    def content_languages() -> DataFrame:
        p, r = F.col("p_partkey"), F.col("r")
        return (
            raw["part"]
            .select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("r"))
            .filter((p + r) % 2 == 0)
            .select(
                ((p + 1) * 10 + r).alias("content_language_id"),
                (p + 1).alias("content_id"),
                (r + 1).cast("bigint").alias("language_id"),
                F.when((p + r) % 3 == 0, "Audio")
                .when((p + r) % 3 == 1, "Subtitle")
                .otherwise("Both")
                .alias("language_type"),
                (p % 5 == r).alias("is_default"),
            )
        )

    def content_cast() -> DataFrame:
        s = F.col("l_suppkey")
        return (
            raw["lineitem"]
            .select("l_partkey", "l_suppkey")
            .distinct()
            .select(
                F.concat_ws("-", (F.col("l_partkey") + 1).cast("string"), (s + 1).cast("string")).alias("cast_id"),
                (F.col("l_partkey") + 1).alias("content_id"),
                (s + 1).alias("actor_id"),
                F.concat(F.lit("Role "), s.cast("string")).alias("character_name"),
                F.when(s % 5 != 0, (s % 10 + 1).cast("int")).alias("cast_order"),
                (s % 3 == 0).alias("is_main_cast"),
            )
        )

    def content_availability() -> DataFrame:
        p = F.col("p_partkey")
        first = F.pmod(-p, F.lit(7)).cast("int")
        return (
            raw["part"]
            .select("p_partkey", F.explode(F.sequence(first, F.lit(24), F.lit(7))).alias("n_nationkey"))
            .join(raw["nation"].select("n_nationkey", "n_name"), "n_nationkey")
            .select(
                ((p + 1) * 100 + F.col("n_nationkey")).alias("availability_id"),
                (p + 1).alias("content_id"),
                F.concat(
                    F.upper(F.substring("n_name", 1, 2)), F.col("n_nationkey").cast("string")
                ).alias("country_code"),
                _day("1995-01-01", p % 2000).alias("available_from"),
                F.when(p % 3 != 0, _day("1995-01-01", p % 2000 + 400 + p % 1000)).alias("available_to"),
                F.lit(None).cast("string").alias("region_notes"),
            )
        )

    def users() -> DataFrame:
        c = F.col("c_custkey")
        return raw["customer"].select(
            (c + 1).alias("user_id"),
            F.concat(F.lit("u"), c.cast("string"), F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("full_name"),
            F.col("c_nationkey").cast("string").alias("country_code"),
            F.when(c % 10 == 0, "pending")
            .when(c % 10 == 1, "suspended")
            .otherwise("active")
            .alias("account_status"),
            (c % 10 != 0).alias("email_verified"),
            _ts(_day("1998-01-01", c * 7 % 1300)).alias("created_at"),
        )

    def profiles() -> DataFrame:
        u, n = F.col("user_id"), F.col("n")
        return (
            t["users"]
            .select("user_id", "created_at", _numbers(u % 5 + 1).alias("n"))
            .select(
                (u * 10 + n).alias("profile_id"),
                "user_id",
                F.concat(F.lit("P"), n.cast("string")).alias("profile_name"),
                F.concat(F.lit("avatar/"), (u * 10 + n).cast("string")).alias("avatar_url"),
                (n == 2).alias("is_kids"),
                (n == 1).alias("is_primary"),
                F.when(n == 2, F.when(u % 4 == 1, "G").when(u % 4 == 2, "PG").when(u % 4 == 3, "TV-Y")).alias(
                    "age_rating_limit"
                ),
                F.when(n == 1, "pin").alias("pin_hash"),
                "created_at",
            )
        )

    def subscription_plans() -> DataFrame:
        names = ", ".join(part.split()[0] for part in PLAN_COLUMNS.split(", "))
        casts = [F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in PLAN_COLUMNS.split(", ")]
        return spark.sql(f"select * from values {PLAN_ROWS} as t({names})").select(*casts)

    def subscriptions() -> DataFrame:
        o, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        orders = raw["orders"]
        latest = (
            orders.groupBy("o_custkey")
            .agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"))
            .select(F.col("m.o_orderkey").alias("o_orderkey"), F.lit(True).alias("is_latest"))
        )
        status = (
            F.when(F.col("is_latest") & F.col("o_orderstatus").isin("O", "F"), "active")
            .when(F.col("is_latest"), "paused")
            .when(F.col("o_orderstatus") == "O", "expired")
            .otherwise("cancelled")
        )
        s, end = F.col("status"), F.date_add("start_date", F.col("days").cast("int"))
        return (
            orders.join(latest, "o_orderkey", "left")
            .select(
                (o + 1).alias("subscription_id"),
                (F.col("o_custkey") + 1).alias("user_id"),
                (o % 4 + 1).cast("int").alias("plan_id"),
                status.alias("status"),
                F.when(o % 3 == 0, "yearly").otherwise("monthly").alias("billing_cycle"),
                d.alias("start_date"),
                (o % 300 + 30).alias("days"),
                (o % 30).alias("billing_day"),
                (o % 5 != 0).alias("auto_renew"),
                F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("reason"),
            )
            .select(
                "subscription_id",
                "user_id",
                "plan_id",
                "status",
                "billing_cycle",
                "start_date",
                F.when(s.isin("cancelled", "expired"), end).alias("end_date"),
                F.when(s.isin("active", "paused"), _day("2001-08-01", F.col("billing_day"))).alias(
                    "next_billing_date"
                ),
                "auto_renew",
                F.when(s == "cancelled", _ts(end)).alias("cancelled_at"),
                F.when(s == "cancelled", F.col("reason")).alias("cancellation_reason"),
                F.when(F.col("subscription_id") % 2 == 0, F.date_add("start_date", 14)).alias("trial_end_date"),
            )
        )

    def _line_columns() -> dict[str, Column]:
        """What lines get; the natural key of a line is its id.  The profile needs the account."""
        key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        key.append(F.col("l_extendedprice").cast("decimal(10,2)").cast("string"))
        return {
            "id": F.concat_ws("-", *key),
            "profile_id": F.col("user_id") * 10 + F.col("l_linenumber") % (F.col("user_id") % 5 + 1) + 1,
            "content_id": F.col("l_partkey") + 1,
        }

    def _with_account(rows: DataFrame) -> DataFrame:
        # The orders of a task are hashed, so that its lines, far more and wider, need no sort.
        accounts = (
            raw["orders"]
            .select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") + 1).alias("user_id"))
            .hint("shuffle_hash")
        )
        return rows.join(accounts, "l_orderkey")

    def lines() -> DataFrame:
        """Lines with their account."""
        return _with_account(raw["lineitem"]).withColumns(_line_columns())

    def _early_lines() -> DataFrame:
        """Lines before they meet their account."""
        made = _line_columns()
        return raw["lineitem"].withColumns({c: made[c] for c in ("id", "content_id")})

    def _with_profile(rows: DataFrame) -> DataFrame:
        """Early lines with their account's profile."""
        return _with_account(rows).withColumn("profile_id", _line_columns()["profile_id"])

    def _payment_columns() -> list[Column]:
        """All but the account."""
        cents = F.col("l_extendedprice").cast("decimal(10,2)")
        failed = F.col("l_returnflag") == "A"
        returned = F.col("l_returnflag") == "R"
        refunded = returned & (F.col("l_linestatus") == "F")
        fifth = F.col("l_suppkey") % 5
        return [
            F.col("id").alias("payment_id"),
            F.concat(F.lit("txn_"), "id").alias("transaction_id"),
            F.lit("USD").alias("currency"),
            (F.col("l_orderkey") + 1).alias("subscription_id"),
            cents.alias("amount"),
            F.when(fifth == 0, "credit_card")
            .when(fifth == 1, "debit_card")
            .when(fifth == 2, "paypal")
            .when(fifth == 3, "upi")
            .otherwise("gift_card")
            .alias("payment_method"),
            F.when(failed, "failed").when(refunded, "refunded").otherwise("completed").alias("payment_status"),
            F.when(returned, cents * F.col("l_discount").cast("decimal(4,2)"))
            .otherwise(F.lit(0))
            .cast("decimal(10,2)")
            .alias("refund_amount"),
            F.when(~failed, F.col("l_shipdate")).alias("paid_at"),
            F.when(
                refunded, _ts(F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")))
            ).alias("refunded_at"),
            F.concat(F.lit("invoice/"), "id").alias("invoice_url"),
            F.col("l_shipdate").alias("created_at"),
        ]

    def payments() -> DataFrame:
        columns = _payment_columns()
        return t["lines"].select(*columns[:4], "user_id", *columns[4:])

    def early_payments(mark: Mark) -> DataFrame:
        return _with_account(mark(_early_lines().select("l_orderkey", *_payment_columns())))

    def user_devices() -> DataFrame:
        u, n = F.col("user_id"), F.col("n")
        os, kind = (u + n) % 4, (u * 3 + n) % 5
        return (
            t["users"]
            .select("user_id", "created_at", _numbers(u % 3 + 1).alias("n"))
            .select(
                (u * 10 + n).alias("device_id"),
                "user_id",
                F.when(os == 1, "iOS").when(os == 2, "Android").when(os == 3, "Tizen").alias("os_type"),
                F.when(kind == 0, "tablet")
                .when(kind < 3, "smartphone")
                .when(kind == 3, "smart_tv")
                .otherwise("laptop")
                .alias("device_type"),
                F.when(u % 7 != 0, F.col("created_at")).alias("last_active_at"),
            )
        )

    def _with_episode(rows: DataFrame, episode_number: Column) -> DataFrame:
        """Keep released titles; series get the first-season episode if it exists."""
        titles = t["content"].select("content_id", "content_type", "release_date")
        exists = (F.col("content_type") == "Series") & ((F.col("content_id") + episode_number) % 7 != 0)
        return (
            rows.join(titles, "content_id")
            .filter(F.col("release_date").isNotNull())
            .withColumn("episode_id", F.when(exists, F.col("content_id") * 100 + 10 + episode_number))
        )

    def _view_columns() -> list[Column]:
        quantity = F.col("l_quantity")
        return [
            F.col("id").alias("watch_id"),
            F.col("content_id"),
            (quantity.cast("bigint") % 4 + 1).alias("n"),
            F.col("l_shipdate").alias("watched_at"),
            (quantity * 120).cast("int").alias("watch_duration_seconds"),
            (quantity * 100).cast("int").alias("progress_seconds"),
            (F.col("l_linestatus") == "F").alias("completed"),
        ]

    def _plays() -> DataFrame:
        titles = raw["part"].agg(F.count("*")).scalar()
        return (
            raw["events"]
            .filter(F.col("event_type").isin("purchase", "signup"))
            .select(
                F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("watch_id"),
                ((F.col("user_id") + 1) * 10 + 1).alias("profile_id"),
                (F.col("event_id") * 7 % titles + 1).alias("content_id"),
                F.lit(None).cast("bigint").alias("n"),
                F.col("ts").alias("watched_at"),
                F.floor(F.col("value") * 60).cast("int").alias("watch_duration_seconds"),
                F.floor(F.col("value") * 40).cast("int").alias("progress_seconds"),
                (F.col("event_id") % 3 == 0).alias("completed"),
            )
        )

    def watch_history() -> DataFrame:
        views = t["lines"].select("profile_id", *_view_columns())
        return _with_episode(views.unionByName(_plays()), F.col("n")).select(
            "watch_id",
            "profile_id",
            "content_id",
            "episode_id",
            "watched_at",
            "watch_duration_seconds",
            "progress_seconds",
            "completed",
        )

    def early_watch_history(mark: Mark) -> DataFrame:
        views = _with_profile(mark(_early_lines().select("l_orderkey", "l_linenumber", *_view_columns())))
        return _with_episode(views.drop("l_orderkey", "l_linenumber", "user_id").unionByName(mark(_plays())), F.col("n"))

    def search_history() -> DataFrame:
        """Views and clicks are searches, errors are searches that found nothing; texts grow with the catalogue."""
        e = F.col("event_id")
        queries = F.floor(raw["part"].agg(F.count("*")).scalar() / 5)
        return (
            raw["events"]
            .filter(F.col("event_type").isin("view", "click", "error"))
            .select(
                e.alias("search_id"),
                ((F.col("user_id") + 1) * 10 + 1).alias("profile_id"),
                F.concat(F.lit("query "), (e % queries).cast("string")).alias("search_query"),
                F.col("ts").alias("searched_at"),
                F.when((e % 40 < 6) | (F.col("event_type") == "error"), 0).otherwise((e % 17).cast("int")).alias("result_count"),
            )
        )

    def _pairs() -> DataFrame:
        return (
            t["lines"]
            .groupBy("profile_id", "content_id")
            .agg(F.min("l_linenumber").alias("r"), F.min("l_shipdate").alias("created_at"))
        )

    def _rating_columns() -> list[Column]:
        """All but the season."""
        c, stars = F.col("content_id"), (F.col("r") - 1) % 5 + 1
        return [
            F.concat_ws("-", F.col("profile_id").cast("string"), c.cast("string")).alias("rating_id"),
            F.col("profile_id"),
            c,
            F.lit(None).cast("bigint").alias("episode_id"),
            F.lit(None).cast("bigint").alias("part_id"),
            stars.cast("smallint").alias("rating_value"),
            (stars >= 3).alias("is_liked"),
            F.when(c % 3 == 1, "  ")
            .when(c % 3 == 2, F.concat(F.lit("review "), c.cast("string")))
            .alias("review_text"),
            F.col("created_at"),
            F.col("created_at").alias("updated_at"),
        ]

    def _with_type(rows: DataFrame) -> DataFrame:
        return rows.join(t["content"].select("content_id", "content_type").hint("shuffle_hash"), "content_id")  # pairs need no sort

    def _season() -> Column:
        c = F.col("content_id")
        return F.when((c % 4 == 0) & (F.col("content_type") == "Series"), c * 10 + 1).alias("season_id")

    def ratings() -> DataFrame:
        columns = _rating_columns()
        return _with_type(_pairs()).select(*columns[:3], _season(), *columns[3:])

    def early_ratings(mark: Mark) -> DataFrame:
        return _with_type(mark(_pairs().select(*_rating_columns()))).withColumn("season_id", _season())

    def my_list() -> DataFrame:
        return (
            t["lines"]
            .filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
            .groupBy("profile_id", "content_id")
            .agg(F.min("l_shipdate").alias("added_at"))
            .select(
                F.concat_ws("-", F.col("profile_id").cast("string"), F.col("content_id").cast("string")).alias(
                    "my_list_id"
                ),
                "profile_id",
                "content_id",
                "added_at",
            )
        )

    def _download_columns() -> list[Column]:
        """All that lines have by themselves."""
        unseen = F.col("l_linestatus") == "O"
        return [
            F.col("id").alias("download_id"),
            F.col("content_id"),
            F.col("l_shipdate").alias("downloaded_at"),
            F.date_add(F.col("l_shipdate").cast("date"), 30).alias("expiry_date"),
            (F.col("l_tax") * 1000 + 1).cast("decimal(10,2)").alias("file_size_mb"),
            F.when(unseen & (F.col("l_linenumber") % 2 == 1), "Active")
            .when(unseen, "Expired")
            .otherwise("Deleted")
            .alias("download_status"),
        ]

    def _device() -> Column:
        return (F.col("user_id") * 10 + 1).alias("device_id")

    def downloads() -> DataFrame:
        rows = t["lines"].filter(F.col("l_returnflag") == "A")
        columns = _download_columns()
        return _with_episode(rows, F.lit(1)).select(
            columns[0], "profile_id", "content_id", "episode_id", _device(), *columns[2:]
        )

    def early_downloads(mark: Mark) -> DataFrame:
        rows = _early_lines().filter(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", *_download_columns())
        return _with_episode(_with_profile(mark(rows)), F.lit(1)).withColumn("device_id", _device())

    def profile_preferences() -> DataFrame:
        return t["profiles"].select(
            (F.col("profile_id") * 10).alias("preference_id"),
            "profile_id",
            F.lit("en").alias("audio_language"),
            F.lit("auto").alias("default_quality"),
            F.lit("dark").alias("ui_theme"),
        )

    def profile_preferred_genres() -> DataFrame:
        p = F.col("profile_id")
        picks = F.array_distinct(F.array(p % 11 + 1, (p * 5 + 2) % 11 + 1))
        return (
            t["profiles"]
            .filter(F.col("user_id") % 3 != 0)
            .select("profile_id", F.explode(picks).alias("genre_id"))
        )

    def plan_allowed_devices() -> DataFrame:
        kinds = F.array(*[F.lit(d) for d in ("smartphone", "tablet", "smart_tv", "laptop")])
        return (
            t["subscription_plans"]
            .select("plan_id", F.explode(kinds).alias("device_type"))
            .filter((F.col("plan_id") > 1) | F.col("device_type").isin("smartphone", "tablet"))
        )

    def content_rating_levels() -> DataFrame:
        rows = ", ".join(str(row) for row in RATING_LEVELS)
        return spark.sql(
            "select rating_code, rating_system, cast(sort_order as smallint) as sort_order, "
            "rating_system || ' ' || rating_code as description "
            f"from values {rows} as t(rating_code, rating_system, sort_order)"
        )

    for build in (
        genres, languages, actors, content, seasons, episodes, content_parts, content_genres,
        content_languages, content_cast, content_availability, users, profiles, subscription_plans,
        plan_allowed_devices, subscriptions, payments, user_devices, ratings, watch_history, my_list,
        downloads, search_history, profile_preferences, profile_preferred_genres, content_rating_levels,
        lines,
    ):
        t._builders[build.__name__] = build
    t.early = {
        "payments": Early(frozenset({"user_id"}), early_payments),
        "watch_history": Early(frozenset({"profile_id", "episode_id"}), early_watch_history),
        "downloads": Early(frozenset({"profile_id", "episode_id", "device_id"}), early_downloads),
        "ratings": Early(frozenset({"season_id"}), early_ratings),
    }
    return t


HELPERS = {"lines"}


def store_platform_tables(spark: SparkSession, directory: str, target: str) -> Tables:
    """Write the derived tables to ``target`` once and read them back."""
    derived = platform_tables(spark, directory)
    names = [name for name in derived if name not in HELPERS]
    for name in names:
        derived[name].write.mode("errorifexists").parquet(f"{target}/{name}")
    return Tables(
        {
            name: (lambda n=name: spark.read.schema(derived[n].schema).parquet(f"{target}/{n}"))
            for name in names
        }
    )
