import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from showlake.operators import changes, revenue, search
from showlake.sources import constraints, schemas, tables

NOW = dt.datetime(2024, 1, 1, 12)


def test_generations_differ_where_described():
    assert "content_category" in schemas.schema("content").names
    assert "content_category" not in schemas.schema("content", 1).names
    assert "age_certification" in schemas.schema("content", 1).names
    assert "rating_value" in schemas.schema("ratings", 1).names
    assert len(schemas.tables(2)) == 25 and len(schemas.tables(1)) == 24
    assert len(schemas.schema("user_devices", 1)) == 16
    with pytest.raises(KeyError):
        schemas.schema("content_parts", 1)


def test_constraint_counts():
    by_action = [fk.on_delete for fk in constraints.foreign_keys(2)]
    assert [by_action.count(a) for a in ("cascade", "restrict", "set null")] == [27, 6, 3]
    older = [fk.on_delete for fk in constraints.foreign_keys(1)]
    assert [older.count(a) for a in ("cascade", "restrict", "set null")] == [22, 6, 5]


def test_constraints_name_real_columns():
    for fk in constraints.foreign_keys(2):
        assert fk.column in schemas.schema(fk.child).names
        assert fk.parent_column in schemas.schema(fk.parent).names
    for table, key in constraints.PRIMARY_KEYS.items():
        gen = 2 if table in schemas.GEN2 else 1
        assert set(key) <= set(schemas.schema(table, gen).names)
    for table, defaults in schemas.DEFAULTS.items():
        both = {*schemas.schema(table, 2).names, *schemas.schema(table, 1).names} if table in schemas.tables(1) else {
            *schemas.schema(table, 2).names
        }
        assert set(defaults) <= both
    for table, limits in schemas.MAX_LENGTH.items():
        both = set()
        for gen in (1, 2):
            if table in schemas.tables(gen):
                both |= set(schemas.schema(table, gen).names)
        assert set(limits) <= both


def test_defaults(make, rows):
    given = make("profile_id long, user_id long, profile_name string, is_kids boolean", (1, 2, "a", None))
    out = tables.with_defaults(given, "profiles", NOW)
    assert out.schema.names == schemas.schema("profiles").names
    row = out.first()
    assert row.is_primary is False and row.created_at == NOW
    assert row.is_kids is None, "an explicit NULL is not replaced"
    assert row.avatar_url is None


def test_write_and_load(spark, make, tmp_path):
    genres = tables.with_defaults(make("genre_id long, genre_name string", (1, "Drama")), "genres", NOW)
    tables.overwrite(genres, f"{tmp_path}/genres")
    tables.append(genres.withColumn("genre_id", F.lit(2)), f"{tmp_path}/genres")
    loaded = tables.load_tables(spark, str(tmp_path))
    assert sorted(r.genre_id for r in loaded["genres"].collect()) == [1, 2]
    log = tables.with_defaults(
        make("search_id long, profile_id long, search_query string", (1, 1, "x")), "search_history", NOW
    )
    tables.append(log, f"{tmp_path}/search_history", "searched_at")
    days = loaded["search_history"].filter("searched_at >= timestamp_ntz'2024-01-01'")
    assert days.count() == 1
    T = {"search_history": loaded["search_history"]}
    assert search.search_top(T, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).count() == 1
    report = search.search_top(T, dt.date(2024, 2, 1), dt.date(2024, 2, 2))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day_of_searched_at" in plan
    assert (tmp_path / "search_history" / "day_of_searched_at=2024-01-01").exists()


def test_changes_to_a_log_laid_out_by_day(spark, make, tmp_path):
    """Inserted, ignored, merged, toggled and moved rows are in the range reports of the snapshot and of its copy on disk."""
    ddl = "search_id long, profile_id long, search_query string, searched_at timestamp_ntz"
    old = tables.with_defaults(make(ddl, (1, 1, "x", NOW)), "search_history", NOW)
    new = make(ddl, (2, 1, "x", NOW))
    tables.append(old, f"{tmp_path}/search_history", "searched_at")
    log = tables.load_tables(spark, str(tmp_path))["search_history"]
    assert "day_of_searched_at" in log.columns

    def searches(frame, day):
        report = search.search_top({"search_history": frame}, day, day + dt.timedelta(days=1)).collect()
        return sum(r.search_count for r in report)

    later = NOW + dt.timedelta(days=40)
    moved = changes.update_where(log, "search_id = 1", {"searched_at": later}).snapshot
    assert searches(moved, later.date()) == 1 and searches(moved, NOW.date()) == 0
    snapshots = [
        changes.insert_rows(log, new, "search_history", ["search_id"], NOW).snapshot,
        changes.insert_ignore(log, new, ["search_id"]).snapshot,
        changes.insert_ignore(log, new, ["search_id"], bulk=False).snapshot,
        changes.merge_upsert(log, new, ["search_id"], ["search_query"]).snapshot,
        changes.merge_upsert(log, new, ["search_id"], ["search_query"], bulk=False).snapshot,
        changes.toggle(log, new, ["search_id"]).snapshot,
    ]
    for i, snapshot in enumerate(snapshots):
        assert searches(snapshot, NOW.date()) == 2
        tables.overwrite(snapshot, f"{tmp_path}/{i}/search_history", "searched_at")
        assert searches(tables.load_tables(spark, f"{tmp_path}/{i}")["search_history"], NOW.date()) == 2


def test_days_are_written_in_few_files(spark, make, tmp_path):
    rows = spark.range(400).repartition(16).selectExpr("id", "timestampadd(DAY, id % 2, timestamp_ntz'2024-01-01') as t")
    tables.append(rows, f"{tmp_path}/log", "t")
    for day in ("2024-01-01", "2024-01-02"):
        assert 1 <= len(list((tmp_path / "log" / f"day_of_t={day}").glob("*.parquet"))) <= 2
    assert spark.read.parquet(f"{tmp_path}/log").count() == 400


def test_payments_by_day(spark, make, tmp_path):
    ddl = "payment_id long, payment_status string, amount decimal(10,2), refund_amount decimal(10,2), paid_at timestamp_ntz, created_at timestamp_ntz"
    rows = make(ddl, (1, "completed", Decimal(5), Decimal(0), NOW, NOW - dt.timedelta(days=99)), (2, "failed", Decimal(7), Decimal(0), None, NOW))
    tables.append(tables.with_defaults(rows, "payments", NOW), f"{tmp_path}/payments", "paid_at")
    T = tables.load_tables(spark, str(tmp_path))
    report = revenue.monthly_revenue(T, 12, NOW.date() + dt.timedelta(days=1))
    assert "PartitionFilters: [isnotnull(day_of_paid_at" in report._jdf.queryExecution().executedPlan().toString()
    assert [r.gross_revenue for r in report.collect()] == [5]
    assert revenue.failed_payment_totals(T, NOW.date()).first().failed_payment_count == 1  # by another column than the layout


def test_rating_levels(spark):
    levels = tables.rating_levels(spark).collect()
    assert [r.sort_order for r in levels] == list(range(1, 11))
    assert levels[0].rating_code == "G" and levels[-1].rating_code == "TV-MA"
