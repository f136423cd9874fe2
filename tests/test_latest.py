"""States of the latest rows, batch-wise logs and tables laid out by key."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from showlake.functions import frames
from showlake.functions.columns import at
from showlake.operators import browse, changes, engagement, latest
from showlake.sources import tables
from showlake.sources.tables import Tables

WATCH = "watch_id long, profile_id long, content_id long, episode_id long, watched_at timestamp_ntz, watch_duration_seconds int, progress_seconds int, completed boolean"
KINDS = [latest.RESUME, latest.UNFINISHED, latest.RECENT_WATCHES]


def sessions(n, seed=1):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    return [
        (i, r.randrange(6), r.randrange(5), r.choice([None, 1, 2]), start + dt.timedelta(minutes=r.randrange(14400)), 100, r.randrange(100), r.random() < 0.4)
        for i in range(n)
    ]


@pytest.mark.parametrize("kind", KINDS)
def test_refreshed_state_equals_recomputation(spark, make, rows, tmp_path, kind):
    log = make(WATCH, *sessions(400))
    tables.append(log, f"{tmp_path}/log", "watched_at")
    stored = spark.read.parquet(f"{tmp_path}/log")
    kind = latest.Latest(kind.keys, kind.order, min(kind.k, 4), kind.where)
    state = latest.State(f"{tmp_path}/state", kind)
    assert state.last_day(spark) is None
    for day in (3, 4, 8, 8, 11):  # one day, several days, a repetition
        got = state.refresh(stored, dt.date(2024, 1, day))
        whole = kind.of(log.filter(F.col("watched_at") < at(dt.date(2024, 1, day) + dt.timedelta(days=1))))
        assert rows(got, *log.columns) == rows(whole, *log.columns)
    assert state.last_day(spark) == dt.date(2024, 1, 11)
    assert rows(state.load(spark, dt.date(2024, 1, 4)), "watch_id") == rows(kind.of(log.filter(F.col("watched_at") < at(dt.date(2024, 1, 5)))), "watch_id")
    assert state.rebuild(stored, dt.date(2024, 1, 2)).count() and state.last_day(spark) == dt.date(2024, 1, 11)
    again = kind.advanced(state.load(spark), stored.filter(F.col("watched_at") >= at(dt.date(2024, 1, 6))))  # rows that the state has
    assert rows(again, *log.columns) == rows(kind.of(log), *log.columns)


def test_a_refresh_reads_new_days_only(spark, make, tmp_path):
    tables.append(make(WATCH, *sessions(100)), f"{tmp_path}/log", "watched_at")
    stored = spark.read.parquet(f"{tmp_path}/log")
    state = latest.State(f"{tmp_path}/state", latest.RESUME)
    state.refresh(stored, dt.date(2024, 1, 6))
    plan = state.pending(stored, dt.date(2024, 1, 6), dt.date(2024, 1, 7))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day_of_watched_at#\d+ >= 2024-01-07", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*upto#\d+[^\]]* = 2024-01-06", plan)


def test_new_rows_yield_to_rows_of_the_state(make, rows):
    """Also where keys or ids are NULL or come several times, and where the state's row is the older one."""
    kind, ddl = latest.Latest(("profile",), ("at", "id"), k=2, where="at > 0"), "profile long, at long, id string, n int"
    state = make(ddl, (1, 5, "a", 1), (1, 4, "b", 2), (2, 3, None, 3), (None, 2, "d", 4))
    new = make(ddl, (1, 9, "a", 11), (1, 8, "a", 12), (1, 7, "c", 13), (2, 9, None, 14), (2, 8, "a", 15), (None, 9, "d", 16), (None, 0, "e", 17), (3, 6, "f", 18), (3, 6, "f", 18))
    assert rows(kind.advanced(state, new), "n") == [(1,), (3,), (4,), (13,), (15,), (18,), (18,)]


def test_a_state_is_read_once(make, tmp_path):
    make(WATCH, *sessions(60)).write.parquet(f"{tmp_path}/state")
    new = make(WATCH, *sessions(20, seed=2))
    advanced = latest.RESUME.advanced(new.sparkSession.read.parquet(f"{tmp_path}/state"), new)
    assert advanced._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_screens_on_a_state(make, rows):
    log, content = make(WATCH, *sessions(300)), make("content_id long, title string, poster_url string, content_type string", *[(i, f"t{i}", "p", "Movie") for i in range(5)])
    episodes = make("episode_id long, title string", (1, "a"), (2, "b"))
    T = Tables({"watch_history": lambda: log, "content": lambda: content, "episodes": lambda: episodes})
    for kind, screen in ((latest.RESUME, browse.resume_points), (latest.UNFINISHED, browse.continue_watching), (latest.RECENT_WATCHES, browse.recent_watches)):
        assert rows(screen(T.replace(watch_history=kind.of(log)))) == rows(screen(T))


def test_a_batch_counts_once(spark, make, rows, tmp_path):
    path, ddl = f"{tmp_path}/log", "search_id long, searched_at timestamp_ntz"
    day = lambda n: dt.datetime(2024, 1, n)
    tables.append_batch(make(ddl, (1, day(1)), (2, day(2))), path, 1, "searched_at")
    tables.append_batch(make(ddl, (3, day(2))), path, 2, "searched_at")
    tables.append_batch(make(ddl, (3, day(2))), path, 2, "searched_at")
    assert rows(spark.read.parquet(path), "search_id") == [(1,), (2,), (3,)]
    tables.append_batch(make(ddl, (1, day(1))), path, 1, "searched_at")  # without its second day
    log = spark.read.parquet(path)
    assert rows(log, "search_id") == [(1,), (3,)]
    assert frames.undated(log).columns == ["search_id", "searched_at"]
    assert rows(frames.in_range(log, "searched_at", dt.date(2024, 1, 2)), "search_id") == [(3,)]
    tables.append_batch(make(ddl), path, 3, "searched_at")
    assert spark.read.parquet(path).count() == 2


def test_a_stream_keeps_a_log(spark, make, rows, tmp_path):
    """Micro-batches are written once, also when the stream starts again, and spoilt rows go elsewhere."""
    ddl = "search_id long, search_query string, searched_at timestamp_ntz"
    moment = dt.datetime(2024, 1, 1, 12)
    guard = changes.LOG_GUARDS["search_history"]
    writer = tables.batch_writer(f"{tmp_path}/log", "searched_at", guard, f"{tmp_path}/rejected")
    for n in range(3):
        make(ddl, (2 * n, "x", moment), (2 * n + 1, " ", moment)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(ddl).parquet(f"{tmp_path}/in").writeStream.foreachBatch(writer)
        stream.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    writer(make(ddl, (4, "x", moment)), 2)  # the last batch once more
    assert rows(spark.read.parquet(f"{tmp_path}/log"), "search_id") == [(0,), (2,), (4,)]
    assert rows(spark.read.parquet(f"{tmp_path}/rejected"), "search_id") == [(1,), (3,)]


def test_a_large_day_is_split(spark, tmp_path):
    """Files of a day follow its size."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        big = spark.range(0, 200_000, 1, 40).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' as t", "uuid() as u")
        small = spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-02 00:00:00' as t", "uuid() as u")
        tables.append(big.unionByName(small), f"{tmp_path}/log", "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [len(list((tmp_path / "log" / f"day_of_t=2024-01-0{d}").glob("*.parquet"))) for d in (1, 2)]
    assert files[0] > 10 and files[1] == 1


@pytest.fixture
def bucketed(spark, make):
    log = make(WATCH, *sessions(200))
    listed = make("my_list_id string, profile_id long, content_id long, added_at timestamp_ntz", *[(str(i), i % 6, i % 5, dt.datetime(2024, 1, 1)) for i in range(0, 30, 3)])
    profiles = make("profile_id long, user_id long, is_primary boolean", *[(i, i // 2, i % 2 == 0) for i in range(6)])
    genres, tagged = make("genre_id long, genre_name string", (1, "a"), (2, "b")), make("content_id long, genre_id long", *[(i, i % 2 + 1) for i in range(5)])
    plain = Tables({"watch_history": lambda: log, "my_list": lambda: listed, "profiles": lambda: profiles, "genres": lambda: genres, "content_genres": lambda: tagged})
    names = ["watch_history", "my_list"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    tables.store_by_key(plain, names, "keyed_", buckets=4)
    yield plain, plain.replace(**tables.load_by_key(spark, names, "keyed_"))
    for name in names:
        spark.sql(f"drop table keyed_{name}")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def exchanges_above_scans_of(frame, table):
    """Exchanges on the way from a table's scan to the top of the plan."""
    lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
    found = 0
    for at, line in enumerate(lines):
        if "FileScan" in line and f"/keyed_{table}]" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for above in reversed(lines[:at]):
                indent = len(above) - len(above.lstrip(" :+-"))
                if indent < depth:
                    depth = indent
                    found += "Exchange hashpartitioning" in above
    return found


def test_tables_laid_out_by_key_are_not_shuffled(bucketed, rows):
    plain, keyed = bucketed
    pairs = keyed["watch_history"].filter("completed").select("profile_id", "content_id").distinct()
    plain_pairs = plain["watch_history"].filter("completed").select("profile_id", "content_id").distinct()
    gone = keyed["profiles"].filter("not is_primary").select("profile_id")
    forms = {
        "resume": (browse.resume_points(plain), browse.resume_points(keyed)),
        "toggle": (changes.toggle(plain["my_list"], plain_pairs, ["profile_id", "content_id"]).snapshot, changes.toggle(keyed["my_list"], pairs, ["profile_id", "content_id"]).snapshot),
        "cascade": (changes.delete_cascade(plain, "profiles", gone).tables["watch_history"], changes.delete_cascade(keyed, "profiles", gone).tables["watch_history"]),
    }
    for name, (one, other) in forms.items():
        assert rows(one) == rows(other, *one.columns), name
        assert exchanges_above_scans_of(other, "watch_history") == 0 and exchanges_above_scans_of(other, "my_list") == 0, name
    favourite = engagement.favourite_genre(keyed)
    assert rows(engagement.favourite_genre(plain)) == rows(favourite)


def test_hot_keys_do_not_meet_in_one_task(spark, rows):
    """Nine of ten rows name one title; they stay in the tasks that read them."""
    big = spark.range(0, 20_000, 1, 8).selectExpr("id", "if(id % 10 = 0, id % 97, 5) as k")
    small = spark.range(100).selectExpr("id as k", "id * 2 as v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = frames.split_join(big, small, "k")
        most = max(joined.groupBy(F.spark_partition_id()).count().toPandas()["count"])
        assert most <= 2 * 20_000 / 8
        plain = max(big.join(small, "k").groupBy(F.spark_partition_id()).count().toPandas()["count"])
        assert plain > 17_000
        assert joined.selectExpr("count(*)", "sum(id * v)").first() == big.join(small, "k").selectExpr("count(*)", "sum(id * v)").first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_pages_by_key_equal_pages_by_offset(make, rows):
    r = random.Random(3)
    data = [(i, i % 4, r.choice([None, dt.date(2024, 1, 1 + r.randrange(5))])) for i in range(120)]
    df = make("content_id long, genre_id long, release_date date", *data)
    order, sort = [F.desc_nulls_first("release_date"), F.asc("content_id")], [("release_date", True), ("content_id", False)]
    after = None
    for n in range(10):
        by_key = frames.top_per_key(frames.beyond(df, ["genre_id"], sort, after), ["genre_id"], order, 4)
        assert rows(by_key) == rows(frames.top_per_key(df, ["genre_id"], order, 4, 4 * n))
        last = frames.top_per_key(by_key, ["genre_id"], [F.asc_nulls_last("release_date"), F.desc("content_id")], 1)
        after = make("content_id long, genre_id long, release_date date", *[tuple(x) for x in last.collect()])
    rising = [("release_date", False), ("content_id", True)]
    start = make("genre_id long, release_date date, content_id long", (0, dt.date(2024, 1, 3), 40), (1, None, 41))
    got = {x[0] for x in rows(frames.beyond(df, ["genre_id"], rising, start), "content_id")}
    assert got == {i for i, g, d in data if (g == 0 and (d is None or d > dt.date(2024, 1, 3) or (d == dt.date(2024, 1, 3) and i < 40))) or (g == 1 and d is None and i < 41)}


def test_late_reports_and_closed_windows(make, rows):
    day = lambda n: dt.datetime(2024, 1, n)
    devices = make("device_id long, last_active_at timestamp_ntz", (1, day(5)), (2, None), (3, day(5)))
    seen = make("device_id long, seen_at timestamp_ntz", (1, day(4)), (2, day(1)), (2, day(2)), (3, day(6)), (4, day(1)))
    out = changes.ping_devices(devices, seen)
    assert rows(out.snapshot) == [(1, day(5)), (2, day(2)), (3, day(6))] and rows(out.changed, "device_id") == [(2,), (3,)]
    d = lambda n: dt.date(2024, 1, n)
    windows = make("availability_id long, available_from date, available_to date", (1, d(1), None), (2, d(1), d(20)), (3, d(1), d(5)), (4, d(15), None))
    closed = changes.close_windows(windows, "true", d(10)).snapshot
    assert rows(closed, "availability_id", "available_to") == [(1, d(10)), (2, d(10)), (3, d(5)), (4, None)]


def test_patch_moves_rows_between_days(spark, make, tmp_path):
    """A patched time is found under its new day, not under the old one."""
    log = make("search_id long, searched_at timestamp_ntz", (1, dt.datetime(2024, 1, 5)))
    tables.append(log, f"{tmp_path}/a", "searched_at")
    moved = make("search_id long, searched_at timestamp_ntz", (1, dt.datetime(2024, 2, 5)))
    out = changes.patch(spark.read.parquet(f"{tmp_path}/a"), moved, ["search_id"]).snapshot
    tables.overwrite(out, f"{tmp_path}/b", "searched_at")
    for frame in (out, spark.read.parquet(f"{tmp_path}/b")):
        found = [frames.in_range(frame, "searched_at", dt.date(2024, m, 1), dt.date(2024, m, 28)).count() for m in (1, 2)]
        assert found == [0, 1]
