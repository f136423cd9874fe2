import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from showlake.operators import changes, quality
from showlake.sources.tables import Tables

D, TS = dt.date, dt.datetime
DAY = D(2024, 1, 31)
VOTES = "rating_id long, profile_id long, content_id long, stars int, updated_at timestamp_ntz"


@pytest.fixture(scope="module")
def votes(make):
    return make(VOTES, (1, 1, 1, 3, TS(2023, 1, 1)), (2, 1, 2, 4, TS(2023, 1, 1)), (3, None, 2, 1, TS(2023, 1, 1)))


@pytest.mark.parametrize("bulk", [False, True])
def test_upsert(make, rows, votes, bulk):
    new = make(VOTES, (9, 1, 2, 5, TS(2024, 1, 1)), (10, 2, 2, 2, TS(2024, 1, 1)), (11, None, 2, 2, TS(2024, 1, 1)))
    out = changes.merge_upsert(votes, new, ["profile_id", "content_id"], ["stars"], DAY, bulk=bulk)
    assert rows(out.snapshot, "rating_id", "stars") == [(1, 3), (2, 5), (3, 1), (10, 2), (11, 2)]
    assert rows(out.changed, "rating_id", "updated_at") == [
        (2, TS(2024, 1, 31)), (10, TS(2024, 1, 1)), (11, TS(2024, 1, 1)),
    ]
    again = changes.merge_upsert(out.snapshot, new.filter("profile_id is not null"), ["profile_id", "content_id"], ["stars"], DAY, bulk=bulk)
    same = ["rating_id", "profile_id", "content_id", "stars"]
    assert rows(again.snapshot, *same) == rows(out.snapshot, *same)
    assert again.snapshot.columns == votes.columns


@pytest.mark.parametrize("bulk", [False, True])
def test_upsert_null_safe(make, rows, bulk):
    ddl = "id int, season_id long, liked boolean"
    out = changes.merge_upsert(
        make(ddl, (1, None, False), (2, 5, False)), make(ddl, (8, None, True), (9, 6, True)), ["season_id"], ["liked"],
        null_safe=True, bulk=bulk,
    )
    assert rows(out.snapshot) == [(1, None, True), (2, 5, False), (9, 6, True)]


def test_upsert_of_a_repeated_key(make, rows, votes):
    twice = make(VOTES, (9, 1, 1, 5, TS(2024, 1, 1)), (10, 1, 1, 2, TS(2024, 1, 2)))
    keys = ["profile_id", "content_id"]
    with pytest.raises(Exception, match="touches a row twice"):
        changes.merge_upsert(votes, twice, keys, ["stars"]).snapshot.collect()
    last = changes.merge_upsert(votes, twice, keys, ["stars"], order=[F.desc("updated_at")])
    assert rows(last.snapshot, "rating_id", "stars")[0] == (1, 2)


@pytest.mark.parametrize("bulk", [False, True])
def test_insert_ignore(make, rows, bulk):
    ddl = "id int, k int, state string"
    target = make(ddl, (1, 1, "Active"), (2, 2, "Deleted"), (3, None, "Active"))
    new = make(ddl, (4, 1, "Active"), (5, 2, "Active"), (7, 3, "Active"), (6, 3, "Active"), (8, None, "Active"))
    out = changes.insert_ignore(target, new, ["k"], bulk=bulk)
    assert rows(out.changed, "id") == [(6,), (8,)]
    partial = changes.insert_ignore(target, new, ["k"], where="state = 'Active'", bulk=bulk)
    assert rows(partial.changed, "id") == [(5,), (6,), (8,)]
    same = changes.insert_ignore(target, new, ["k"], null_safe=True, bulk=bulk)
    assert rows(same.changed, "id") == [(6,)]


def test_append_valid(make, rows):
    logged = make("search_query string", ("a",), ("  ",), (None,))
    ok, rejected = changes.append_valid(logged, changes.LOG_GUARDS["search_history"])
    assert rows(ok) == [("a",)] and rejected.count() == 2


def test_numbered_rows_are_consecutive(make):
    target = make("id long, name string", (41, "x"))
    new = make("name string", *[(f"n{i}",) for i in range(200)])
    ids = sorted(r.id for r in changes.number_rows(target, new, "id", ["name"], buckets=7).collect())
    assert ids == list(range(42, 242))
    assert changes.number_rows(None, new, "id", ["name"]).agg(F.min("id"), F.max("id")).first()[:] == (1, 200)


def test_create_titles_and_profiles(make, rows):
    T = Tables(
        {
            "content": lambda: make("content_id long, title string, content_type string, status string", (5, "old", "Movie", "Active")),
            "content_genres": lambda: make("content_id long, genre_id long", (5, 1)),
            "content_languages": lambda: make(
                "content_language_id long, content_id long, language_id long, language_type string, is_default boolean"
            ),
            "profiles": lambda: make("profile_id long, user_id long, profile_name string", (3, 1, "a")),
            "profile_preferences": lambda: make("preference_id long, profile_id long, ui_theme string", (30, 3, "light")),
        }
    )
    new = make(
        "title string, content_type string, genre_ids array<long>, language_ids array<long>, "
        "language_types array<string>, is_default array<boolean>",
        ("one", "Movie", [1, 2], [7], ["Audio"], [True]),
        ("two", "Series", [], [7, 8], ["Both", "Audio"], [False, None]),
    )
    after = changes.create_titles(T, new, ["title"], TS(2024, 1, 1))
    ids = {r.title: r.content_id for r in after["content"].collect()}
    assert sorted(ids.values()) == [5, 6, 7] and ids["old"] == 5
    assert rows(after["content"].filter("title <> 'old'"), "status") == [("Active",), ("Active",)]
    assert rows(after["content_genres"]) == sorted([(5, 1), (ids["one"], 1), (ids["one"], 2)])
    tracks = rows(after["content_languages"], "content_language_id", "content_id")
    assert sorted(t[0] for t in tracks) == [1, 2, 3]
    assert sorted(t[1] for t in tracks) == sorted([ids["one"], ids["two"], ids["two"]])
    after = changes.create_profiles(T, make("user_id long, profile_name string", (1, "b")), ["user_id", "profile_name"], TS(2024, 1, 1))
    assert rows(after["profiles"], "profile_id", "is_kids") == [(3, None), (4, False)]
    assert rows(after["profile_preferences"], "preference_id", "profile_id", "ui_theme") == [(30, 3, "light"), (31, 4, "dark")]


def test_expand(make, rows):
    title = make("content_id long, langs array<long>, kinds array<string>", (1, [5, 6], ["Audio", "Subtitle"]), (2, [], []))
    out = changes.expand_insert(title, {"langs": "language_id", "kinds": "language_type"})
    assert rows(out) == [(1, 5, "Audio"), (1, 6, "Subtitle")]


def test_replace_children(make, rows):
    ddl = "profile_id long, genre_id long"
    out = changes.replace_children(
        make(ddl, (1, 1), (1, 2), (2, 1)), make("profile_id long", (1,)), make(ddl, (1, 3), (1, 99), (3, 1)),
        make("genre_id long", (1,), (3,)), "genre_id",
    )
    assert rows(out.snapshot) == [(1, 3), (2, 1)] and rows(out.changed) == [(1, 3)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sets(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=8),
    st.sets(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=8),
)
def test_toggle_twice_is_identity(make, rows, listed, pairs):
    ddl = "profile_id int, content_id int"
    target, change = make(ddl, *listed), make(ddl, *pairs)
    once = changes.toggle(target, change, ["profile_id", "content_id"]).snapshot
    assert {tuple(r) for r in once.collect()} == listed ^ pairs
    assert {tuple(r) for r in changes.toggle(once, change, ["profile_id", "content_id"]).snapshot.collect()} == listed


def test_updates(make, rows):
    users = make(
        "user_id long, account_status string, email_verified boolean, updated_at timestamp_ntz",
        (1, "pending", False, TS(2020, 1, 1)), (2, "suspended", False, TS(2020, 1, 1)),
    )
    out = changes.verify_email(users, "user_id < 9", DAY)
    assert rows(out.snapshot) == [(1, "active", True, TS(2024, 1, 31)), (2, "suspended", False, TS(2020, 1, 1))]
    assert rows(out.changed, "user_id") == [(1,)]
    moved = changes.update_where(users, "user_id = 2", {"updated_at": TS(2024, 3, 10, 2, 30)})
    assert rows(moved.changed, "updated_at") == [(TS(2024, 3, 10, 2, 30),)]
    titles = make("content_id long, status string", (1, "ComingSoon"), (2, "Inactive"), (3, None))
    assert rows(changes.set_status(titles, "content_id < 9", "ComingSoon", "Active", DAY).snapshot) == [(1, "Active"), (2, "Inactive"), (3, None)]


def test_patch(make, rows):
    titles = make("content_id long, title string, description string", (1, "a", "b"), (2, "c", "d"))
    change = make("content_id long, title string, description string", (1, None, "new"), (7, "x", "y"))
    out = changes.patch(titles, change, ["content_id"])
    assert rows(out.snapshot) == [(1, "a", "new"), (2, "c", "d")] and rows(out.changed, "content_id") == [(1,)]


SUBS = (
    "subscription_id long, user_id long, plan_id int, status string, billing_cycle string, start_date date, "
    "end_date date, next_billing_date date, auto_renew boolean, cancelled_at timestamp_ntz, cancellation_reason string"
)


@pytest.fixture(scope="module")
def subs(make):
    return make(
        SUBS,
        (1, 1, 1, "active", "monthly", D(2023, 1, 1), None, DAY, True, None, None),
        (2, 2, 1, "active", "yearly", D(2023, 1, 1), None, DAY, True, None, None),
        (3, 3, 1, "active", "monthly", D(2023, 1, 1), None, DAY, False, None, None),
        (4, 4, 1, "paused", "monthly", D(2023, 1, 1), None, DAY, True, None, None),
    )


def test_lifecycle(subs, rows):
    assert rows(changes.cancel(subs, "user_id = 1", "price", DAY).changed, "status", "auto_renew", "next_billing_date", "cancellation_reason") == [
        ("cancelled", False, None, "price")
    ]
    assert rows(changes.resume(subs, "true", DAY).changed, "user_id", "status", "next_billing_date") == [
        (4, "active", D(2024, 2, 29))
    ]
    assert rows(changes.renew(subs, DAY).changed, "user_id", "next_billing_date") == [
        (1, D(2024, 2, 29)), (2, D(2024, 2, 29)),
    ]
    assert rows(changes.renew(subs, DAY, by_cycle=True).changed, "user_id", "next_billing_date")[1] == (2, D(2025, 1, 31))


def test_payments_count_once(make, rows, subs):
    ddl = "payment_id long, subscription_id long, transaction_id string, payment_status string"
    stored = make(ddl, (1, 1, "t1", "completed"))
    incoming = make(
        ddl, (2, 1, "t1", "completed"), (3, 1, "t2", "completed"), (4, 1, "t2", "completed"),
        (5, 1, "t3", "completed"), (6, 2, "t4", "completed"), (7, 3, "t5", "failed"),
    )
    out = changes.apply_payments(stored, subs, incoming)
    assert rows(out.payments.changed, "transaction_id") == [("t2",), ("t3",), ("t4",), ("t5",)]
    # Two months after January 31, by way of February 29.
    assert rows(out.subscriptions.changed, "subscription_id", "next_billing_date") == [(1, D(2024, 3, 29))]


def test_refund(make, rows):
    pays = make(
        "payment_id long, a int, payment_status string", (1, 10, "completed"), (2, 10, "failed"), (3, 10, "completed")
    ).selectExpr(
        "payment_id", "cast(a as decimal(10,2)) amount", "cast(0 as decimal(10,2)) refund_amount", "payment_status",
        "cast(null as timestamp_ntz) refunded_at",
    )
    asked = make("payment_id long, refund_amount int", (1, 99), (2, 1), (3, 4), (3, 9))
    out = changes.refund(pays, asked, DAY)
    assert [(r[0], float(r[1]), r[2]) for r in rows(out.snapshot, "payment_id", "refund_amount", "payment_status")] == [
        (1, 10.0, "refunded"), (2, 0.0, "failed"), (3, 4.0, "refunded"),
    ]


def test_exclusive_flag(make, rows):
    profiles = make("profile_id long, user_id long, is_primary boolean", (1, 1, True), (2, 1, False), (3, 2, True))
    out = changes.set_exclusive(profiles, ["user_id"], "profile_id", "is_primary", make("user_id long, profile_id long", (1, 2)))
    assert rows(out.snapshot) == [(1, 1, False), (2, 1, True), (3, 2, True)]
    assert rows(out.changed, "profile_id") == [(1,), (2,)]


def test_change_plan(make, rows, subs):
    out = changes.change_plan(subs, make("user_id long, plan_id int, billing_cycle string", (1, 2, "yearly")), DAY)
    assert rows(out.changed, "subscription_id", "plan_id", "status", "end_date", "next_billing_date") == [
        (1, 1, "expired", DAY, None), (5, 2, "active", None, D(2024, 2, 29)),
    ]


@pytest.fixture(scope="module")
def small(make):
    frames = {
        "users": make("user_id long", (1,), (2,)),
        "profiles": make("profile_id long, user_id long", (11, 1), (21, 2)),
        "user_devices": make("device_id long, user_id long", (111, 1), (211, 2)),
        "subscriptions": make("subscription_id long, user_id long, plan_id int", (9, 2, 1)),
        "payments": make("payment_id long, subscription_id long, user_id long", (8, 9, 2)),
        "content": make("content_id long", (1,), (2,)),
        "seasons": make("season_id long, content_id long", (10, 1), (20, 2)),
        "episodes": make("episode_id long, season_id long", (101, 10), (201, 20)),
        "ratings": make(
            "rating_id long, profile_id long, content_id long, season_id long, episode_id long",
            (1, 11, 1, None, None), (2, 21, 2, 20, 201), (3, 21, 2, 10, None), (4, 21, 2, None, None),
        ),
        "watch_history": make("watch_id long, profile_id long, content_id long, episode_id long", (1, 21, 2, 101), (2, 11, 2, 201), (3, 21, 1, 101)),
        "search_history": make("search_id long, profile_id long, device_id long", (1, 21, 111), (2, 11, 211)),
        "downloads": make("download_id long, profile_id long, content_id long, episode_id long, device_id long", (1, 21, 2, None, 111)),
        "profile_preferred_genres": make("profile_id long, genre_id long", (11, 1)),
    }
    return Tables({name: (lambda df=df: df) for name, df in frames.items()})


def _orphans(T):
    found = quality.validate(T, quality.rules(2, "v5")).filter("violations > 0")
    return found.count()


def test_delete_user_cascades(make, rows, small):
    out = changes.delete_cascade(small, "users", make("user_id long", (1,)))
    assert out.blocked.count() == 0
    assert rows(out.tables["profiles"]) == [(21, 2)]
    assert rows(out.tables["search_history"]) == [(1, 21, None)], "the device is gone, the search stays"
    assert out.tables["downloads"].count() == 0 and out.tables["profile_preferred_genres"].count() == 0
    assert rows(out.tables["watch_history"], "watch_id") == [(1,), (3,)]
    blocked = changes.delete_cascade(small, "users", make("user_id long", (2,))).blocked
    assert rows(blocked) == [("payments", "user_id", 1), ("subscriptions", "user_id", 1)]


def test_delete_title_leaves_no_orphans(make, rows, small):
    out = changes.delete_cascade(small, "content", make("content_id long", (1,)))
    assert rows(out.tables["ratings"], "rating_id") == [(2,), (4,)]
    assert rows(out.tables["watch_history"], "watch_id", "episode_id") == [(1, None), (2, 201)]
    before, after = _orphans(small), _orphans(out.tables)
    assert (before, after) == (0, 0)


def test_primary_profiles_stay(make, rows, small):
    T = small.replace(profiles=make("profile_id long, user_id long, is_primary boolean", (11, 1, True), (21, 2, False)))
    out = changes.delete_profiles(T, make("profile_id long", (11,), (21,)))
    assert rows(out.tables["profiles"], "profile_id") == [(11,)]
    assert rows(out.tables["ratings"], "rating_id") == [(1,)]


def test_deletes(make, rows):
    log = make("watch_id long, profile_id long", (1, 1), (2, 2), (3, None))
    assert rows(changes.delete_keys(log, make("profile_id long", (1,))).snapshot, "watch_id") == [(2,), (3,)]
    gone = changes.delete_where(log, "profile_id = 2")
    assert rows(gone.snapshot, "watch_id") == [(1,), (3,)] and rows(gone.changed, "watch_id") == [(2,)]


def test_ids_need_a_unique_order(make):
    new = make("name string", ("a",), ("a",))
    with pytest.raises(Exception, match="share name"):
        changes.number_rows(None, new, "id", ["name"]).collect()
