import datetime as dt
import random

import pytest

from showlake.operators import quality
from showlake.plans import change_queries, seeded
from showlake.sources import constraints
from showlake.sources.derive import platform_tables
from showlake.sources.tables import Tables

D = dt.date


def counts(T, rules):
    """Violations of the rules that could be checked; the others have to be reported as well."""
    found = {(r.table, r.rule): r.violations for r in quality.validate(T, rules).collect()}
    assert set(found) == {(r.table, r.name) for r in rules}
    return {rule: n for rule, n in found.items() if n is not None}


def test_rules_without_their_columns_are_reported(make):
    ratings = make("rating_id long, profile_id long, content_id long", (1, 1, 1), (1, 1, 1))
    rows = quality.validate({"ratings": ratings}, quality.rules(2, "v2", "v4")).collect()
    found = {(r.table, r.rule): r.violations for r in rows}
    assert found.pop(("ratings", "primary_key")) == 2
    assert set(found.values()) == {None} and any("season_id" in rule for t, rule in found if t == "ratings")


def test_rule_counts():
    kinds = {kind: len(quality.rules(2, kind)) for kind in quality.KINDS}
    assert kinds["v2"] == 25 and kinds["v3"] == 14 and kinds["v4"] == 9 and kinds["v5"] == 36
    assert kinds["v6"] + kinds["v7"] + kinds["v8"] == 39


def test_single_row_rules_let_null_pass(make):
    T = {
        "content": make(
            "content_id long, title string, content_type string, duration_minutes int, status string",
            (1, None, "Movie", 90, "Active"), (2, "x" * 256, "Series", 5, "Gone"), (3, "ok", None, 0, None),
        )
    }
    out = counts(T, quality.rules(2, "v1", "v6", "v7", "v8"))
    assert out["content", "title_not_null"] == 1 and out["content", "title_at_most_255"] == 1
    assert out["content", "status_allowed"] == 1 and out["content", "content_type_allowed"] == 0
    assert out["content", "duration_minutes_>_0"] == 1 and out["content", "series_without_duration"] == 1
    rule = next(r for r in quality.row_rules() if r.name == "series_without_duration")
    assert [r.content_id for r in quality.violations(T, rule).collect()] == [2]


def test_unique_rules(make):
    T = {
        "users": make("user_id long, email string, phone_number string", (1, "a", None), (1, "b", None), (3, "b", "1")),
        "downloads": make(
            "profile_id long, content_id long, episode_id long, device_id long, download_status string",
            (1, 1, None, 1, "Active"), (1, 1, None, 1, "Active"), (1, 1, None, 1, "Expired"),
            (1, 1, 5, 1, "Active"), (1, 1, 6, 1, "Active"),
        ),
    }
    out = counts(T, quality.rules(2, "v2", "v3", "v4"))
    assert out["users", "primary_key"] == 2 and out["users", "unique_email"] == 2
    assert out["users", "unique_phone_number"] == 0
    assert sorted(v for (t, _), v in out.items() if t == "downloads") == [0, 2]
    rule = next(r for r in quality.unique_rules() if r.columns == ("email",))
    assert sorted(r.user_id for r in quality.violations(T, rule).collect()) == [1, 3]


def test_keys_are_one_text_that_tells_values_apart(make):
    """Also where texts hold what stands between values; a key of one column is its text alone."""
    T = {"pairs": make("a string, b string, c long", ("x", "y", 1), ("x,1:y", "z", 1), ("x", "y,1:z", 1), ("1", "2", 12), ("12", "", 2), ("x", "y", 1))}
    several = quality.Rule("pairs", "several", "unique", ("a", "b", "c"))
    texts, numbers = quality.Rule("pairs", "texts", "unique", ("a", "b")), quality.Rule("pairs", "number", "unique", ("c",))
    assert quality._named_keys(T, "pairs", [several, texts, numbers]).dtypes == [("rule", "int"), ("key", "string")]
    assert counts(T, [several, texts, numbers]) == {("pairs", "several"): 2, ("pairs", "texts"): 2, ("pairs", "number"): 4}


def test_unique_keys_and_references_are_counted_together(make):
    """A table may have rules of both kinds; one key may hold most rows."""
    T = {
        "seasons": make("season_id long, content_id long", *[(1, 7)] * 40, (2, 8), (3, None), (None, 9)),
        "content": make("content_id long", (8,), (8,)),
    }
    key, title = quality.Rule("seasons", "key", "unique", ("season_id",)), quality.Rule("content", "title", "unique", ("content_id",))
    reference = quality.Rule("seasons", "title", "reference", ("content_id",), parent=("content", "content_id"))
    assert counts(T, [reference, key, title]) == {("seasons", "key"): 40, ("content", "title"): 2, ("seasons", "title"): 41}


def test_references(make):
    T = {
        "seasons": make("season_id long, content_id long", (1, 1), (2, 7), (3, 7), (4, None)),
        "content": make("content_id long", (1,)),
    }
    out = counts(T, quality.rules(2, "v5"))
    assert out == {("seasons", "content_id_in_content"): 2}
    rule = next(r for r in quality.reference_rules() if r.table == "seasons")
    assert sorted(r.season_id for r in quality.violations(T, rule).collect()) == [2, 3]


WINDOWS = "availability_id long, content_id long, country_code string, available_from date, available_to date"


def test_overlap_sees_containment(make):
    T = {
        "content_availability": make(
            WINDOWS,
            (1, 1, "A", D(2024, 1, 1), D(2024, 12, 1)),
            (2, 1, "A", D(2024, 2, 1), D(2024, 3, 1)),
            (3, 1, "A", D(2024, 4, 1), D(2024, 5, 1)),
            (4, 1, "A", D(2024, 12, 1), None),
            (5, 1, "B", D(2024, 1, 1), None),
            (6, 1, "B", D(2024, 1, 1), D(2024, 1, 2)),
            (7, 2, "A", D(2024, 1, 1), D(2024, 1, 1)),
            (8, 2, "A", D(2024, 1, 1), D(2024, 1, 5)),
        )
    }
    rule = quality.overlap_rules()[0]
    assert sorted(r.availability_id for r in quality.violations(T, rule).collect()) == [2, 3, 6]
    assert counts(T, [rule]) == {("content_availability", rule.name): 3}


@pytest.mark.parametrize("seed", range(3))
def test_overlap_against_all_pairs(make, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(80):
        start = D(2024, 1, 1) + dt.timedelta(rng.randrange(60))
        end = None if rng.random() < 0.05 else start + dt.timedelta(rng.randrange(6))
        rows.append((i, rng.randrange(3), rng.choice("AB"), start, end))
    last = D(9999, 12, 31)
    proper = [r for r in rows if (r[4] or last) > r[3]]
    expected = {
        w[0]
        for w in proper
        for o in proper
        if o[1:3] == w[1:3] and (o[4] or last) > w[3] and (o[3] < w[3] or (o[3] == w[3] and o[0] < w[0]))
    }
    T = {"content_availability": make(WINDOWS, *rows)}
    rule = quality.overlap_rules()[0]
    assert {r.availability_id for r in quality.violations(T, rule).collect()} == expected
    assert counts(T, [rule])[rule.table, rule.name] == len(expected)


def test_application_rules(make):
    T = {
        "users": make("user_id long, account_status string, email_verified boolean", (1, "pending", True), (2, "pending", False)),
        "subscriptions": make("subscription_id long, user_id long, plan_id int, status string", (1, 1, 1, "active")),
        "subscription_plans": make("plan_id int, max_profiles short", (1, 1)),
        "plan_allowed_devices": make("plan_id int, device_type string", (1, "tablet")),
        "profiles": make("profile_id long, user_id long", (11, 1), (12, 1), (21, 2)),
        "user_devices": make("device_id long, user_id long, device_type string", (1, 1, "tablet"), (2, 1, "laptop"), (3, 2, "laptop")),
        "content": make("content_id long, content_type string", (1, "Series"), (2, "Movie")),
        "seasons": make("season_id long, content_id long", (10, 1)),
        "episodes": make("episode_id long, season_id long", (101, 10)),
        "content_parts": make("part_id long, content_id long", (1, 1), (2, 2)),
        "watch_history": make("watch_id long, content_id long, episode_id long", (1, 1, 101), (2, 2, 101), (3, 2, None)),
        "ratings": make(
            "rating_id long, content_id long, season_id long, episode_id long, part_id long",
            (1, 2, 10, 101, None), (2, 1, 10, 101, None), (3, 1, None, None, 2),
        ),
    }
    out = counts(T, quality.application_rules())
    assert set(out.values()) == {1}
    assert len(out) == 8, "downloads are not among the tables"


def test_sound_data_has_no_orphans(spark):
    T = platform_tables(spark, "/root/testdata/sf0.001")
    out = counts(T, quality.rules(2, "v5"))
    assert len(out) >= 30 and set(out.values()) == {0}


def test_every_rule_finds_seeded_violations(spark):
    """Tables of keys alone, completed and spoilt by the recipe of the registered queries: no rule without a number, none without a find."""
    keys = {}
    for table, key in constraints.PRIMARY_KEYS.items():
        kinds = seeded.declared(table)
        of = {c: f"concat('key of a code',  id % {89 if i else 400})" if kinds[c] == "string" else f"cast(id % {89 if i else 400} as {kinds[c]})" for i, c in enumerate(key)}
        if table in ("ratings", "downloads"):  # of titles as a whole as well
            of |= {c: "if(id % 4 < 3, null, id)" for c in ("season_id", "episode_id", "part_id") if c in kinds}
        keys[table] = lambda e=[f"{x} as {c}" for c, x in of.items()]: spark.range(400).selectExpr(*e)
    wanted = [r for k in ("v1", "v2", "v3", "v4", "v5", "v6", "v7", "v8") for r in change_queries.quality_rules(k)]
    found = {(r["table"], r["rule"]): r["violations"] for r in quality.validate(seeded.seeded(Tables(keys)), wanted).collect()}
    assert len(found) == len(wanted) and [k for k, v in found.items() if not v] == []


def test_early_rows_are_those_of_the_tables(spark):
    """With every column, and with marks made before the joins, seeded or not; titles may be there twice or not at all."""
    derived = platform_tables(spark, "/root/testdata/sf0.001")
    for T in (derived, seeded.seeded(derived)):
        assert set(T.early) == {"payments", "watch_history", "downloads", "ratings"}
        for name, early in T.early.items():
            key = constraints.PRIMARY_KEYS[name][0]
            rows = early.build(lambda df, key=key: df.selectExpr("*", f"length({key}) as _mark"))
            assert rows.filter(f"not (_mark <=> length({key}))").isEmpty()
            plain, rows = T[name], rows.select(*T[name].columns)
            assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()


def test_rules_are_told_before_joins_as_after(spark):
    """More rules than a number has bits, late columns among them, and a table that was replaced."""
    T = seeded.seeded(platform_tables(spark, "/root/testdata/sf0.001"))
    many = [quality.Rule("payments", f"amount_{i}", "row", ("amount",), f"amount > {i}") for i in range(quality.BITS + 3)]
    named = [r for k in ("v1", "v6", "v7", "v8") for r in change_queries.quality_rules(k) if r.table in T.early]
    mixed = quality.Rule("watch_history", "mixed", "row", (), "profile_id > 0 or watch_duration_seconds > 0")
    wanted = [*dict.fromkeys([*many, *named, mixed])]
    plain = {name: T[name] for name in T.early}
    assert counts(T, wanted) == counts(plain, wanted)
    few = T.replace(payments=T["payments"].limit(5))
    assert "payments" not in few.early and counts(few, many[:1]).keys() == {("payments", "amount_0")}
    assert counts(few, [quality.Rule("payments", "none", "row", ("amount",), "false")]) == {("payments", "none"): 5}
