"""Physical plans: what must, and what must never, be in them."""

import re

import pytest

from showlake.operators import changes
from showlake.plans.change_queries import CHANGES
from showlake.plans.queries import READS
from showlake.sources.derive import HELPERS, platform_tables
from showlake.sources.tables import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Derived tables as plain scans, so plans show the operators alone."""
    derived = platform_tables(spark, SF)
    folder = tmp_path_factory.mktemp("stored")
    out = {}
    for name in derived:
        if name not in HELPERS:
            spark.createDataFrame([], derived[name].schema).write.parquet(f"{folder}/{name}")
            schema = derived[name].schema
            out[name] = lambda n=name, s=schema: spark.read.schema(s).parquet(f"{folder}/{n}")
    out["lines"] = lambda: derived["lines"]
    return Tables(out)


@pytest.fixture(scope="module")
def plan(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    every = {**READS, **CHANGES}
    yield lambda name: every[name](stored)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted({**READS, **CHANGES}))
def test_no_pairing_and_no_python(plan, name):
    text = plan(name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|InPandas", text)


@pytest.mark.parametrize(
    "name",
    ["r04_titles_by_genre", "r08_available_in", "r10_resume_points", "r11_continue_watching", "r14_title_reviews",
     "r21_billing_history", "r35_recent_watches", "k01_kids_browse", "k05_kids_home", "a18_top_rated_in_genre",
     "b27_favourite_genre"],
)
def test_cut_before_the_shuffle(plan, name):
    text = plan(name)
    assert "WindowGroupLimit" in text
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit", text)


@pytest.mark.parametrize("name", ["r01_catalog_search", "a01_title_engagement", "b01_top_watched", "b19_top_searches"])
def test_top_k_without_a_full_sort(plan, name):
    assert "TakeOrderedAndProject" in plan(name)


@pytest.mark.parametrize("name", ["b09_unwatched_content", "b28_listed_unwatched", "k06_kids_fallback"])
def test_anti_joins(plan, name):
    assert "LeftAnti" in plan(name)


def test_logs_are_summed_before_joins(plan):
    """The log's only shuffle carries partial sums per title."""
    assert re.search(
        r"Exchange[^\n]*\n[^\n]*partial_count\(1\)[^\n]*\n[^\n]*Filter[^\n]*\n[^\n]*FileScan parquet \[content_id#\d+L\]",
        plan("b01_top_watched"),
    )


def test_pushdown_and_pruning(plan):
    text = plan("a01_title_engagement")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(watched_at", text)
    schema = re.search(r"ReadSchema: struct<([^>]*watched_at[^>]*)>", text).group(1)
    assert "progress_seconds" not in schema and "watch_id" not in schema


def test_conversion_reads_each_log_once_without_joins(plan):
    text = plan("a22_search_conversion")
    assert text.count("FileScan parquet") == 2 and "Join" not in text


def test_small_change_sets_do_not_shuffle_the_table(spark, stored, make, tmp_path):
    new = make("profile_id long, content_id long, rating_value short, review_text string", (1, 1, 3, "x"))
    new.write.parquet(f"{tmp_path}/new")
    new = spark.read.parquet(f"{tmp_path}/new")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        kept = changes.delete_keys(stored["watch_history"], new.select("profile_id")).snapshot
        merged = changes.merge_upsert(stored["ratings"], new, ["profile_id", "content_id"], ["rating_value"], bulk=False)
        for frame in (kept, merged.snapshot):
            text = frame._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_deletes_read_each_child_once(spark, stored):
    """Also with a reference for every level, none of which is looked up by broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    gone = stored["content"].filter("status = 'Inactive'").select("content_id")
    after = changes.delete_cascade(stored, "content", gone).tables
    for child in ("ratings", "watch_history", "downloads"):
        text = after[child]._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(rf"FileScan[^\n]*/{child}\]", text)) == 1
    # rows without a reference are dealt out by a hash, which is not folded away
    ratings = after["ratings"]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[(season|episode|part)_id#\d+L, _spread#\d+L\]", ratings)) == 3


@pytest.mark.parametrize("name", ["v2_rules", "v3_rules", "v4_rules", "v5_rules"])
def test_key_rules_read_each_table_once(plan, name):
    """And, where references are checked, once more as a parent."""
    text = plan(name)
    for table in ("ratings", "watch_history", "downloads", "payments", "content_languages"):
        assert len(re.findall(rf"FileScan[^\n]*/{table}\]", text)) <= 1
    assert text.count("Exchange hashpartitioning") <= 4


@pytest.mark.parametrize("name", ["v2_rules", "v2_seeded", "v3_rules", "v3_seeded", "v4_rules", "v4_seeded"])
def test_unique_keys_are_not_summed_before_they_are_dealt(plan, name):
    """Keys that should be unique go to tasks that adaptive execution leaves apart; sums per map task would hold all of them."""
    text = plan(name)
    assert re.search(r"Exchange hashpartitioning\(rule#\d+, key#\d+, \d+\), REPARTITION_BY_NUM", text)
    assert not re.search(r"Exchange hashpartitioning\(rule#\d+, key#\d+, \d+\)[^\n]*\n[^\n]*HashAggregate", text)


def test_lines_and_ratings_are_joined_without_a_sort(spark):
    """A task of lines is millions of rows, its orders or titles are a fraction of them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        derived = platform_tables(spark, SF)
        for name in ("lines", "ratings"):
            text = derived[name]._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["b27_favourite_genre", "b27_favourite_genre_hot"])
def test_genre_sums_are_not_made_per_task_of_titles(plan, name):
    """Rows of a profile and genre are dealt out before they are summed, to tasks that adaptive execution leaves apart."""
    text = plan(name)
    assert re.search(r"Exchange hashpartitioning\(profile_id#\d+L, genre_name#\d+, \d+\), REPARTITION_BY_NUM", text)
    assert not re.search(r"Exchange hashpartitioning\(profile_id#\d+L, genre_name#\d+, \d+\)[^\n]*\n[^\n]*HashAggregate", text)


@pytest.mark.parametrize("name", ["v1_rules", "v1_seeded", "v7_rules", "v7_seeded"])
def test_row_rules_are_told_before_lines_are_shuffled(spark, name):
    """Lines meet their accounts and titles with the rules they break as a number, not with prices and names; ratings are made of pairs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = CHANGES[name](platform_tables(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    while re.search(r"\([^()]*\)", text):  # what is left of expressions is what they are called
        text = re.sub(r"\([^()]*\)", "", text)
    moved = re.findall(r"Exchange hashpartitioning, ENSURE[^\n]*\n[^\n]*Project \[([^\n]*)\]", text)
    assert sum("_broken_0" in columns for columns in moved) >= 4
    assert not any(re.search(r"l_(extendedprice|discount|quantity)#|watch_id|download_id|payment_id", columns) for columns in moved)
