import datetime as dt

import pytest
from pyspark.sql import functions as F

from showlake.functions import columns as c
from showlake.functions import frames


@pytest.mark.parametrize(
    "num, den, digits, expected",
    [
        (1, 3, 2, 0.33),
        (2, 3, 2, 0.67),
        (1, 8, 2, 0.13),
        (-1, 8, 2, -0.13),
        (201, 200, 2, 1.01),
        (5, 0, 1, None),
        (None, 2, 1, None),
        (10**15 + 5, 10, 0, float(10**14 + 1)),
    ],
)
def test_ratio(make, num, den, digits, expected):
    df = make("n long, d long", (num, den))
    assert df.select(c.ratio(F.col("n"), F.col("d"), digits)).first()[0] == expected


def test_money_percent(make):
    text = make("n string, d string", ("0.05", "0.40"))
    df = text.select(*[F.col(name).cast("decimal(28,2)") for name in ("n", "d")])
    assert df.select(c.pct(F.col("n"), F.col("d"), 1, scale=2)).first()[0] == 12.5


def test_contains_takes_wildcards_literally(make):
    df = make("t string", ("50% off",), ("500 off",), (None,))
    assert [r.t for r in df.filter(c.contains_ci("t", "0% OFF")).collect()] == ["50% off"]
    assert df.filter(c.starts_ci("t", "50_")).count() == 0


def test_window_open(make, rows):
    day = dt.date(2024, 1, 10)
    df = make(
        "id int, a date, b date",
        (1, dt.date(2024, 1, 10), None),
        (2, dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
        (3, dt.date(2024, 1, 11), None),
        (4, dt.date(2024, 1, 1), dt.date(2024, 1, 11)),
    )
    assert [r.id for r in df.filter(c.window_open(day, "a", "b")).collect()] == [1, 4]
    assert [r.id for r in df.filter(c.window_open(day, "a", "b", closed=True)).collect()] == [1, 2, 4]


def test_micros_ignore_time_zone(make):
    # 02:30 on this day does not exist in the session's time zone.
    moments = [dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(1960, 5, 1, 3, 4, 5, 6)]
    df = make("t timestamp_ntz", *[(m,) for m in moments])
    expected = [(m - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for m in moments]
    assert [r[0] for r in df.select(c.micros("t")).collect()] == expected


def test_top_per_key_pages(make, rows):
    df = make("k int, v int", *[(k, v) for k in (1, 2) for v in range(5)])
    cut = frames.top_per_key(df, ["k"], [F.desc("v")], 2, offset=1, rank="place")
    assert rows(cut) == [(1, 2, 3), (1, 3, 2), (2, 2, 3), (2, 3, 2)]
    assert frames.top_per_key(df, ["k"], [F.desc("v")], None).count() == 10


def test_salted_join_is_a_join(make, rows):
    big = make("id int, k int", *[(i, 0 if i % 3 else i % 5) for i in range(60)])
    small = make("k int, name string", (0, "a"), (0, "b"), (3, "c"))
    assert rows(frames.salted_join(big, small, ["k"], ["id"], salts=4), "id", "name") == rows(
        big.join(small, "k"), "id", "name"
    )
