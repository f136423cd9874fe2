"""DataFrame helpers: pages and cuts per key, restriction to keys, salted joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import at

DAY_PREFIX = "day_of_"
#: The partition column of a log that is appended to in numbered batches.
BATCH = "batch_id"
#: Share of all rows above which a key is hot; there are at most 1 / HOT hot keys.
HOT = 1 / 256


def day_column(column: str) -> str:
    """The partition column of a table laid out by the day of ``column``."""
    return f"{DAY_PREFIX}{column}"


def undated(df: DataFrame) -> DataFrame:
    """Without the day and batch a stored table is laid out by, which would be missing or stale in changed rows."""
    return df.drop(BATCH, *[c for c in df.columns if c.startswith(DAY_PREFIX)])


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int | None,
    offset: int = 0,
    rank: str | None = None,
) -> DataFrame:
    """Rows ``offset+1 .. offset+k`` of every key in the given order.

    Spark cuts to ``offset + k`` rows per key in every input partition before
    the shuffle, so a key that holds most rows does not land in one task whole.
    (Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows, 1000 unless
    set.)  ``order`` should end with a unique column.  ``k=None`` keeps all rows.
    """
    if k is None and not offset and rank is None:
        return df
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn("_rn", number)
    if k is not None:
        out = out.filter(F.col("_rn") <= offset + k)
    if offset:
        out = out.filter(F.col("_rn") > offset)
    if rank is None:
        return out.drop("_rn")
    return out.withColumn("_rn", F.col("_rn").cast("bigint")).withColumnRenamed("_rn", rank)


def page(df: DataFrame, order: Sequence[Column], limit: int | None, offset: int = 0) -> DataFrame:
    """One page of a whole result."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def only_keys(df: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Restrict to the rows whose key columns appear in ``keys`` (None: all)."""
    return df if keys is None else df.join(keys, keys.columns, "left_semi").select(*df.columns)


def without_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Leave out the rows whose key columns appear in ``keys``."""
    return df.join(keys, keys.columns, "left_anti").select(*df.columns)


def _spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with a second key that is zero, or where a key is NULL a hash of the row: NULLs match nothing, so any task will do.

    The hash takes the first two other columns, ids as a rule, so that no further ones are read for it.
    """
    present = reduce(and_, [F.col(c).isNotNull() for c in columns])
    dealt = F.xxhash64(*[c for c in df.columns if c not in columns][:2])
    return df.withColumn("_spread", F.when(present, F.lit(0).cast("bigint")).otherwise(dealt))


def _zero(df: DataFrame) -> DataFrame:
    """``df`` with the second key zero, in a form that is not folded into a filter of the other side."""
    return df.withColumn("_spread", F.pmod(F.xxhash64(*df.columns), F.lit(1).cast("bigint")))


def without_references(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``without_keys`` for a column that may be NULL: such rows stay, spread over the tasks of the one join."""
    columns = [*keys.columns, "_spread"]
    return _spread(df, keys.columns).join(_zero(keys), columns, "left_anti").select(*df.columns)


def look_up(df: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """Left join on columns that are NULL in many rows; those get NULLs and are spread over the tasks of the join."""
    return _spread(df, columns).join(_zero(found), [*columns, "_spread"], "left").drop("_spread")


def in_range(
    log: DataFrame, column: str, start: dt.date | dt.datetime, end: dt.date | dt.datetime | None = None
) -> DataFrame:
    """Log rows from ``start`` to ``end``, both included; plain dates stand for midnight.

    A log stored by the day of this column is also cut by its day partitions,
    so the files of other days are not read.
    """
    moment, wanted = F.col(column), F.col(column) >= at(start)
    if end is not None:
        wanted = wanted & (moment <= at(end))
    if day_column(column) in log.columns:
        wanted = wanted & (F.col(day_column(column)) >= at(start).cast("date"))
        if end is not None:
            wanted = wanted & (F.col(day_column(column)) <= at(end).cast("date"))
    return log.filter(wanted)


def for_screen(df: DataFrame, asked: object | None, order: Sequence[Column]) -> DataFrame:
    """Sort when a screen asks for certain keys; leave whole-table results unsorted.

    A total order over every key of the platform would cost a range shuffle
    that nobody reads.
    """
    return df if asked is None else df.orderBy(*order)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name, merged in pairs so that a long list is analysed in few steps."""
    parts = list(parts)
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by keys to as many tasks as the session sets for a shuffle.

    Adaptive execution merges what an aggregate or a join asks for into tasks
    of a size in compressed bytes, which may be millions of narrow rows; these
    tasks it leaves apart.  Rows of one key meet in one task, so deal by keys
    that hold few rows each.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], salt_by: Sequence[str], salts: int = 16):
    """Inner join on a key with few distinct values.

    ``big`` rows of one key are spread over ``salts`` tasks by a hash of
    ``salt_by``; ``small`` is repeated once per salt, so use it for a side with
    few rows per key.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def split_join(big: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Inner join on a key that may hold most rows of ``big``; ``small`` has few rows per key.

    Keys are counted first.  Those with more than a share ``HOT`` of all rows
    are at most ``1 / HOT`` many: what ``small`` has of them is broadcast, so
    their rows stay where they are.  All others meet in a shuffle in which no
    key is hot.
    """
    big = big.filter(F.col(on).isNotNull())
    sizes = big.groupBy(on).agg(F.count("*").alias("_n"))
    hot = sizes.filter(F.col("_n") > sizes.agg(F.sum("_n")).scalar() * HOT).select(on)
    near = big.join(F.broadcast(small.join(F.broadcast(hot), on, "left_semi")), on)
    far = big.join(F.broadcast(hot), on, "left_anti").join(small.hint("shuffle_hash"), on)
    return near.unionByName(far)


def beyond(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], after: DataFrame | None) -> DataFrame:
    """The rows of each key that come after the row that ``after`` has of it; keys that ``after`` lacks are left out.

    ``order`` lists sort columns and whether they fall; falling ones have NULLs
    first, rising ones last.  A page by its predecessor's last row is cut
    before the shuffle like the first one, however deep it lies.
    """
    if after is None:
        return df
    last = after.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_a_{c}") for c, _ in order])
    later, equal = F.lit(False), F.lit(True)
    for c, falls in order:
        x, v = F.col(c), F.col(f"_a_{c}")
        beside = (v.isNull() & x.isNotNull()) if falls else (v.isNotNull() & x.isNull())
        later = later | (equal & (beside | F.coalesce(x < v if falls else x > v, F.lit(False))))
        equal = equal & x.eqNullSafe(v)
    same = reduce(and_, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    return df.join(last, same & later, "left_semi")
