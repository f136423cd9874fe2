"""Reading, completing and writing platform tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import at
from ..functions.frames import BATCH, day_column, undated
from . import schemas

# The age-rating scale, most to least suitable for children per system.
RATING_LEVELS = [
    ("G", "Movie", 1),
    ("PG", "Movie", 2),
    ("PG-13", "Movie", 3),
    ("R", "Movie", 4),
    ("NC-17", "Movie", 5),
    ("TV-Y", "TV", 6),
    ("TV-G", "TV", 7),
    ("TV-PG", "TV", 8),
    ("TV-14", "TV", 9),
    ("TV-MA", "TV", 10),
]


@dataclass(frozen=True)
class Early:
    """A table whose rows have all columns but the ``late`` ones before the joins that complete them.

    ``build(mark)`` gives the rows of the table with all of its columns and
    those that ``mark`` adds to the rows before they are joined; what is told
    there need not be carried through the joins.
    """

    late: frozenset[str]
    build: Callable[[Callable[[DataFrame], DataFrame]], DataFrame]


class Tables(Mapping[str, DataFrame]):
    """Name -> DataFrame; a table is only planned when it is first asked for.

    ``early`` holds those tables that can be looked at before their joins.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], early: Mapping[str, Early] | None = None):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        self.early = dict(early or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replace(self, **frames: DataFrame) -> Tables:
        """A copy in which the given tables are swapped for new snapshots."""
        out = Tables(self._builders, {name: e for name, e in self.early.items() if name not in frames})
        out._built = {**self._built, **frames}
        out._builders.update({name: (lambda df=df: df) for name, df in frames.items()})
        return out


def load_tables(spark: SparkSession, directory: str, gen: int = 2, views: bool = False) -> Tables:
    """Parquet tables ``directory/<table>`` with their declared schemas."""

    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(schemas.schema(name, gen)).parquet(f"{directory}/{name}")

    out = Tables({name: reader(name) for name in schemas.tables(gen)})
    if views:
        for name in out:
            out[name].createOrReplaceTempView(name)
    return out


def rating_levels(spark: SparkSession) -> DataFrame:
    """The seeded age-rating scale."""
    return spark.createDataFrame(RATING_LEVELS, "rating_code string, rating_system string, sort_order smallint")


def with_defaults(df: DataFrame, table: str, as_of: dt.datetime, gen: int = 2) -> DataFrame:
    """Bring ``df`` to the table's column order, filling absent columns.

    A column that is missing gets its default or NULL.  A given NULL stays
    NULL, as it does for an explicit NULL in an INSERT.
    """
    defaults = schemas.DEFAULTS.get(table, {})
    columns = []
    for field in schemas.schema(table, gen):
        if field.name in df.columns:
            column = F.col(field.name)
        else:
            value = defaults.get(field.name)
            column = at(as_of) if value is schemas.NOW else F.lit(value)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append rows to a stored table or log; rows that are appended again are there twice, see ``append_batch``.

    ``partition_by`` names a date or timestamp column; files are laid out by
    its day so later reads of a date range skip the other days.  Each day is
    written by as many tasks as its size asks for.
    """
    _write(df, path, partition_by, "append")


def overwrite(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Rebuild a stored table.  ``path`` must not be one that ``df`` reads."""
    _write(df, path, partition_by, "overwrite")


def append_batch(df: DataFrame, path: str, batch: int, partition_by: str | None = None) -> None:
    """Append a batch to a log once, however often it is sent: sent again, it takes the place of what it wrote before.

    A batch has a folder of its own, ``batch_id=<batch>``, so that nothing of
    an earlier attempt stays, not even on days that the new one lacks.  While
    a batch is replaced, a reader may find it absent; other batches are never
    touched.  Give every batch of one path the same ``partition_by``.
    """
    _write(df.drop(BATCH), f"{path}/{BATCH}={batch}", partition_by, "overwrite")


def batch_writer(
    path: str, partition_by: str | None = None, guard: str | Column | None = None, rejected: str | None = None
) -> Callable[[DataFrame, int], None]:
    """What ``writeStream.foreachBatch`` takes to keep a log: each micro-batch is written once.

    Rows that do not satisfy ``guard`` go to the log ``rejected``, or nowhere.
    """

    def write(df: DataFrame, batch: int) -> None:
        valid = F.lit(True) if guard is None else F.coalesce(F.expr(guard) if isinstance(guard, str) else guard, F.lit(False))
        append_batch(df.filter(valid), path, batch, partition_by)
        if rejected is not None:
            append_batch(df.filter(~valid), rejected, batch, partition_by)

    return write


def _write(df: DataFrame, path: str, partition_by: str | None, mode: str) -> None:
    plain = undated(df)
    if partition_by is None:
        plain.write.mode(mode).parquet(path)
    else:
        day = day_column(partition_by)
        # Rows of a day are brought together, and a day above Spark's target size of a task is split again.
        dated = plain.withColumn(day, F.col(partition_by).cast("date")).hint("rebalance", F.col(day))
        dated.write.mode(mode).partitionBy(day).parquet(path)


# The key by which each table is mostly joined and grouped.
LAYOUT = {
    "users": "user_id",
    "profiles": "user_id",
    "subscriptions": "user_id",
    "payments": "user_id",
    "user_devices": "user_id",
    "content": "content_id",
    "content_genres": "content_id",
    "content_languages": "content_id",
    "content_cast": "content_id",
    "content_availability": "content_id",
    "content_parts": "content_id",
    "seasons": "content_id",
    "watch_history": "profile_id",
    "my_list": "profile_id",
    "downloads": "profile_id",
    "search_history": "profile_id",
    "ratings": "profile_id",
    "profile_preferences": "profile_id",
    "profile_preferred_genres": "profile_id",
}


def store_by_key(T: Mapping[str, DataFrame], names: Iterable[str], prefix: str = "", buckets: int = 1024) -> None:
    """Tables of the catalogue, bucketed and sorted by the key of ``LAYOUT``.

    Grouping or joining by that key, alone or with others, reads buckets side
    by side and shuffles nothing.  Joins by more columns than the bucket's do
    so where ``spark.sql.requireAllClusterKeysForCoPartition`` is false.
    """
    for name in names:
        rows, key = undated(T[name]), LAYOUT[name]
        dealt = rows.repartition(buckets, key)
        dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(f"{prefix}{name}")


def load_by_key(spark: SparkSession, names: Iterable[str], prefix: str = "") -> Tables:
    """The tables that ``store_by_key`` wrote."""
    return Tables({name: (lambda n=name: spark.table(f"{prefix}{n}")) for name in names})
