"""The latest rows per key of a log, kept as a stored state that new days are merged into.

A screen needs a profile's last sessions, not its history.  ``Latest`` says
which rows those are; ``State`` keeps them, one version per day, and a refresh
reads the last version and the days since.  Screens take the state in place of
the log: ``browse.resume_points(T.replace(watch_history=state))``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.frames import in_range, top_per_key, undated

UPTO = "upto"


@dataclass(frozen=True)
class Latest:
    """The ``k`` latest rows per ``keys`` of those that satisfy ``where``; ``order`` starts with the log's time and ends unique."""

    keys: Sequence[str]
    order: Sequence[str]
    k: int = 1
    where: str = "true"

    def of(self, log: DataFrame) -> DataFrame:
        """From the whole log."""
        return top_per_key(undated(log).filter(self.where), self.keys, [F.desc(c) for c in self.order], self.k)

    def advanced(self, state: DataFrame, new: DataFrame) -> DataFrame:
        """``state`` after rows have come; rows that it has already change nothing.

        The state is at most ``k`` rows per key, so the cost follows the keys
        and the new rows, not the log.  It is read once: its rows and the new
        ones meet by key and id, where a new one yields to it, and what is left
        is cut per key before it meets by key.
        """
        fresh = undated(new).filter(self.where)
        both = state.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
        known = F.min("_new").over(Window.partitionBy(*self.keys, self.order[-1]))
        return self.of(both.withColumn("_known", known).filter(F.col("_new") == F.col("_known")).drop("_new", "_known"))


SESSION = ("watched_at", "watch_id")
RESUME = Latest(("profile_id", "content_id", "episode_id"), SESSION)
UNFINISHED = Latest(("profile_id", "content_id"), SESSION, where="not completed and progress_seconds > 0")
RECENT_WATCHES = Latest(("profile_id",), SESSION, k=50)
RECENT_SEARCHES = Latest(("profile_id",), ("searched_at", "search_id"), k=50)


class State:
    """Versions of a state under ``path``, each named by the last day that it covers.

    A version is written whole under its own name and never changed, so a
    refresh that fails or is repeated does no harm; old versions may be
    dropped.  Rows that arrive for days before the last version are not seen
    by a refresh: call ``rebuild`` after such repairs of the log.
    """

    def __init__(self, path: str, latest: Latest):
        self.path, self.latest = path, latest

    def _versions(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def last_day(self, spark: SparkSession) -> dt.date | None:
        found = self._versions(spark)
        return None if found is None else found.agg(F.max(F.col(UPTO).cast("date"))).first()[0]

    def load(self, spark: SparkSession, day: dt.date | None = None) -> DataFrame:
        """The version of ``day``, or the last one."""
        day = day or self.last_day(spark)
        return self._versions(spark).filter(F.col(UPTO) == F.lit(day)).drop(UPTO)

    def rebuild(self, log: DataFrame, day: dt.date) -> DataFrame:
        """A version from the log up to the end of ``day``."""
        return self._store(self.latest.of(self._days(log, None, day)), day)

    def refresh(self, log: DataFrame, day: dt.date) -> DataFrame:
        """The version of ``day`` from the last one and the days since, of which alone a log laid out by day is read."""
        spark = log.sparkSession
        last = self.last_day(spark)
        if last is None:
            return self.rebuild(log, day)
        if last >= day:
            return self.load(spark, last)
        return self._store(self.pending(log, last, day), day)

    def pending(self, log: DataFrame, last: dt.date, day: dt.date) -> DataFrame:
        """What a refresh from ``last`` to ``day`` stores."""
        state = self.load(log.sparkSession, last)
        return self.latest.advanced(state, self._days(log, last + dt.timedelta(days=1), day))

    def _days(self, log: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
        end = dt.datetime.combine(last, dt.time.max)
        return in_range(log, self.latest.order[0], first or dt.date(1, 1, 1), end)

    def _store(self, state: DataFrame, day: dt.date) -> DataFrame:
        state.write.mode("overwrite").parquet(f"{self.path}/{UPTO}={day}")
        return self.load(state.sparkSession, day)
