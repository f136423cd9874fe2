"""Shared folders, stored intermediate tables and joins that stand hot keys."""

from __future__ import annotations

import math
import os
from collections.abc import Sequence
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys with more than this share of all rows meet their group by broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one; other columns, whatever their names, stay behind."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def in_arrow(df: DataFrame, run, schema, pandas: bool = False) -> DataFrame:
    """``mapInArrow`` (or ``mapInPandas``) whose workers also look for modules where this package lies."""
    found = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in found.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        found["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInPandas(run, schema) if pandas else df.mapInArrow(run, schema)


def join_groups(rows: DataFrame, groups: DataFrame, on: Sequence[str], size: str, share: float = HOT_SHARE) -> DataFrame:
    """Every row with the columns of its group; ``groups`` has one row per key, with the number of its rows in ``size``.

    ``on`` must not be null.  Groups above ``share`` of all rows are at
    most ``1 / share`` many, so they are broadcast and their rows stay
    where they are; the other rows meet their groups in a shuffle in which no
    key is hot.  Both inputs are read twice and should be stored ones.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = math.floor(total * share)
    hot = F.broadcast(groups.filter(F.col(size) > least))
    cold = groups.filter(F.col(size) <= least)
    near = rows.join(hot, list(on))
    return near.unionByName(rows.join(hot.select(*on), list(on), "left_anti").join(cold, list(on)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge, ``root`` being the smallest node it is connected to.

    Alternating large-star and small-star rounds; each round is stored, and
    the loop ends when the set of edges stands still.  Nothing but a count and
    a checksum reaches the driver.  The one key with many edges is a root; the
    join on nodes is followed by an exchange, so adaptive execution can split
    it.
    """
    pairs = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("root")
    )
    pairs, before = stored(pairs.distinct(), "edges"), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("low"))
        large = both.join(least, "node").filter(F.col("root") > F.col("node")).select(
            F.col("root").alias("node"), F.col("low").alias("root")
        )
        large = large.filter("node != root").distinct()
        least = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(least, "node").select(
            F.explode(F.array(F.struct("node", F.col("low").alias("root")), F.struct(F.col("root").alias("node"), F.col("low").alias("root")))).alias("e")
        )
        pairs = stored(small.select("e.*").filter("node != root").distinct(), "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs
        before = now
