"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes is summed by key and written as one partition of the
ledger; writing a batch again replaces what it wrote before, so a batch counts
once however often it is committed.  Totals are the sums over the ledger.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow

KEYS = ["source", "lang", "tokenizer"]
#: Longer texts are cut into words here, since the library's own cut fails on long runs of blanks; the tokens are the same.
LONG = 1 << 16
BATCH = 256


@lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> Callable[[str], int]:
    """How many tokens a text of any length has."""
    import regex
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    short = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    word = tiktoken.Encoding("word", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    words = regex.compile(pattern)

    def count(text: str) -> int:
        if len(text) <= LONG:
            return len(short.encode_ordinary(text))
        return sum(len(word.encode_ordinary(m.group())) for m in words.finditer(text))

    return count


def counted(documents: DataFrame, version: str, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, source, lang, tokenizer, n_tokens`` of every whole text; a null text counts as empty, with no tokens.

    ``ranks`` is the path of a byte-level BPE vocabulary that every executor
    can open.  Repeated rows are counted each; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(ranks, pattern)
        for batch in batches:
            sizes = [count(t.as_py()) for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(sizes, pa.int64())], ["doc_id", *KEYS, "n_tokens"]
            )

    given = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("tokenizer"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return in_arrow(given, run, "doc_id long, source string, lang string, tokenizer string, n_tokens long")


def inserted(counts: DataFrame) -> DataFrame:
    return _signed(counts, 1)


def deleted(counts: DataFrame) -> DataFrame:
    return _signed(counts, -1)


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts taken back and counted anew; source or language may change as well."""
    return deleted(before).unionByName(inserted(after))


def _signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (F.coalesce("n_tokens", F.lit(0)) * sign).alias("n_tokens"))


class Rollup:
    """A ledger of committed batches in a shared folder, and a total of its older part.

    A batch is written as a partition; Spark replaces an earlier attempt at it
    by deleting that and moving the new files in, so a reader may for a moment
    find the batch absent, but never twice.
    """

    KINDS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.ledger, self.closed = spark, f"{path}/ledger", f"{path}/closed"

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Add a batch, or put it in place of an earlier attempt at the same one.

        The changes are summed in every task before they are moved, so a hot
        source brings one row per task and key, and as many tasks finish and
        write the sums as their size asks for.  An empty row stands for a
        batch without changes.  A batch that ``close`` has summed is refused.
        """
        if batch <= self._upto():
            raise ValueError(f"batch {batch} is closed")
        nothing = self.spark.range(1).select(
            *(F.lit(None).cast("string").alias(k) for k in KEYS),
            F.lit(0).cast("long").alias("n_docs"),
            F.lit(0).cast("long").alias("n_tokens"),
        )
        rows = _summed(changes).unionByName(nothing).withColumn("batch", F.lit(batch).cast("long"))
        writer = rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(self.ledger)

    def close(self, batch: int) -> None:
        """Sum all batches up to ``batch`` into a total, so that ``totals`` no longer reads them.

        A total is written whole under its last batch's name and then stands;
        to close again up to the same or an earlier batch changes nothing.
        """
        if batch > self._upto():
            self._sums(batch).write.mode("overwrite").parquet(f"{self.closed}/upto={batch}")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` over all committed batches; keys that came to nothing are left out.

        A null source or language is a key of its own.  The last total and the
        batches after it are read.
        """
        return self._sums(None).filter("n_docs != 0 or n_tokens != 0")

    def _read(self, path: str, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{self.KINDS}, {name} long").option("basePath", path).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{self.KINDS}, {name} long")

    def _upto(self) -> int:
        last = self._read(self.closed, "upto").agg(F.max("upto")).first()[0]
        return -1 if last is None else last

    def _sums(self, batch: int | None) -> DataFrame:
        upto = self._upto()
        later = self._read(self.ledger, "batch").filter(F.col("batch") > upto)
        later = later if batch is None else later.filter(F.col("batch") <= batch)
        return _summed(self._read(self.closed, "upto").filter(F.col("upto") == upto).drop("upto").unionByName(later.drop("batch")))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
