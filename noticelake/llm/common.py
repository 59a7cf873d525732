"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder

#: A word of letters in any script.
LETTERS = re.compile(r"[^\W\d_]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_mod(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor))


def slim(df: DataFrame, id_col: str, text_col: str, *extra: str) -> DataFrame:
    """Only the columns an operator needs, so that other columns can't clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Cuts the lineage: after the loss of an executor nothing before it runs again.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that only a few texts at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_KEPT: list = []


def kept_by_worker(most: int = 1):
    """For what a worker keeps from task to task: the ``most`` last results of the function, until another such function is called.

    A worker that goes on to another operator so gives back the vocabularies and
    words of the one before.
    """

    def wrap(make):
        cached = lru_cache(maxsize=most)(make)
        _KEPT.append(cached)

        @wraps(make)
        def get(*args):
            others = [c for c in _KEPT if c is not cached and c.cache_info().currsize]
            for c in others:
                c.cache_clear()
            if others:
                _give_back()
            return cached(*args)

        return get

    return wrap


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


class Memo(dict):
    """A dict that computes missing entries and drops the older half when it is full.

    It only saves repeated work: an entry depends on its key alone.
    """

    def __init__(self, make: Callable[[Any], Any], most: int = 150_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            for old in list(islice(self, self.most // 2)):
                del self[old]
        value = self[key] = self.make(key)
        return value


def ranked_within(df: DataFrame, key: str, order: list[str], rows_a_part: int = 20_000) -> DataFrame:
    """Adds ``rank``, 0-based and gapless within ``key``, without bringing a key's rows together.

    Rows are dealt by a hash of ``order`` into parts; a row's rank is the rows of
    its key in parts before, and its place in its own part. Equal rows get ranks
    of their own in any order.
    """
    parts = max(1, -(-df.count() // rows_a_part))
    dealt = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select(key, "_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    placed = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    return placed.join(before, [key, "_part"]).withColumn("rank", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", most_broadcast: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``ids``.

    Up to ``most_broadcast`` ids, which are counted, go to all executors (some 50
    MB there at most) and the texts stay where they are; more are joined by a shuffle.
    """
    column = ids.columns[0]
    gone = written(ids.select(F.col(column).alias("_gone")).distinct(), "gone")
    side = F.broadcast(gone) if gone.count() <= most_broadcast else gone
    return docs.join(side, docs[id_col] == side["_gone"], "left_anti")
