"""Increments and state with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def file_stream(spark: SparkSession, path: str, pattern: str = "*.parquet", files_a_batch: int | None = None) -> DataFrame:
    """A stream over a folder's Parquet files; the source's log is the high-water mark, each file is read once."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (stream.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else stream).parquet(path)


def since(df: DataFrame, ts: str, mark) -> DataFrame:
    """The batch form of a high-water mark."""
    return df.where(F.col(ts) >= mark)


def late_deduplicated(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "48 hours") -> DataFrame:
    """One row a key within ``delay``: a re-read of late changes gives no row twice."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, ts: str, by: str, width: str = "1 day", delay: str = "48 hours") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(F.window(ts, width), by).agg(F.count("*").alias("n"))


def first_seen_stream(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """``key, first_seen`` as updates: the earliest time of each key so far, an aggregate's state."""
    return stream.groupBy(key).agg(F.min(F.col(ts).cast("timestamp_ntz")).alias("first_seen"))


class _Fresh(StatefulProcessor):
    """Lets a key's row pass when nothing is kept of the key; what is kept ends by itself after its time to live."""

    def __init__(self, ttl_ms: int, order: str):
        self.ttl_ms, self.order = ttl_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.passed = handle.getValueState("passed", T.StructType([T.StructField("n", T.LongType())]), self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            some = frame if first is None else pd.concat([first, frame])
            first = some.sort_values(self.order, kind="stable").head(1)
        if first is not None and not self.passed.exists():
            self.passed.update((1,))
            yield first

    def close(self) -> None:
        pass


def expiring(stream: DataFrame, key: str, order: str, keep_seconds: float = 30 * 86_400) -> DataFrame:
    """The first row of each key by ``order``, and again the first that comes after ``keep_seconds``, counted from the row before.

    State with a time to live, in time of processing: a decision that is older is
    asked for anew. Needs the RocksDB state store (``use_state_store``); run it with
    ``run_to_end(..., idle=False)``.
    """
    return stream.groupBy(key).transformWithStateInPandas(_Fresh(int(keep_seconds * 1000), order), stream.schema, "append", "ProcessingTime")


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


_BUCKET = "_bucket"


def current_version(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """``bucket, batch``: where the rows of each bucket are, after the last batch (before number ``before``); None if there is none.

    A batch counts from the moment its list of buckets is committed, which is one
    small file, so readers see all of a batch or nothing.
    """
    try:
        lists = spark.read.schema("bucket int, at long, batch long").parquet(f"{target}/buckets")
    except AnalysisException:
        return None
    lists = lists if before is None else lists.where(F.col("batch") < before)
    last = lists.agg(F.max("batch")).first()[0]
    return None if last is None else lists.where(F.col("batch") == last).select("bucket", F.col("at").alias("batch"))


def read_latest(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of all keys as the last whole batch left them."""
    now = current_version(spark, target)
    return None if now is None else _rows_of(spark, target, [(r.bucket, r.batch) for r in now.collect()])


def _rows_of(spark: SparkSession, target: str, places: Sequence[tuple[int, int]]) -> DataFrame:
    return spark.read.parquet(*(f"{target}/rows/batch={batch}/{_BUCKET}={bucket}" for bucket, batch in sorted(places)))


def upsert_latest(target: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keeps the latest row of each key in ``buckets`` by a hash of the key.

    A batch reads and writes only the buckets that its keys fall into; files of
    the others stay as they are. Then a new list of buckets is committed. A
    batch that runs again starts from the lists before it, so it gives the same.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark, names = batch.sparkSession, batch.columns
        rows = batch.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = {r[0] for r in rows.select(_BUCKET).distinct().collect()}  # ``buckets`` at most
        if not touched:
            return
        now = current_version(spark, target, number)
        there = {r.bucket: r.batch for r in now.collect()} if now is not None else {}
        old = [(b, there[b]) for b in touched if b in there]
        if old:
            known = _rows_of(spark, target, old).select(*names)
            rows = rows.unionByName(known.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        best = rows.groupBy(_BUCKET, *keys).agg(F.max(F.struct(*order, F.struct(*names).alias("_row"))).alias("_best"))
        best.select(_BUCKET, "_best._row.*").repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{target}/rows/batch={number}")
        places = sorted((there | dict.fromkeys(touched, number)).items())
        spark.createDataFrame(places, "bucket int, at long").coalesce(1).write.mode("overwrite").parquet(f"{target}/buckets/batch={number}")

    return merge


_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", idle: bool = True) -> DataFrame:
    """Runs a stream over what is there now into Parquet, and reads that; a later call goes on from the checkpoint.

    ``idle`` batches without rows let watermarks close windows. A stream of
    ``expiring`` must go without: by the clock it could always have one more.
    """
    spark = stream.sparkSession
    before = spark.conf.get(_IDLE)
    spark.conf.set(_IDLE, str(idle).lower())
    try:
        return _run_to_end(stream, path, checkpoint, mode)
    finally:
        spark.conf.set(_IDLE, before)


def _run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str) -> DataFrame:
    spark = stream.sparkSession
    if mode == "append":
        started = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    else:
        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

        started = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path) if mode == "append" else spark.read.parquet(path)


def failures_skipped(decisions: DataFrame, key: str, failed: str, most: int = 3) -> DataFrame:
    """Keys that failed ``most`` times or more, to be left out from now on."""
    return decisions.groupBy(key).agg(F.count_if(F.col(failed)).alias("failures")).where(F.col("failures") >= most)
