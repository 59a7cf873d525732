"""Importance resampling towards a target distribution, over hashed word n-grams.

A document is normalised to its words with one space between and scanned once:
the CRC of everything up to each word's end is stored. Any n-gram's CRC follows
from two such prefixes: that before its first word, shifted by the n-gram's length
over GF(2), cancels out of that after its last word. N-grams fall into buckets by
their CRC; how much more frequent a bucket is in the target than in the documents
gives its gain, and a document's weight is the mean of its n-grams' gains. Gumbel
noise from a digest of the id makes the highest scores a sample without replacement.

Counts cover all documents and all of the target. The driver gets a count a bucket,
a count a score and the sizes of the ranges that the drawn rows are sorted into.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces, table, written

LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, "2024"

_POLYNOMIAL = 0xEDB88320
_TO_SPACE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_U8 = np.uint32(8)
_FF = np.uint32(255)


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), out >> np.uint32(1)).astype(np.uint32)
    return out


_BYTE = _byte_table()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map over GF(2), given as a table for each of the four bytes."""
    return tables[0][crc & _FF] ^ tables[1][crc >> _U8 & _FF] ^ tables[2][crc >> np.uint32(16) & _FF] ^ tables[3][crc >> np.uint32(24)]


@lru_cache(maxsize=64)
def _shift_tables(power: int) -> np.ndarray:
    """What 2**power zero bytes make of a CRC's register, as tables by byte."""
    one = np.arange(256, dtype=np.uint32)
    words = np.stack([one, one << _U8, one << np.uint32(16), one << np.uint32(24)])
    if power == 0:
        return (words >> _U8) ^ _BYTE[words & _FF]
    half = _shift_tables(power - 1)
    return _apply(half, _apply(half, words))


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC moved on by as many bytes as its length says."""
    out, power = crc.copy(), 0
    while (left := lengths >> power).any():
        at = np.flatnonzero(left & 1)
        out[at] = _apply(_shift_tables(power), out[at])
        power += 1
    return out


@dataclass(frozen=True)
class Prefixes:
    """Of one normalised text: CRCs and places before the first byte and after the last of each word."""

    before: np.ndarray
    after: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def ngrams(self, n: int) -> np.ndarray:
        """The CRC of each run of ``n`` words, single spaces between."""
        if len(self.after) < n:
            return np.zeros(0, np.uint32)
        last = n - 1
        before = self.before[: len(self.before) - last]
        return self.after[last:] ^ shifted(before, self.ends[last:] - self.starts[: len(before)])


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split() if text else []


def prefixes(words: list[bytes]) -> Prefixes:
    """One scan. A space stands before each word, the first too."""
    after = np.empty(len(words), np.uint32)
    crc, crc32 = 0, zlib.crc32
    for k, word in enumerate(words):
        crc = after[k] = crc32(b" " + word, crc)
    earlier = np.concatenate([np.zeros(min(1, len(words)), np.uint32), after[:-1]]) ^ np.uint32(0xFFFFFFFF)
    before = (earlier >> _U8) ^ _BYTE[(earlier ^ np.uint32(32)) & _FF] ^ np.uint32(0xFFFFFFFF)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1)
    return Prefixes(before, after, ends - sizes, ends)


def hashed_ngrams(texts: list[str | None], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some texts, and how many of them each text has; n-grams don't cross texts."""
    parts, counts = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        there = prefixes(words_of(text))
        for n in range(1, longest + 1):
            found = there.ngrams(n)
            counts[k] += len(found)
            parts.append(found)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)).astype(np.int64) % buckets, counts


def bucket_counts(df: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall into each bucket; ``buckets`` numbers are all that the driver gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches, 64):
            total += np.bincount(hashed_ngrams(batch.column("text").to_pylist(), longest, buckets)[0], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of each bucket."""
    k, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((b + 1) * (s + k)) / ((a + 1) * (t + k)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(df: DataFrame, gains: np.ndarray, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row; weight is the floored mean gain, 0 without features."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            texts = batch.column("text").to_pylist()
            found, counts = hashed_ngrams(texts, longest, buckets)
            sums = np.diff(np.concatenate([[0], np.cumsum(gains[found])])[np.concatenate([[0], np.cumsum(counts)])])
            n_words = [len(words_of(t)) for t in texts] if longest > 1 else counts
            weight = np.floor_divide(sums, np.maximum(counts, 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(counts), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    slim = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: str = SEED) -> Column:
    """floor(1000 * Gumbel noise) from a digest of seed and id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def with_ranks(scored: DataFrame, draw: int, rows_a_range: int = 200_000) -> DataFrame:
    """Adds ``rank``, 1 to ``draw`` by falling ``score``, then ``doc_id`` (nulls last), to the eligible rows; null to others.

    ``scored`` is a written table. A count of rows by score gives the score that
    the last drawn row has; rows from there on are sorted into ranges, and a row's
    rank is the rows of the ranges before and its place in its own. Rows that are
    equal in score and id are drawn in the order of ``at``, so a frequent id splits as well.
    """
    counts = scored.where("eligible").groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    reached, least = 0, None
    for r in counts:  # scores are whole numbers of a bounded range, some 100,000 at most
        if reached >= draw:
            break
        reached, least = reached + r.n, r.score
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = F.col("eligible") & (F.col("score") >= least)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("at")]
    ranges = max(1, -(-reached // rows_a_range))
    dealt = written(scored.where(high).repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = {r[0]: r.n for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    before, rows = 0, []
    for k in sorted(sizes):
        rows.append((k, before))
        before += sizes[k]
    starts = scored.sparkSession.createDataFrame(rows, "_range int, _before long")
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    drawn = dealt.join(F.broadcast(starts), "_range").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))).select(*scored.columns, "rank")
    return drawn.unionByName(scored.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row; rank is null where it isn't drawn.

    Texts that are null or empty have no words and weight 0, and are not drawn
    while ``least_words`` is over 0. Repeated rows are drawn each. Without a target
    every gain comes from the documents alone; without documents there are no rows.
    """
    gains = gains_of(bucket_counts(docs, longest, buckets, text_col), bucket_counts(target, longest, buckets, target_text))
    rows = weighted(docs, gains, longest, id_col, text_col)
    scored = written(rows.select("*", (F.col("weight") + gumbel("doc_id", seed)).alias("score"), (F.col("n_words") >= least_words).alias("eligible"), F.monotonically_increasing_id().alias("at")), "scored")
    draw = percent * scored.where("eligible").count() // 100
    return with_ranks(scored, draw).drop("eligible", "at")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards ``benchmark``, its score, and its rank if it is drawn."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: CRC-32 of each distinct word, a byte at a time; everything else as in the query.
OP12_SQL = rf"""WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
 docs AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS ws FROM documents),
 source AS (SELECT doc_id, unnest(ws) AS w FROM docs), target AS (SELECT unnest({_WORDS_SQL}) AS w FROM benchmark),
 spelled AS (SELECT w, list_transform(range(strlen(w)), lambda k: ('0x' || substr(hex(encode(w)), CAST(2 * k + 1 AS BIGINT), 2))::BIGINT) AS bytes FROM (SELECT w FROM source UNION SELECT w FROM target)),
 hashed AS (SELECT w, xor(list_reduce([4294967295] || bytes, lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket FROM spelled, crc_table),
 s AS (SELECT bucket, count(*) AS s FROM source JOIN hashed USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM target JOIN hashed USING (w) GROUP BY 1),
 totals AS (SELECT (SELECT count(*) FROM source) AS s_all, (SELECT count(*) FROM target) AS t_all),
 gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), totals),
 weights AS (SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM source JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY 1),
 scores AS (SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM docs LEFT JOIN weights USING (doc_id)),
 ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
 SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scores LEFT JOIN ranked USING (doc_id)"""
