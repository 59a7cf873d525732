"""Similarity, range and cross-reference joins: candidates by equal tokens or keys, never by all pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nonempty, tokens
from .ranking import top_rows


def token_overlap(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_text: str, right_text: str, least_shared: int, least_length: int = 3) -> DataFrame:
    """Pairs that share at least ``least_shared`` different tokens: ``left_id, right_id, shared``.

    Every token counts, however many rows hold it. A frequent token's rows are
    dealt out by the adaptive skew join, and counts are summed before the shuffle.
    """
    a = left.select(F.col(left_id), F.explode(tokens(F.col(left_text), least_length)).alias("token"))
    b = right.select(F.col(right_id), F.explode(tokens(F.col(right_text), least_length)).alias("token"))
    return a.join(b, "token").groupBy(left_id, right_id).agg(F.count("*").alias("shared")).where(F.col("shared") >= least_shared)


def best_match(pairs: DataFrame, left_id: str, right_id: str, score: str, least: float = 0.0) -> DataFrame:
    """The best right row of each left one, the smaller id of equals."""
    return top_rows(pairs.where(F.col(score) >= least), [left_id], [F.desc(score), F.col(right_id)], 1).drop("rank")


def shared_counts(left: DataFrame, right: DataFrame, features: Sequence[str], block: str, left_id: str, right_id: str, left_date: str, right_date: str, most_days: int) -> DataFrame:
    """Pairs that share an element of a feature: ``left_id, right_id`` and, by feature, how many they share.

    Features are array columns of both sides. Blocks must be equal and dates
    within ``most_days`` only where both sides have one: rows without meet all.
    Days are cut into buckets of four ranges, so a left row has one or two and a
    right row one. Rows with block and date meet in their block and bucket, once
    a pair, and their arrays are compared there. Pairs with a row that lacks one
    meet by each element they share, so that none meets all rows; without such
    rows that part is empty. Ids are distinct.
    """
    reach, width = F.lit(most_days), F.lit(4 * max(1, most_days))
    days = F.coalesce(F.abs(F.datediff("_day", "_other")), F.lit(0))
    near = (days <= most_days) & (F.col(left_id) != F.col(right_id))

    def rows(df: DataFrame, own: str, date: str, day: str, side: str) -> DataFrame:
        at = F.unix_date(F.to_date(date))
        bucket = lambda d: F.floor(d / width).cast("long")
        buckets = F.array_distinct(F.array(bucket(at - reach), bucket(at + reach))) if side == "_l" else F.array(bucket(at))
        held = (F.coalesce(f, F.array().cast("array<string>")).alias(f"{side}{k}") for k, f in enumerate(features))
        return df.select(F.col(own), F.to_date(date).alias(day), nonempty(F.col(block).cast("string")).alias("_block"), F.when(at.isNotNull(), buckets).alias("_bucket"), *held)

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.explode("_bucket"))

    def by_element(df: DataFrame, side: str) -> DataFrame:
        """A row of each element and key: ``=`` is its own block or bucket, met by equals, ``-`` and ``*`` are met where the other or this side has none."""
        meets = lambda c, mine: F.when(c.isNull(), F.array(F.lit("*")) if side == "_l" else F.array(F.lit("-"), F.lit("*"))).otherwise(F.concat(F.transform(mine, lambda m: F.concat(F.lit("="), m.cast("string"))), F.array(F.lit("-") if side == "_l" else F.lit("*"))))
        named = lambda k: lambda t: F.struct(F.lit(k).alias("k"), t.alias("t"))
        held = F.concat(*(F.transform(F.array_distinct(f"{side}{k}"), named(k)) for k in range(len(features))))
        out = df.withColumns({"_block": meets(F.col("_block"), F.array("_block")), "_bucket": meets(F.col("_bucket"), F.col("_bucket")), "_held": held}).drop(*(f"{side}{k}" for k in range(len(features))))
        keyed = out.withColumn("_block", F.explode("_block")).withColumn("_bucket", F.explode("_bucket"))
        return keyed.where(~(F.col("_block").startswith("=") & F.col("_bucket").startswith("="))).withColumn("_held", F.explode("_held"))

    whole = F.col("_block").isNotNull() & F.col("_bucket").isNotNull()
    a, b = rows(left, left_id, left_date, "_day", "_l"), rows(right, right_id, right_date, "_other", "_r")
    counts = F.struct(*(F.size(F.array_intersect(f"_l{k}", f"_r{k}")).cast("long").alias(f) for k, f in enumerate(features)))
    met = placed(a.where(whole)).join(placed(b.where(whole)), ["_block", "_bucket"]).where(near).select(left_id, right_id, F.inline(F.array(counts)))  # as a generator, so that filters on counts don't count again
    some = a.where(~whole), b, a.where(whole), b.where(~whole)
    joined = (by_element(x, "_l").join(by_element(y, "_r"), ["_held", "_block", "_bucket"]).where(near) for x, y in (some[:2], some[2:]))
    lacking = reduce(DataFrame.unionByName, joined).groupBy(left_id, right_id).agg(*(F.count_if(F.col("_held.k") == k).alias(f) for k, f in enumerate(features)))
    return met.where(reduce(or_, (F.col(f) > 0 for f in features))).unionByName(lacking)


def scored_candidates(pairs: DataFrame, weights: Mapping[str, float], left_id: str, right_id: str, n: int) -> DataFrame:
    """The ``n`` best right rows of each left one by weighted counts above 0: ``left_id, right_id, score, rank``, the smaller id of equals first."""
    score = F.round(sum((F.col(f) * F.lit(w) for f, w in weights.items()), F.lit(0.0)), 6)
    return top_rows(pairs.select(left_id, right_id, score.alias("score")).where("score > 0"), [left_id], [F.desc("score"), F.col(right_id)], n)


def range_candidates(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, left_date: str, right_date: str, most_days: int, n: int) -> DataFrame:
    """For each left row the ``n`` nearest right rows of its block within ``most_days``: ``left_id, right_id, days, rank``.

    Days are cut into buckets as wide as the range, so a row meets three buckets
    of its block and not the whole block. Rows without a date or block meet none;
    ``shared_counts`` with ``scored_candidates`` lets them meet and ranks by score.
    """
    width = F.lit(max(1, most_days))
    bucket = lambda c: F.floor(F.unix_date(F.to_date(c)) / width).cast("long")
    a = left.select(F.col(block).alias("_block"), F.col(left_id), F.to_date(left_date).alias("_day"), F.explode(F.array(*(bucket(left_date) + k for k in (-1, 0, 1)))).alias("_bucket"))
    b = right.select(F.col(block).alias("_block"), F.col(right_id), F.to_date(right_date).alias("_other"), bucket(right_date).alias("_bucket"))
    days = F.abs(F.datediff("_day", "_other"))
    near = a.join(b, ["_block", "_bucket"]).where((days <= most_days) & (F.col(left_id) != F.col(right_id))).select(left_id, right_id, days.alias("days"))
    return top_rows(near, [left_id], [F.col("days"), F.col(right_id)], n)


def by_priority(strategies: Sequence[tuple[DataFrame, bool]], left_id: str, right_id: str) -> DataFrame:
    """One right row for each left one from several strategies' pairs, the first strategy that has one.

    ``last`` of a strategy takes its largest right id instead of its smallest.
    Returns ``left_id, right_id, strategy`` with strategies counted from 1.
    """
    out = None
    for k, (pairs, last) in enumerate(strategies, 1):
        one = pairs.groupBy(left_id).agg((F.max if last else F.min)(right_id).alias(right_id)).withColumn("strategy", F.lit(k))
        out = one if out is None else out.unionByName(one)
    best = out.groupBy(left_id).agg(F.min(F.struct("strategy", right_id)).alias("_best"))
    return best.select(left_id, F.col(f"_best.{right_id}").alias(right_id), F.col("_best.strategy").alias("strategy"))


def match_score(code_overlap: Column, authority_tokens: Column, shared_words: Column) -> Column:
    """Twice the shared codes, half a point a shared authority token up to three points, one a shared word."""
    return code_overlap * 2 + F.least(authority_tokens * 0.5, F.lit(3.0)) + shared_words
