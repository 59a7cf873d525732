"""The best row of each group, first-seen times and samples. Every order ends with a tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_row(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], keep: Sequence[str] | None = None) -> DataFrame:
    """One row a key: the first in ``order``, whose last column must be unique.

    As an aggregate over a struct of the row, so that each task sends one row a
    key and a key with a third of all rows is no task's load. ``order`` columns
    are compared in ascending order with nulls first; ``descending`` turns a
    number round and puts nulls last. Of the row only the columns ``keep``
    are carried, by default all.
    """
    names = df.columns if keep is None else keep
    rank = F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)))
    keyed = df.withColumns({f"_k{k}": F.col(c) if isinstance(c, str) else c for k, c in enumerate(keys)}).withColumn("_rank", rank)
    best = keyed.groupBy(*(f"_k{k}" for k in range(len(keys)))).agg(F.min_by(F.struct(*names), "_rank").alias("_row"))
    return best.select("_row.*")


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key, with their rank from 1; Spark limits each task's rows before it shuffles."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def descending(c: Column) -> Column:
    """For ``best_row``: a number so that larger values come first and nulls last."""
    return F.struct(c.isNull().alias("n"), (-c).alias("v"))


def completeness(texts: Sequence[Column] = (), numbers: Sequence[Column] = (), lists: Sequence[Column] = ()) -> Column:
    """How many of the columns say something: texts other than "", numbers other than 0, lists with an element."""
    there = [*(c != "" for c in texts), *(c != 0 for c in numbers), *(F.size(c) > 0 for c in lists)]
    return sum((F.coalesce(t, F.lit(False)).cast("int") for t in there), F.lit(0))


def data_score(winner: Column, amount: Column, quantity: Column, published: Column) -> Column:
    """100 for a winner, 50 for an amount above 0.01, 25 for a quantity other than 0, and the length of the date's text."""
    says = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return says(winner != "") * 100 + says(amount > 0.01) * 50 + says(quantity != 0) * 25 + F.coalesce(F.length(published.cast("string")), F.lit(0))


def notice_key(authority: Column, codes: Column, title: Column, published: Column) -> Column:
    """What two notices of one purchase have in common: 30 letters of the authority, two codes, 40 letters of the title, the year."""
    two = F.array_join(F.slice(F.array_sort(F.array_compact(F.coalesce(codes, F.array().cast("array<string>")))), 1, 2), ",")
    lead = lambda c, n: F.left(F.lower(F.coalesce(c, F.lit(""))), F.lit(n))
    day = F.coalesce(published.cast("string"), F.lit(""))
    year = F.when(F.length(day) >= 4, F.left(day, F.lit(4))).otherwise("unknown")
    return F.concat_ws("|", lead(authority, 30), two, lead(title, 40), year)


def one_notice_each(df: DataFrame, key: Column, winner: Column, published: Column, order: Column) -> DataFrame:
    """Of the notices with an equal key one with a winner before one without, then the latest, then the first in ``order``, which is unique."""
    has = F.coalesce(winner != "", F.lit(False))
    return best_row(df, [key], [(~has).cast("int"), latest(published), order])


def latest(day: Column) -> Column:
    """For ``best_row``: texts of dates so that later ones come first and nulls last."""
    turned = F.translate(F.hex(F.encode(F.coalesce(day, F.lit("")), "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210")
    return F.struct(day.isNull().alias("n"), F.concat(turned, F.lit("~")).alias("v"))  # the end counts more than any digit


def most_complete(df: DataFrame, key: str, says: Column, tier: Column, published: Column, order: Column, keep: Sequence[str] | None = None) -> DataFrame:
    """Of the rows of a key, which is neither null nor "", the most complete, then the best tier, then the latest, then the first in ``order``."""
    return best_row(df.where(F.col(key) != ""), [key], [-says, -tier, latest(F.coalesce(published, F.lit(""))), order], keep)


def first_seen(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias("first_seen"))


def sample_of_each(df: DataFrame, bucket: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of each bucket, by a hash of key and seed: the same in every run."""
    return top_rows(df, [bucket], [F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)], n)
