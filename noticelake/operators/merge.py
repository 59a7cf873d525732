"""Merging of sources, fallback lookups, caches, overrides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import coalesce_nonempty
from .ranking import best_row


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def new_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``right`` whose key ``left`` doesn't have; a null key is always new."""
    return right.join(left.select(key).distinct(), key, "left_anti")


def merge_sources(base: DataFrame, other: DataFrame, id_col: str, match_key: str, order: str, fill: Sequence[str], least_key: int = 1) -> DataFrame:
    """``base`` with what ``other`` adds, as if rows of ``other`` came one by one in ``order``.

    A row with an id of ``base`` or of a row before it is skipped. Of the rest, a
    row whose match key ``base`` has fills the ``fill`` columns that are still
    empty in the last base row, by ``order``, of that key; others are appended.
    A key shorter than ``least_key`` characters matches nothing. ``_merge`` tells
    what became of a row.
    """
    place = F.struct(F.col(order).alias("o"), F.col(id_col).alias("i"))
    usable = F.when(F.length(match_key) >= least_key, F.col(match_key))
    fresh = new_rows(base, other, id_col)
    fresh = best_row(fresh.where(F.col(id_col).isNotNull()), [id_col], [F.col(order)]).unionByName(fresh.where(F.col(id_col).isNull())).withColumn("_key", usable)
    last = base.withColumn("_key", usable).where("_key IS NOT NULL").groupBy("_key").agg(F.max(place)["i"].alias("_target"))
    matching = fresh.join(last, "_key", "left_semi")
    donor = matching.groupBy("_key").agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_new_{c}") for c in fill))
    target = last.join(donor, "_key").withColumnRenamed("_key", "_hit")
    filled = base.withColumn("_key", usable).join(target, (F.col("_key") == F.col("_hit")) & (F.col(id_col) == F.col("_target")), "left")
    updated = filled.select(*(F.coalesce(c, f"_new_{c}").alias(c) if c in fill else F.col(c) for c in base.columns), F.when(F.col("_hit").isNotNull(), "enriched").otherwise("kept").alias("_merge"))
    appended = fresh.join(last, "_key", "left_anti").drop("_key").withColumn("_merge", F.lit("appended"))
    return updated.unionByName(appended, allowMissingColumns=True)


def lookup_with_fallback(df: DataFrame, dim: DataFrame, keys: Sequence[str], dim_key: str, value: str) -> DataFrame:
    """Adds ``value`` by the first of the keys that ``dim`` knows; ``dim_key`` is unique."""
    out, names = df, []
    for k, key in enumerate(keys):
        names.append(f"_v{k}")
        out = out.join(dim.select(F.col(dim_key).alias(f"_k{k}"), F.col(value).alias(f"_v{k}")), F.col(key) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
    return out.withColumn(value, F.coalesce(*names)).drop(*names)


def with_cache(df: DataFrame, cache: DataFrame, key: str, value: str, usable: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable cached value, and the rows that miss one."""
    hit = cache.where(usable).select(key, value)
    return df.join(hit, key), df.join(hit, key, "left_anti")


def apply_overrides(df: DataFrame, overrides: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Columns replaced where an override row of the id has a value."""
    over = overrides.select(F.col(id_col), *(F.col(c).alias(f"_over_{c}") for c in columns))
    out = df.join(over, id_col, "left")
    return out.select(*(F.coalesce(f"_over_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns))


def fill_missing_number(own: Column, found: Column, least: float = 0.01) -> Column:
    """The own number, unless it is null or up to ``least``."""
    return F.when(own.isNull() | (own <= least), F.coalesce(found, own)).otherwise(own)


def longer_text(own: Column, found: Column, by: int = 50) -> Column:
    """The found text if it is more than ``by`` characters longer, else the own one if not blank."""
    return F.when(F.length(found) > F.coalesce(F.length(own), F.lit(0)) + by, found).otherwise(coalesce_nonempty(own, found))


def restored(df: DataFrame, log: DataFrame, id_col: str) -> DataFrame:
    """``df`` and the logged rows that it lacks."""
    return df.unionByName(new_rows(df, log, id_col), allowMissingColumns=True)
