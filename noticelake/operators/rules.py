"""Scoring and filters by keyword and code rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_term, count_terms, first_term


@dataclass(frozen=True)
class ScoreRules:
    """Weights and terms of the relevance score. Order counts: of tiers and of terms the first hit is taken."""

    code_tiers: Sequence[tuple[Sequence[str], int]] = ()
    prefix: int = 5
    legal_marker: str | None = None
    legal_points: int = 25
    categories: Mapping[str, Sequence[str]] = field(default_factory=dict)
    category_points: int = 15
    title_points: int = 10
    generic: Sequence[str] = ()
    generic_points: int = 5
    context: Sequence[str] = ()
    context_points: int = 10
    relevant: int = 25
    confident: int = 50


def code_points(code: Column, rules: ScoreRules) -> Column:
    """Points of the first tier that has a code with which either prefix begins the other."""
    short, out = F.left(code, F.lit(rules.prefix)), None
    for codes, points in rules.code_tiers:
        hit = F.lit(False)
        for c in codes:
            p = c[: rules.prefix]
            hit |= short.startswith(p) | F.lit(p).startswith(short)
        out = F.when(hit, points) if out is None else out.when(hit, points)
    return F.lit(0) if out is None else F.coalesce(out, F.lit(0))


def relevance(df: DataFrame, rules: ScoreRules, text: Column, title: Column, codes: Column, legal: Column) -> DataFrame:
    """Adds ``score``, ``categories`` (those hit, in order) and ``in_context``.

    Every code adds the points of its tier. A category adds its points for its
    first term in the text, and more if that same term is in the title too.
    """
    score = F.aggregate(F.coalesce(codes, F.array().cast("array<string>")), F.lit(0), lambda a, c: a + code_points(c, rules))
    if rules.legal_marker is not None:
        score = score + F.when(legal.contains(rules.legal_marker), rules.legal_points).otherwise(0)
    hits = []
    for name, terms in rules.categories.items():
        term = first_term(text, terms)
        score = score + F.when(term.isNotNull(), F.lit(rules.category_points) + F.when(title.contains(term), rules.title_points).otherwise(0)).otherwise(0)
        hits.append(F.when(term.isNotNull(), F.lit(name)))
    in_context = any_term(text, rules.context)
    score = score + F.when(any_term(text, rules.generic), rules.generic_points).otherwise(0) + F.when(in_context, rules.context_points).otherwise(0)
    return df.withColumns({"score": score.cast("int"), "categories": F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>"), "in_context": in_context})


def at_least(df: DataFrame, points: int) -> DataFrame:
    return df.where(F.col("score") >= points)


def unknown_passes(value: Column, least: float) -> Column:
    """A minimum that rows without a value (null or 0) pass."""
    return value.isNull() | (value == 0) | (value >= least)


def repair_only(text: Column, repair: Sequence[str], procurement: Sequence[str], least: int = 2) -> Column:
    """Several different repair terms and no procurement term."""
    return (count_terms(text, repair) >= least) & (count_terms(text, procurement) == 0)


def first_match(rules: Sequence[tuple[Column, str, str]]) -> Column:
    """``tier, reason`` of the first rule that holds; null if none does."""
    out = None
    for when, tier, reason in rules:
        value = F.struct(F.lit(tier).alias("tier"), F.lit(reason).alias("reason"))
        out = F.when(when, value) if out is None else out.when(when, value)
    return out


def any_pattern(fields: Sequence[Column], patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for f in fields:
        out |= any_term(F.lower(f), [p.lower() for p in patterns])
    return out


def has_prefix(codes: Column, prefixes: Sequence[str]) -> Column:
    return F.exists(codes, lambda c: any_of([c.startswith(p) for p in prefixes]))


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out |= c
    return out


def whitelisted(name: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    """In the include list and not in the exclude list, which goes first."""
    return ~any_term(name, exclude) & any_term(name, include)


def listing_predicate(mode: str, authority: Column, keyword: Column) -> Column:
    """How a source combines its two tests: ``and``, ``or``, ``authority``, ``keyword`` or ``pass``."""
    modes = {"and": authority & keyword, "or": authority | keyword, "authority": authority, "keyword": keyword, "pass": F.lit(True)}
    return modes[mode]


def listing_with_fallback(df: DataFrame, source: str, authority: Column, keyword: Column) -> DataFrame:
    """Rows that pass both tests, or, of a source where none does, those that pass the first one alone."""
    tested = df.withColumns({"_a": F.coalesce(authority, F.lit(False)), "_k": F.coalesce(keyword, F.lit(False))})
    full = tested.where("_a AND _k").select(F.col(source).alias("_full")).distinct()
    return tested.where("_a").join(full, F.col(source).eqNullSafe(F.col("_full")), "left").where("_k OR _full IS NULL").drop("_a", "_k", "_full")


def in_scope(source: Column, record_id: Column, sources: Sequence[str], numbered: str = "TED") -> Column:
    """Whether a record's source is listed: the one it names, else ``numbered`` for an id like 123-2024, else what stands before the id's first dash.

    Sources are compared in capitals; a blank source is none, and an id without a dash is out of scope.
    """
    named = F.upper(F.trim(F.coalesce(source, F.lit(""))))
    record = F.trim(F.coalesce(record_id.cast("string"), F.lit("")))
    by_id = F.when(record.rlike("^[0-9]+-[0-9]{4}$"), F.lit(numbered in sources)).when(record.contains("-"), F.upper(F.split_part(record, F.lit("-"), F.lit(1))).isin(*sources)).otherwise(F.lit(False))
    return F.when(named != "", named.isin(*sources)).otherwise(by_id)


def without_listed(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is on none of the lists."""
    return df.join(ids.select(id_col).distinct(), id_col, "left_anti")
