"""From source records to canonical notices, and from notices to output rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_iso_date, coalesce_nonempty, coalesce_positive, collapse_space, first_line, language_pick, truncate
from .ranking import top_rows


def canonical(df: DataFrame, id_col: str, title: str, description: str, buyer: str, country: str, codes: str, published: str, deadline: str, amount: str, currency: str, winner: str, source: str, default_currency: str = "EUR") -> DataFrame:
    """One schema for all sources. Titles and descriptions are maps by language; missing texts are null, amounts up to 0.01 too."""
    value = coalesce_positive(F.col(amount))
    return df.select(
        F.col(id_col).cast("string").alias("notice_id"),
        truncate(collapse_space(language_pick(F.col(title))), 500).alias("title"),
        truncate(language_pick(F.col(description)), 10_000).alias("description"),
        F.struct(coalesce_nonempty(first_line(F.col(buyer))).alias("name"), coalesce_nonempty(first_line(F.col(country))).alias("country")).alias("authority"),
        F.array_distinct(F.coalesce(F.col(codes), F.array().cast("array<string>"))).alias("codes"),
        clean_iso_date(F.col(published)).alias("published"),
        clean_iso_date(F.col(deadline)).alias("deadline"),
        F.when(value.isNotNull(), F.struct(value.alias("amount"), F.coalesce(coalesce_nonempty(F.col(currency)), F.lit(default_currency)).alias("currency"))).alias("value"),
        F.struct(coalesce_nonempty(F.col(winner)).isNotNull().alias("awarded"), coalesce_nonempty(first_line(F.col(winner))).alias("winner")).alias("award"),
        F.col(source).alias("source"),
    )


def sheet_rows(notices: DataFrame, status: Column, eur: Column) -> DataFrame:
    """The flat typed row of a notice."""
    return notices.select("notice_id", "title", F.col("authority.name").alias("authority"), F.col("authority.country").alias("country"), F.array_join("codes", "\n").alias("codes"), F.to_date("published").alias("published"), F.to_date("deadline").alias("deadline"), eur.alias("value_eur"), status.alias("status"), F.col("award.winner").alias("winner"), "source")


def frontend_rows(notices: DataFrame, status: Column, eur: Column, optional: Sequence[str] = ("deadline", "description")) -> DataFrame:
    """The nested object of a notice; written as JSON without null fields, so optional ones vanish."""
    return notices.select(F.col("notice_id").alias("id"), "title", F.col("authority.name").alias("buyer"), F.coalesce("authority.country", F.lit("")).alias("country"), status.alias("status"), F.coalesce(eur, F.lit(0.0)).alias("value_eur"), "codes", F.col("published").alias("published_at"), *(coalesce_nonempty(F.col(c)).alias(c) for c in optional))


def party_with_role(parties: Column, role: str) -> Column:
    """The first party (a struct with an array ``roles``) that has a role."""
    return F.try_element_at(F.filter(parties, lambda p: F.array_contains(p["roles"], role)), F.lit(1))


def code_of_scheme(items: Column, scheme: str) -> Column:
    """The first classification id of a scheme among items."""
    return F.try_element_at(F.transform(F.filter(items, lambda i: i["scheme"] == scheme), lambda i: i["id"]), F.lit(1))


def two_stage(listing: DataFrame, detail: DataFrame, key: str, cheap: Column, full: Column, most: int | None = None, order: Sequence[Column] = ()) -> DataFrame:
    """Cheap filter on the listing, then the detail of what is left and its filter. ``most`` is the source's own limit on details."""
    kept = listing.where(cheap)
    if most is not None:
        kept = kept.orderBy(*order, key).limit(most)
    return kept.join(detail, key).where(full)


def first_usable_document(refs: DataFrame, texts: DataFrame, notice: str, url: str, order: str, text: str, least: int = 200) -> DataFrame:
    """Of each notice's document references the first, by ``order``, whose text is longer than ``least``."""
    rows = refs.join(texts, url).where(F.length(text) > least)
    return top_rows(rows, [notice], [F.col(order), F.col(url)], 1).drop("rank")


def best_cached_award(cache: DataFrame, notices: DataFrame, key: str, match: str, confidence: str, least: int = 75) -> DataFrame:
    """``key, winner`` from the most confident cached match whose notice has a winner; only for notices without one."""
    best = top_rows(cache.where((F.col(confidence) >= least) & F.col(match).isNotNull()), [key], [F.desc(confidence), F.col(match)], 1)
    winners = notices.where("award.winner IS NOT NULL").select(F.col("notice_id").alias(match), F.col("award.winner").alias("winner"))
    open_ones = notices.where("award.winner IS NULL").select(F.col("notice_id").alias(key))
    return best.join(winners, match).join(open_ones, key, "left_semi").select(key, "winner")


def confirmed_by_listing(known: DataFrame, listing: DataFrame, by: str, key: str, date: str, title: str, listing_title: str, n: int = 5, least_shared: int = 3) -> DataFrame:
    """For the ``n`` latest known rows of each group whether the group's listing has a title that shares enough words."""
    from ..functions.text import tokens

    latest = top_rows(known, [by], [F.desc(date), F.col(key)], n).select(by, key, F.explode_outer(tokens(F.col(title))).alias("word"))
    words = listing.select(by, F.xxhash64(by, listing_title).alias("row"), F.explode(tokens(F.col(listing_title))).alias("word"))
    shared = latest.join(words, [by, "word"], "left").groupBy(by, key, "row").agg(F.count("row").alias("shared"))
    return shared.groupBy(by, key).agg(F.max("shared").alias("shared")).withColumn("confirmed", F.col("shared") >= least_shared)


def country_of_host(host: Column, names: Mapping[str, str]) -> Column:
    """A country by a part of the host's name, else by its last label of two letters."""
    out = None
    for part, code in names.items():
        out = F.when(host.contains(part), code) if out is None else out.when(host.contains(part), code)
    last = F.upper(F.regexp_extract(host, r"\.([a-z]{2})$", 1))
    return F.coalesce(out, F.nullif(last, F.lit(""))) if out is not None else F.nullif(last, F.lit(""))


def text_eval(found: Column, must: Sequence[str], must_not: Sequence[str]) -> Column:
    """Share of required parts that are there; 0 if a forbidden one is."""
    from ..functions.text import any_term, count_terms

    low = F.lower(found)
    return F.when(any_term(low, [m.lower() for m in must_not]), 0.0).otherwise(count_terms(low, [m.lower() for m in must]) / max(1, len(must)))
