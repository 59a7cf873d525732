"""License scans with ordered signature rules, in DataFrame functions throughout.

A text that holds none of a few root words has no license. Of the others the
normalised words (lower-case A-Z, single spaces) are searched for the keywords of
the rules in ``license_rules``, and only the rules of keywords that are there run
their patterns. A detection is an interval of words. One that lies within another
of the same or a better kind is suppressed; equal intervals keep the better kind,
then the earlier rule. Base phrases always stay.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slim, table
from .license_rules import KINDS, ROOTS, RULES

#: Phrases that are found wherever their words stand consecutively, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of texts whose letters A-Z were not lower-cased
_RULE = "struct<at:int,priority:int,sure:double,label:string,pattern:string>"
_HIT = "struct<start:int,stop:int,priority:int,at:int,sure:double,label:string>"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def normalised(text: Column) -> Column:
    """A space, the words with a space after each; one space alone without words."""
    words = F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _BETWEEN, " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def hits_of(words: Column, rule: Column) -> Column:
    """The detections of a rule in normalised words, leftmost and non-overlapping, stop exclusive.

    A match starts at the space before its first word, so words are counted by spaces.
    """
    pattern = F.concat(F.lit(" (?:"), rule["pattern"], F.lit(")(?= )"))
    between = F.transform(F.split(words, pattern, -1), _spaces)
    counts = F.zip_with(between, F.transform(F.regexp_extract_all(words, pattern, F.lit(0)), _spaces), lambda b, m: F.struct(b.alias("b"), m.alias("m")))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["b"]
        hit = F.struct(start.alias("start"), (start + x["m"]).alias("stop"), rule["priority"].alias("priority"), rule["at"].alias("at"), rule["sure"].alias("sure"), rule["label"].alias("label"))
        return F.struct((start + F.coalesce(x["m"], F.lit(0))).alias("at"), F.when(x["m"].isNotNull(), F.array_append(a["out"], hit)).otherwise(a["out"]).cast(f"array<{_HIT}>").alias("out"))

    return F.aggregate(counts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_HIT}>").alias("out")), step, lambda a: a["out"])


def phrase_places(words: Column, phrase: str) -> Column:
    """The first word of each place where the phrase's words stand consecutively."""
    rule = F.struct(F.lit(phrase).alias("pattern"), F.lit(0).alias("priority"), F.lit(0).alias("at"), F.lit(1.0).alias("sure"), F.lit("").alias("label"))
    return F.when(F.contains(words, F.lit(f" {phrase} ")), F.transform(hits_of(words, rule), lambda h: h["start"])).otherwise(F.array().cast("array<int>"))


def detections(words: Column, rules: Sequence[Mapping]) -> Column:
    """All detections of rules whose keyword is in the normalised words."""
    by_keyword: dict[str, list[Mapping]] = {}
    for rule in rules:
        by_keyword.setdefault(rule["keyword"], []).append(rule)
    keywords = F.from_json(F.lit(json.dumps(list(by_keyword))), "array<string>")
    of = F.from_json(F.lit(json.dumps(by_keyword)), f"map<string,array<{_RULE}>>")
    found = F.filter(keywords, lambda k: F.contains(words, k))
    return F.flatten(F.transform(found, lambda k: F.flatten(F.transform(F.element_at(of, k), lambda r: hits_of(words, r)))))


def unsuppressed(hits: Column) -> Column:
    """The detections that lie within no other one of their own or a better kind, by start.

    By start, the longer and better first, a detection lies within an earlier one
    if that ends as late; so one pass keeps the furthest end of each kind so far.
    """
    def order(a: Column, b: Column) -> Column:
        def less(x, y, otherwise):
            return F.when(x < y, -1).when(x > y, 1).otherwise(otherwise)

        return less(a["start"], b["start"], less(b["stop"], a["stop"], less(a["priority"], b["priority"], less(a["at"], b["at"], F.lit(0)))))

    def step(a: Column, h: Column) -> Column:
        ends = F.transform(a["ends"], lambda e, p: F.when((p >= h["priority"]) & (e < h["stop"]), h["stop"]).otherwise(e))
        kept = F.get(a["ends"], h["priority"]) < h["stop"]
        return F.struct(ends.alias("ends"), F.when(kept, F.array_append(a["out"], h)).otherwise(a["out"]).cast(f"array<{_HIT}>").alias("out"))

    start = F.struct(F.array(*(F.lit(-1) for _ in KINDS)).alias("ends"), F.array().cast(f"array<{_HIT}>").alias("out"))
    return F.aggregate(F.array_sort(hits, order), start, step, lambda a: a["out"])


def find_licenses(docs: DataFrame, rules: Sequence[Mapping] = RULES, base: Mapping[str, str] = BASE, roots: Sequence[str] = ROOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, places, hits`` of every row, in one scan without a shuffle.

    ``places`` has for each base phrase (struct phrase, label, starts) the word
    places where it stands; ``hits`` the detections that stay, by their start.
    A null or empty text has no words and no hits. Repeated rows and ids are a
    row each, equal texts have equal results, and very long texts are scanned whole.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    low = slim(docs, id_col, text_col).select("doc_id", text.alias("text"), F.lower(text).alias("low"))
    needed = [*roots, *(max(p.split(), key=len) for p in base if not any(r in p for r in roots))]
    gate = F.col("low").rlike("(?<![a-z0-9])cc(?![a-z])")
    for root in needed:  # between the words of a root anything may stand
        there = F.col("low").rlike(root.replace(" ", "[^a-z0-9]+")) if " " in root else F.contains("low", F.lit(root))
        gate = there | gate
    n_words = F.size(F.array_remove(F.split("text", _BETWEEN, -1), ""))
    rows = low.select("doc_id", n_words.cast("long").alias("n_words"), F.when(gate, normalised(F.col("text"))).alias("words"))
    places = F.array(*(F.struct(F.lit(p).alias("phrase"), F.lit(label).alias("label"), F.when(F.col("words").isNull(), F.array().cast("array<int>")).otherwise(phrase_places(F.col("words"), p)).alias("starts")) for p, label in base.items()))
    hits = F.when(F.col("words").isNull(), F.array().cast(f"array<{_HIT}>")).otherwise(unsuppressed(detections(F.col("words"), rules)))
    return rows.select("doc_id", "n_words", places.alias("places"), hits.alias("hits"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base places and its license labels; score is the surest detection's certainty."""
    found = find_licenses(table(spark, sf_dir, "documents"))
    starts = F.flatten(F.col("places.starts"))
    base = F.transform(F.filter("places", lambda p: F.size(p["starts"]) > 0), lambda p: p["label"])
    rows = found.select("doc_id", "n_words", starts.alias("starts"), base.alias("base"), "hits")
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    sure = F.greatest(F.when(F.size("base") > 0, KINDS["A"][1]).otherwise(0.0), F.coalesce(F.array_max(F.col("hits.sure")), F.lit(0.0)))
    return rows.select("doc_id", "n_words", F.size("starts").cast("long").alias("n_base"), F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"), text(F.col("base")).alias("base_labels"), text(F.concat("base", F.col("hits.label"))).alias("labels"), sure.alias("score"))
