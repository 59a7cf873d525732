"""Which rows of a portal's listing are wanted: one table of rules by source, applied by one join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# For each source how its tests combine, and in which fields the buyer and the keywords are looked for.
# modes: and, or, buyer, keyword, pass; code: buyer and (keyword or code); tiers: code gives high, else keyword and code medium;
# rich: buyer where the row says more than a title; marked: kept for a marker in the snippet, else by buyer;
# fallback: and, or of a source where nothing passes both, by buyer alone; either: or, and all rows of a source where none passes.
BUYER, TITLE, SNIPPET = "buyer", "title", "snippet"
PORTALS: tuple[tuple[str, str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("AU-AT", "keyword", (), (BUYER, TITLE, SNIPPET)), ("AU-TEN", "tiers", (BUYER,), (TITLE,)), ("BE-EP", "code", (BUYER, TITLE), (TITLE,)), ("CA-CB", "tiers", (BUYER,), (TITLE, SNIPPET)),
    ("CH-SI", "buyer", (BUYER, TITLE, SNIPPET), ()), ("CZ-NEN", "or", (BUYER,), (TITLE,)), ("DE-SB", "marked", (BUYER, TITLE), ()), ("DE-EV", "keyword", (), (BUYER, TITLE)),
    ("DK-UD", "buyer", (BUYER, TITLE, SNIPPET), ()), ("EE-RP", "and", (BUYER,), (TITLE,)), ("ES-PL", "rich", (BUYER, TITLE), ()), ("FI-HI", "buyer", (BUYER, TITLE, SNIPPET), ()),
    ("FR-BP", "marked", (BUYER, TITLE, SNIPPET), ()), ("GR-PR", "pass", (), ()), ("IT-AN", "either", (BUYER,), (TITLE,)), ("LT-CV", "and", (BUYER,), (TITLE, SNIPPET)),
    ("LV-IUB", "and", (BUYER,), (BUYER, TITLE)), ("NL-TN", "buyer", (BUYER, TITLE), ()), ("NO-DF", "fallback", (BUYER,), (TITLE,)), ("NSPA-EP", "keyword", (), (TITLE, SNIPPET)),
    ("PL-BZP", "pass", (), ()), ("RO-SEAP", "code", (BUYER, TITLE), (BUYER, TITLE)), ("SE-KA", "buyer", (BUYER, TITLE, SNIPPET), ()), ("TR-EKAP", "buyer", (BUYER, TITLE), ()),
    ("UA-PR", "code", (BUYER, TITLE), (TITLE, SNIPPET)), ("UK-FTS", "pass", (), ()),
)


def portal_table(spark: SparkSession, buyers: Mapping[str, Sequence[str]], keywords: Mapping[str, Sequence[str]], codes: Sequence[str], markers: Mapping[str, str] = {}, portals: Sequence[tuple] = PORTALS) -> DataFrame:
    """The rules as rows, with each source's buyers and keywords (those under ``*`` for sources not named), code prefixes and marker."""
    of = lambda table, s: [w.lower() for w in table.get(s, table.get("*", ()))]
    rows = [(s, mode, list(a), list(k), of(buyers, s), of(keywords, s), list(codes), markers.get(s)) for s, mode, a, k in portals]
    return spark.createDataFrame(rows, "_source string, _mode string, _buyer_in array<string>, _keyword_in array<string>, _buyers array<string>, _keywords array<string>, _codes array<string>, _marker string")


def wanted_listings(df: DataFrame, rules: DataFrame, source: str, buyer: str, title: str, snippet: str, codes: str) -> DataFrame:
    """The rows that their source's rule lets pass, with ``confidence`` (``high`` or ``medium``).

    Rows of sources without a rule go. Null fields are as empty ones; a word must
    stand within one field, not across the end of one and the beginning of the
    next. A source
    falls back only if no row of it passes, which takes a count by source.
    """
    names = df.columns
    fields = {BUYER: buyer, TITLE: title, SNIPPET: snippet}

    def has(where: str, words: str) -> Column:
        texts = F.array_compact(F.array(*(F.when(F.array_contains(where, f), F.lower(F.col(c))) for f, c in fields.items())))
        return F.exists(texts, lambda text: F.exists(words, lambda w: text.contains(w)))

    joined = df.join(F.broadcast(rules), F.col(source) == F.col("_source"))
    tested = joined.withColumns({"_b": has("_buyer_in", "_buyers"), "_k": has("_keyword_in", "_keywords"), "_c": F.exists(F.coalesce(F.col(codes), F.array().cast("array<string>")), lambda c: F.exists("_codes", lambda p: c.startswith(p)))})
    b, k, c, mode = F.col("_b"), F.col("_k"), F.col("_c"), F.col("_mode")
    marked = F.coalesce(F.lower(F.col(snippet)).contains(F.col("_marker")), F.lit(False))
    rich = F.coalesce(F.trim(F.col(buyer)) != "", F.lit(False))
    passes = {"and": b & k, "or": b | k, "buyer": b, "keyword": k, "pass": F.lit(True), "code": b & (k | c), "tiers": (b & (k | c)) | (k & c), "rich": ~rich | b, "marked": marked | b, "fallback": b & k, "either": b | k}
    full = F.lit(False)
    for name, test in passes.items():
        full = F.when(mode == name, test).otherwise(full)
    late = F.when(mode == "fallback", b).when(mode == "either", F.lit(True)).otherwise(F.lit(False))
    held = tested.withColumns({"_full": full, "_late": late})
    served = held.where("_full").select(F.col("_source").alias("_served")).distinct()
    kept = held.where("_full OR _late").join(F.broadcast(served), F.col("_source") == F.col("_served"), "left").where("_full OR _served IS NULL")
    return kept.withColumn("confidence", F.when((mode == "tiers") & ~b, "medium").otherwise("high")).select(*names, "confidence")
