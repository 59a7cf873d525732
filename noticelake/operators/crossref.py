"""Cross-reference of notices to earlier records by three strategies, without a cross join.

A record's id in the notice's text counts most: ids are searched as substrings, by a
bitmap of what they begin with and then by equality. Next a word of the buyer and
several title words, found by the rarest words of each title. Last the buyer, the code
and near dates, where only the first record of each buyer, code and day takes part.
Rows alike in what a strategy looks at are one, so copies make no pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalised_name

# Words that say nothing about a title or a buyer.
STOP_WORDS = (
    "a", "an", "the", "of", "in", "for", "to", "and", "or", "with", "by", "at", "on", "is", "be", "are", "was", "were", "as", "from",
    "supply", "supplies", "provision", "procurement", "services", "contract", "purchase", "acquisition", "defence", "defense", "military", "australian", "australia",
)
SEPARATORS = r"[/_-]"
LEAST_ID, LEAST_WORD, LEAST_SHARED, MOST_DAYS = 6, 5, 3, 180

_BITS = 1 << 20


def buyer_name(text: Column) -> Column:
    """Lower-cased with single blanks; "" for null."""
    return normalised_name(F.coalesce(text, F.lit("")))


def title_words(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Distinct words of a-z and 0-9 longer than two letters, without stop words, sorted."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_sort(F.array_except(F.array_distinct(F.filter(words, lambda w: F.length(w) > 2)), F.array(*(F.lit(w) for w in stop_words))))


def bare_id(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, "")


def ids_in_texts(texts: DataFrame, ids: DataFrame, id_col: str, text_col: str, ref_col: str, place_col: str, least: int = LEAST_ID) -> DataFrame:
    """``id_col, place``: the smallest place of a record whose id stands anywhere in the text, separators aside.

    Ids shorter than ``least`` are none. An id without white space stands within
    one word, so distinct words are looked at; ids with white space are looked for
    in whole texts. A bitmap of ``_BITS`` bits, whatever the number of ids, says
    where one can begin; from there the substrings of all lengths that ids have
    are joined by equality, so no text meets all ids.
    """
    refs = ids.select(bare_id(F.col(ref_col)).alias("ref"), F.col(place_col).alias("place")).where(F.length("ref") >= least).groupBy("ref").agg(F.min("place").alias("place"))
    here = texts.select(id_col, bare_id(F.col(text_col)).alias("t"))
    spaced = F.col("ref").rlike(r"(?U)\s")
    in_words = _standing(here, refs.where(~spaced), id_col, F.array_distinct(F.split("t", r"(?U)\s+")), least)
    in_texts = _standing(here, refs.where(spaced), id_col, F.array("t"), least)
    found = [f for f in (in_words, in_texts) if f is not None]
    if not found:
        return here.select(id_col, F.lit(None).cast("long").alias("place")).where(F.lit(False))
    return reduce(DataFrame.unionByName, found).groupBy(id_col).agg(F.min("place").alias("place"))


def _standing(texts: DataFrame, refs: DataFrame, id_col: str, parts: Column, least: int) -> DataFrame | None:
    """``id_col, place`` of ids within one of the parts of each text; None without ids."""
    begins = F.pmod(F.hash(F.left("ref", F.lit(least))), F.lit(_BITS))
    lengths = sorted(r.n for r in refs.select(F.length("ref").alias("n")).distinct().collect())
    if not lengths:
        return None
    words = refs.select(begins.alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 AS int))")).alias("bits")).collect()
    bitmap = [0] * (_BITS // 64)
    for r in words:
        bitmap[r.word] = r.bits
    bits = F.from_json(F.lit(str(bitmap)), "array<bigint>")

    def tried(part: Column) -> Column:
        def may_begin(at: Column) -> Column:
            b = F.pmod(F.hash(F.substring(part, at, F.lit(least))), F.lit(_BITS))
            return F.getbit(F.get(bits, F.shiftright(b, 6)), b % 64) == 1

        places = F.filter(F.sequence(F.lit(1), F.length(part) - (least - 1)), may_begin)
        return F.flatten(F.transform(places, lambda at: F.array(*(F.substring(part, at, F.lit(n)) for n in lengths))))

    long = F.filter(parts, lambda p: F.length(p) >= least)
    candidates = texts.select(id_col, F.explode(F.array_distinct(F.flatten(F.transform(long, tried)))).alias("ref"))
    return candidates.join(refs, "ref").select(id_col, "place")


def word_map(words: DataFrame, texts: DataFrame, least: int = LEAST_WORD) -> DataFrame:
    """``word, inside``: which distinct words (at least ``least`` letters) stand within which ones of ``texts``.

    They meet on the first ``least`` letters of the one and every run of as many of the other.
    """
    runs = texts.where(F.length("inside") >= least).select("inside", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("inside") - least + 1), lambda at: F.substring(F.col("inside"), at, F.lit(least))))).alias("run"))
    return words.where(F.length("word") >= least).withColumn("run", F.left("word", F.lit(least))).join(runs, "run").where(F.contains("inside", F.col("word"))).select("word", "inside")


def _buyer_words(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(name, " "), lambda w: F.length(w) >= LEAST_WORD))


def by_title(left: DataFrame, right: DataFrame, meets: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """``buyer, words, place`` of left classes: the largest place of a right one with a buyer's word and ``least_shared`` title words in common.

    ``left`` has distinct ``buyer, words``; ``right`` too, with ``place``; ``meets``
    is a word map. Two word lists that share enough share a word among the rarest
    ones of each, all but ``least_shared - 1``; only these are joined on.
    """
    held = right.where(F.size("words") >= least_shared).select("buyer", "words", "place", F.explode("words").alias("w"))
    seen = held.groupBy("w").agg(F.count("*").alias("n"))
    rarest = lambda df, *keys: df.join(seen, "w").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("n", "w"))).alias("o")).select(*keys, F.explode(F.slice(F.transform("o", lambda x: x["w"]), F.lit(1), F.greatest(F.size("o") - (least_shared - 1), F.lit(0)))).alias("w"))
    a = rarest(left.where(F.size("words") >= least_shared).select("buyer", "words", F.explode("words").alias("w")), "buyer", "words").withColumn("word", F.explode(_buyer_words(F.col("buyer")))).join(meets, "word").select(F.col("buyer").alias("left_buyer"), F.col("words").alias("left_words"), "w", "inside").distinct()
    b = rarest(held, "buyer", "words", "place").withColumn("inside", F.explode(_buyer_words(F.col("buyer")))).select("words", "place", "w", "inside")
    near = a.join(b, ["w", "inside"]).where(F.size(F.array_intersect("left_words", "words")) >= least_shared)
    return near.groupBy(F.col("left_buyer").alias("buyer"), F.col("left_words").alias("words")).agg(F.max("place").alias("place"))


def by_code_and_day(left: DataFrame, right: DataFrame, meets: DataFrame, most_days: int = MOST_DAYS) -> DataFrame:
    """``buyer, code, day, place`` of left classes: the smallest place of a right row with a buyer's word, an equal code and a near day.

    A code or day that either side lacks agrees with any. Of right rows with equal
    buyer word, code and day only the first takes part.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / F.lit(max(1, most_days))).cast("long")
    key = lambda c: F.concat(F.lit("="), c.cast("string"))
    any_or = lambda c, keys: F.when(c.isNull(), F.array(F.lit("-"), F.lit("*"))).otherwise(F.array(*keys, F.lit("*")))
    b = right.withColumn("inside", F.explode(_buyer_words(F.col("buyer")))).withColumn("_code", F.explode(any_or(F.col("code"), (key(F.col("code")),))))
    b = b.withColumn("_day", F.explode(any_or(F.col("day"), (key(bucket(F.col("day"))),)))).groupBy("inside", "_code", "_day", F.when(F.col("_day") != "*", F.col("day")).alias("there")).agg(F.min("place").alias("place"))
    to_any = lambda c, keys: F.when(c.isNull(), F.array(F.lit("*"))).otherwise(F.array(*keys, F.lit("-")))
    a = left.withColumn("word", F.explode(_buyer_words(F.col("buyer")))).join(meets, "word").withColumn("_code", F.explode(to_any(F.col("code"), (key(F.col("code")),))))
    a = a.withColumn("_day", F.explode(to_any(F.col("day"), tuple(key(bucket(F.col("day")) + k) for k in (-1, 0, 1)))))
    near = a.join(b, ["inside", "_code", "_day"]).where(F.coalesce(F.abs(F.datediff("day", "there")) <= most_days, F.lit(True)))
    return near.groupBy("buyer", "code", "day").agg(F.min("place").alias("place"))


def cross_reference(notices: DataFrame, records: DataFrame, stop_words: Sequence[str] = STOP_WORDS, least_shared: int = LEAST_SHARED, most_days: int = MOST_DAYS) -> DataFrame:
    """``id, record, strategy`` of every notice that has a record.

    ``notices`` has ``id, buyer, title, description, code, day``; ``records`` has
    ``id, ref, buyer, title, code, day`` and ``place``, distinct numbers in whose
    order records are looked at. The first record by its id (strategy 1) wins, else
    the last by buyer and title (2), else the first by buyer, code and day (3).
    Null buyers, titles or texts match nothing by that strategy; ids are distinct.
    """
    a = notices.select("id", buyer_name(F.col("buyer")).alias("buyer"), title_words(F.col("title"), stop_words).alias("words"), "description", F.col("code").cast("string").alias("code"), F.to_date("day").alias("day"))
    b = records.select("id", "ref", buyer_name(F.col("buyer")).alias("buyer"), title_words(F.col("title"), stop_words).alias("words"), F.col("code").cast("string").alias("code"), F.to_date("day").alias("day"), "place")
    meets = word_map(a.select(F.explode(_buyer_words(F.col("buyer"))).alias("word")).distinct(), b.select(F.explode(_buyer_words(F.col("buyer"))).alias("inside")).distinct())
    telling = meets.where(~F.col("word").isin(*stop_words))
    first = ids_in_texts(a, b, "id", "description", "ref", "place").select("id", F.lit(1).alias("strategy"), "place")
    titles = by_title(a.select("buyer", "words").distinct(), b.groupBy("buyer", "words").agg(F.max("place").alias("place")), telling, least_shared)
    second = a.join(titles, ["buyer", "words"]).select("id", F.lit(2).alias("strategy"), "place")
    days = by_code_and_day(a.select("buyer", "code", "day").distinct(), b, meets, most_days)
    third = a.alias("a").join(days.alias("d"), (F.col("a.buyer") == F.col("d.buyer")) & F.col("a.code").eqNullSafe(F.col("d.code")) & F.col("a.day").eqNullSafe(F.col("d.day"))).select("id", F.lit(3).alias("strategy"), "place")
    best = first.unionByName(second).unionByName(third).groupBy("id").agg(F.min_by(F.struct("strategy", "place"), "strategy").alias("_best"))
    return best.select("id", F.col("_best.place").alias("place"), F.col("_best.strategy").alias("strategy")).join(b.select("place", F.col("id").alias("record")), "place").select("id", "record", "strategy")
