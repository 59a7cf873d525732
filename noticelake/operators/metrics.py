"""Snapshot, coverage, delta and evaluation metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def snapshot(df: DataFrame, id_col: str, value: str, date: str, dims: Sequence[str]) -> DataFrame:
    """Long form ``dim, value, n, total``: a row for all, and one for each value of each dimension, in one pass."""
    sets = [[F.lit("all").alias("dim"), F.lit("all").alias("value")]]
    rows = df.select(F.explode(F.array(F.struct(*sets[0]), *(F.struct(F.lit(d).alias("dim"), F.coalesce(F.col(d).cast("string"), F.lit("(none)")).alias("value")) for d in dims))).alias("g"), F.col(id_col).alias("_id"), F.col(value).alias("_v"), F.col(date).alias("_d"))
    return rows.groupBy("g.dim", "g.value").agg(F.count("*").alias("n"), F.round(F.sum("_v"), 2).alias("total"), F.count_if(F.col("_v").isNull() | (F.col("_v") == 0)).alias("n_without_value"), F.min("_d").alias("first_date"), F.max("_d").alias("last_date"))


def snapshot_delta(before: DataFrame, after: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """``keys, before, after, delta``; a key on one side only counts 0 on the other."""
    a, b = before.select(*keys, F.col(n).alias("before")), after.select(*keys, F.col(n).alias("after"))
    both = a.join(b, list(keys), "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.select(*keys, zero("before").alias("before"), zero("after").alias("after"), (zero("after") - zero("before")).alias("delta"))


def histogram(df: DataFrame, value: str, width: int = 10) -> DataFrame:
    """``bucket, n`` with buckets named by their lower bound; negative values floor."""
    return df.groupBy((F.floor(F.col(value) / width) * width).cast("long").alias("bucket")).agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def repeated(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def coverage(df: DataFrame, group: str, fields: Mapping[str, Column]) -> DataFrame:
    """Percent of rows of each group for which a field's condition holds."""
    return df.groupBy(group).agg(F.count("*").alias("n"), *(F.round(F.avg(F.when(c, 100.0).otherwise(0.0)), 2).alias(f"pct_{name}") for name, c in fields.items()))


def conditional_counts(df: DataFrame, group: str, conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(group).agg(*(F.count_if(c).alias(f"n_{name}") for name, c in conditions.items()))


def group_medians(df: DataFrame, keys: Sequence[str], value: str, least: int = 1, parts: int = 64) -> DataFrame:
    """``keys, median, n`` of groups with at least ``least`` values, exactly, no group's values in one task.

    A sketch cuts each group into ``parts``; counts of the parts tell which one
    or two hold the middle, and only there are values counted and looked up.
    Nulls are no values; null keys make a group.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    cuts = rows.groupBy(*keys).agg(F.percentile_approx("_v", [k / parts for k in range(1, parts)], 1000).alias("_cuts"), F.count("*").alias("n")).where(F.col("n") >= least)
    c = cuts.select(*(F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)), "_cuts", "n")
    on = reduce(lambda x, y: x & y, (rows[k].eqNullSafe(c[f"_g{i}"]) for i, k in enumerate(keys)))
    dealt = rows.join(c, on).select(*keys, "_v", "n", F.size(F.filter("_cuts", lambda x: x < F.col("_v"))).alias("_part"))
    values = dealt.groupBy(*keys, "n", "_part", "_v").agg(F.count("*").alias("_c"))
    sizes = values.groupBy(*keys, "n", "_part").agg(F.sum("_c").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over ``parts`` rows a group
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = sizes.withColumn("_before", before).where((F.col("_before") <= high) & (F.col("_before") + F.col("_size") > low))
    m = middle.select(*(F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), "_before")
    there = values.join(m, reduce(lambda x, y: x & y, (values[k].eqNullSafe(m[f"_g{i}"]) for i, k in enumerate(keys))) & (F.col("_part") == F.col("_p")))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    found = there.withColumn("_upto", upto)
    at = lambda r: (F.col("_upto") - F.col("_c") <= r) & (F.col("_upto") > r)
    return found.groupBy(*keys, "n").agg(((F.max(F.when(at(low), F.col("_v"))) + F.max(F.when(at(high), F.col("_v")))) / 2).alias("median")).select(*keys, "median", "n")


def median_waterfall(df: DataFrame, value: str, levels: Sequence[tuple[Sequence[str], int]], split: bool = False) -> DataFrame:
    """Adds ``median`` and ``level``: the median of the first level whose group has enough rows.

    Each level is a grouping with its least group size; groups are small in
    number next to rows, so each level is a small table and one join. Spark's
    median brings a group's distinct values, with their counts, to one task;
    with ``split`` no task gets a whole group, at the price of further passes.
    """
    def medians(keys: Sequence[str], least: int) -> DataFrame:
        if split:
            return group_medians(df, keys, value, least)
        return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.median(value).alias("median"), F.count("*").alias("n")).where(F.col("n") >= least)

    out = df
    for k, (keys, least) in enumerate(levels):
        out = out.join(medians(keys, least).drop("n").withColumnRenamed("median", f"_m{k}"), list(keys), "left")
    level = F.coalesce(*(F.when(F.col(f"_m{k}").isNotNull(), k + 1) for k in range(len(levels))))
    return out.withColumn("median", F.coalesce(*(f"_m{k}" for k in range(len(levels))))).withColumn("level", level).drop(*(f"_m{k}" for k in range(len(levels))))


def ratio_score(found: Column, truth: Column) -> Column:
    """1 within ten percent, 0.5 within a factor of two, else 0; null without a truth."""
    r = F.try_divide(found, truth)
    return F.when(truth.isNull(), None).when(r.between(0.9, 1.1), 1.0).when(r.between(0.5, 2.0), 0.5).otherwise(0.0)


def stratified_rate(df: DataFrame, stratum: str, hit: Column, population: Mapping[str, int] | None = None) -> DataFrame:
    """Hit rate of each stratum and, where its population is known, the hits expected there."""
    out = df.groupBy(stratum).agg(F.count("*").alias("n"), F.round(F.avg(hit.cast("double")), 6).alias("rate"))
    if population:
        table = F.create_map(*(F.lit(x) for kv in population.items() for x in kv))
        out = out.withColumn("expected", F.round(F.col("rate") * F.try_element_at(table, F.col(stratum)), 2))
    return out


def token_cost(tokens_in: Column, tokens_out: Column, price_in: float, price_out: float) -> Column:
    return F.sum(tokens_in * price_in + tokens_out * price_out) / 1e6


def observed(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of aggregates over its rows, which the job that first uses them fills by the way.

    Rows are counted as they pass, so put it after the last filter that they should have passed.
    """
    seen = Observation()
    return df.observe(seen, *(c.alias(name) for name, c in counters.items())), seen


def flips(df: DataFrame, stratum: Column, key: Column, before: Column, after: Column, least: float, share: Mapping[str, float], seed: int = 42) -> DataFrame:
    """What a second rule set would change: ``stratum, rows, sampled, gained, lost, gained_total, gained_error, lost_total, lost_error``.

    Of a stratum the ``share`` (all where it isn't named) whose hash of key and seed
    is low is looked at; both scores are compared with ``least`` there, in one pass.
    Totals are extrapolated; an error is the standard error of one, 0 where all
    rows were looked at, null where fewer than two were.
    """
    shares = F.create_map(*(F.lit(x) for k, v in share.items() for x in (k, float(v)))) if share else F.create_map().cast("map<string,double>")
    digest = F.conv(F.left(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)))), F.lit(8)), 16, 10).cast("double") / 4294967296.0
    name = stratum.cast("string")
    rows = df.select(name.alias("stratum"), (digest < F.coalesce(F.try_element_at(shares, name), F.lit(1.0))).alias("in"), (before >= least).alias("b"), (after >= least).alias("a"))
    looked = F.col("in")
    one = rows.groupBy("stratum").agg(F.count("*").alias("rows"), F.count_if(looked).alias("sampled"), F.count_if(looked & ~F.col("b") & F.col("a")).alias("gained"), F.count_if(looked & F.col("b") & ~F.col("a")).alias("lost"))
    n, m = F.col("rows"), F.col("sampled")

    def total(k: str) -> Column:
        return F.round(F.try_divide(F.col(k) * n, m), 4).alias(f"{k}_total")

    def error(k: str) -> Column:
        p = F.try_divide(F.col(k), m)
        return F.when(n == m, F.lit(0.0)).otherwise(F.round(n * F.sqrt(F.try_divide(p * (1 - p), m - 1) * (1 - m / n)), 4)).alias(f"{k}_error")

    return one.select("stratum", "rows", "sampled", "gained", "lost", total("gained"), error("gained"), total("lost"), error("lost"))


def calibration(df: DataFrame, confidence: Column, correct: Column, by: Sequence[str] = (), width: int = 10) -> DataFrame:
    """``bin, n, mean_confidence, accuracy, gap`` for bins of a confidence from 0 to 100; 100 is in the last bin. Nulls are left out."""
    bins = F.least(F.floor(confidence / width), F.lit(100 // width - 1)) * width
    rows = df.select(*by, bins.cast("int").alias("bin"), confidence.cast("double").alias("_c"), correct.cast("double").alias("_y")).where("_c IS NOT NULL AND _y IS NOT NULL")
    out = rows.groupBy(*by, "bin").agg(F.count("*").alias("n"), F.avg("_c").alias("_mean"), F.avg("_y").alias("_hits"))
    return out.select(*by, "bin", "n", F.round("_mean", 4).alias("mean_confidence"), F.round("_hits", 6).alias("accuracy"), F.round(F.abs(F.col("_mean") / 100 - F.col("_hits")), 6).alias("gap"))


def match_scores(predicted: Column, truth: Column, confidence: Column, least: Column, most: Column) -> Column:
    """``match, calibrated`` of a predicted id: whether it is the true one, and 1, 0.5 or 0 by whether its confidence suits.

    A match must be made with ``least`` confidence, none with at most ``most``; a wrong id is 0.
    """
    sure = F.coalesce(confidence.try_cast("int"), F.lit(0))
    right = F.coalesce(predicted.cast("string"), F.lit("")) == F.coalesce(truth.cast("string"), F.lit(""))
    suits = F.when(truth.isNull(), F.when(predicted.isNull(), F.when(sure <= most, 1.0).otherwise(0.5)).otherwise(0.0)).otherwise(F.when(right, F.when(sure >= least, 1.0).otherwise(0.5)).otherwise(0.0))
    return F.struct(F.when(right, 1.0).otherwise(0.0).alias("match"), suits.alias("calibrated"))


def type_overlap(predicted: Column, truth: Column) -> Column:
    """1, 0.5 or 0: at least half of the true name's words longer than three letters found, some, or none. A missing truth is 1 for no answer and 0.5 for any."""
    plain = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))
    p, t = plain(predicted), plain(truth)
    words = F.array_distinct(F.filter(F.split(t, " "), lambda w: F.length(w) > 3))
    shared = F.size(F.array_intersect(words, F.split(p, " ")))
    return F.when(t == "", F.when(p == "", 1.0).otherwise(0.5)).when(p == "", 0.0).when((shared > 0) & (shared * 2 >= F.size(words)), 1.0).when(shared > 0, 0.5).otherwise(0.0)


def count_band(found: Column, truth: Column) -> Column:
    """1 for an equal whole number or within a fifth, 0.5 within a factor of two, else 0; a missing truth is 1 for no answer and 0.5 for any."""
    p, t = found.try_cast("double").cast("long"), truth.try_cast("double").cast("long")
    r = F.coalesce(F.try_divide(p, t), F.lit(0.0))
    return F.when(truth.isNull(), F.when(found.isNull(), 1.0).otherwise(0.5)).when(p.isNull() | t.isNull(), 0.0).when((p == t) | r.between(0.8, 1.2), 1.0).when(r.between(0.5, 2.0), 0.5).otherwise(0.0)


def translation_scores(predicted: Column, truth: Column, required: Column, forbidden: Column) -> Column:
    """``contains_forbidden, contains_required, token_overlap`` of a translated text; a forbidden term in it makes all 0."""
    plain = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+", " "))
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\b\w{4,}\b"), F.lit(0)))
    p, t = plain(predicted), plain(truth)
    none = F.array().cast("array<string>")
    bad = F.exists(F.coalesce(forbidden, none), lambda x: (plain(x) != "") & p.contains(plain(x)))
    all_in = F.forall(F.coalesce(required, none), lambda x: p.contains(plain(x)))
    share = F.when(F.size(words(t)) > 0, F.size(F.array_intersect(words(t), words(p))) / F.size(words(t))).otherwise(F.when(p != "", 1.0).otherwise(0.0))
    one = lambda c: F.when(bad, 0.0).otherwise(c)
    return F.struct(one(F.lit(1.0)).alias("contains_forbidden"), one(F.when(all_in, 1.0).otherwise(0.0)).alias("contains_required"), one(F.bround(share, 2)).alias("token_overlap"))


def ranked_models(scores: DataFrame, model: str, score: str, cost: str) -> DataFrame:
    """``model, n, score, cost, rank``: by mean score, of equals the cheaper first; models equal in both share a rank. There are few models."""
    means = scores.groupBy(model).agg(F.count("*").alias("n"), F.round(F.avg(score), 6).alias("score"), F.round(F.sum(cost), 6).alias("cost"))
    return means.withColumn("rank", F.rank().over(Window.orderBy(F.desc("score"), F.asc_nulls_last("cost"))).cast("long"))
