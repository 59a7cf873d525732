"""The queries over the given tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import mining
from ..functions import text as T
from ..operators import linkage, merge, metrics, ranking, resolve, rules
from ..sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RATES = {"EUR": 1.0, "USD": 0.92, "GBP": 1.17, "PLN": 0.23, "CZK": 0.04}
TODAY = "1997-06-01"
RULES = rules.ScoreRules(
    code_tiers=((("src10", "src11"), 30), (("src2", "src3"), 20), (("src1",), 5)),
    prefix=5,
    legal_marker="de",
    categories={"licence": ("license", "copyright"), "credential": ("password", "secret", "token"), "contact": ("@", "phone"), "insult": ("idiot", "stupid", "trash"), "network": ("http", "192.")},
    generic=("the ",),
    context=(" und ", " les ", " los "),
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return rules.relevance(docs, RULES, T.searchable(F.col("text")), F.lower(F.left("text", F.lit(200))), F.array("source"), F.col("lang"))


def _terms(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


def _first(column: str, terms) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{t}') THEN '{t}'" for t in terms) + " END"


def _scored_sql() -> str:
    def tier(codes):
        return "(" + " OR ".join(f"(starts_with(left(source, 5), '{c[:5]}') OR starts_with('{c[:5]}', left(source, 5)))" for c in codes) + ")"

    codes = "CASE " + " ".join(f"WHEN {tier(c)} THEN {p}" for c, p in RULES.code_tiers) + " ELSE 0 END"
    first = ", ".join(f"{_first('t', terms)} AS k_{name}" for name, terms in RULES.categories.items())
    points = " + ".join(f"CASE WHEN k_{name} IS NULL THEN 0 ELSE 15 + CASE WHEN contains(title, k_{name}) THEN 10 ELSE 0 END END" for name in RULES.categories)
    names = ", ".join(f"CASE WHEN k_{name} IS NOT NULL THEN '{name}' END" for name in RULES.categories)
    return f"""WITH d AS (SELECT doc_id, text, lang, source, lower(coalesce(text, '')) AS t, lower(left(text, 200)) AS title FROM documents),
 k AS (SELECT *, {first} FROM d),
 s AS (SELECT doc_id, text, lang, source, CAST({codes} + CASE WHEN contains(lang, 'de') THEN 25 ELSE 0 END + {points}
   + CASE WHEN {_terms('t', RULES.generic)} THEN 5 ELSE 0 END + CASE WHEN {_terms('t', RULES.context)} THEN 10 ELSE 0 END AS INTEGER) AS score,
   {_terms('t', RULES.context)} AS in_context, list_filter([{names}], lambda x: x IS NOT NULL) AS categories FROM k)"""


SCORED = _scored_sql()


@query(SCORED + " SELECT doc_id, score, in_context, array_to_string(categories, ',') AS categories FROM s")
def relevance_score(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "score", "in_context", F.array_join("categories", ",").alias("categories"))


@query(SCORED + ", r AS (SELECT *, row_number() OVER (PARTITION BY source, lang, left(text, 40) ORDER BY score DESC, doc_id) AS n FROM s WHERE score >= 25) SELECT doc_id, source, lang, score FROM r WHERE n = 1 ORDER BY score DESC, doc_id")
def relevant_deduplicated(spark, sf_dir):
    """The flagship: score, threshold, best row of each dedup key, order."""
    rows = rules.at_least(scored(spark, sf_dir), RULES.relevant).select("doc_id", "source", "lang", "score", F.left("text", F.lit(40)).alias("head"))
    best = ranking.best_row(rows, ["source", "lang", "head"], [ranking.descending(F.col("score")), F.col("doc_id")])
    return best.select("doc_id", "source", "lang", "score").orderBy(F.desc("score"), "doc_id")


@query(SCORED + " SELECT doc_id, score FROM s WHERE score >= 50")
def high_confidence(spark, sf_dir):
    return rules.at_least(scored(spark, sf_dir), RULES.confident).select("doc_id", "score")


@query(SCORED + " SELECT CAST(floor(score / 10.0) * 10 AS BIGINT) AS bucket, count(*) AS n FROM s GROUP BY 1")
def score_histogram(spark, sf_dir):
    return metrics.histogram(scored(spark, sf_dir), "score")


@query(SCORED + " SELECT c AS category, lang, count(*) AS n FROM (SELECT unnest(categories) AS c, lang FROM s) GROUP BY 1, 2")
def category_counts(spark, sf_dir):
    return scored(spark, sf_dir).select(F.explode("categories").alias("category"), "lang").groupBy("category", "lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id FROM documents WHERE CAST(contains(lower(text), 'password') AS INT) + CAST(contains(lower(text), 'token') AS INT) + CAST(contains(lower(text), '@') AS INT) >= 2 AND NOT contains(lower(text), 'license')")
def repair_only_filter(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(rules.repair_only(F.lower("text"), ["password", "token", "@"], ["license"])).select("doc_id")


@query("""SELECT doc_id, tier, reason FROM (SELECT doc_id, CASE WHEN contains(t, 'password') AND source = 'src0' THEN 'high' WHEN contains(t, 'license') THEN 'high' WHEN contains(t, 'token') THEN 'medium' WHEN lang = 'es' AND contains(t, '@') THEN 'medium' WHEN contains(t, 'stupid') THEN 'low' END AS tier,
 CASE WHEN contains(t, 'password') AND source = 'src0' THEN 'credential of hot source' WHEN contains(t, 'license') THEN 'licence' WHEN contains(t, 'token') THEN 'token' WHEN lang = 'es' AND contains(t, '@') THEN 'spanish contact' WHEN contains(t, 'stupid') THEN 'word' END AS reason FROM (SELECT *, lower(text) AS t FROM documents)) WHERE tier IS NOT NULL""")
def tiered_match(spark, sf_dir):
    t = F.lower("text")
    tier = rules.first_match([(t.contains("password") & (F.col("source") == "src0"), "high", "credential of hot source"), (t.contains("license"), "high", "licence"), (t.contains("token"), "medium", "token"), ((F.col("lang") == "es") & t.contains("@"), "medium", "spanish contact"), (t.contains("stupid"), "low", "word")])
    return read(spark, sf_dir, "documents").select("doc_id", tier.alias("m")).where("m IS NOT NULL").select("doc_id", "m.tier", "m.reason")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders) WHERE o_totalprice IS NULL OR o_totalprice = 0 OR o_totalprice >= 150000")
def value_threshold_unknown_passes(spark, sf_dir):
    v = F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderkey") % 11 == 0, 0.0).otherwise(F.col("o_totalprice"))
    return read(spark, sf_dir, "orders").select("o_orderkey", v.alias("o_totalprice")).where(rules.unknown_passes(F.col("o_totalprice"), 150000))


@query("SELECT source, lang, count(*) AS n FROM documents WHERE (contains(lower(source), 'src1') OR contains(lower(lang), 'fr')) AND NOT contains(source, 'src11') AND lang IN ('en', 'fr', 'de') GROUP BY 1, 2")
def scoped_sources(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.where(rules.any_pattern([F.col("source"), F.col("lang")], ["SRC1", "fr"]) & ~T.any_term(F.col("source"), ["src11"]) & F.col("lang").isin("en", "fr", "de")).groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("SELECT source, mode, n FROM (SELECT source, 'and' AS mode, count(*) AS n FROM documents WHERE contains(source, 'src0') AND contains(text, 'password') GROUP BY 1 UNION ALL SELECT source, 'or', count(*) FROM documents WHERE contains(source, 'src0') OR contains(text, 'password') GROUP BY 1 UNION ALL SELECT source, 'pass', count(*) FROM documents GROUP BY 1)")
def listing_modes(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("source", "text")
    a, k = F.col("source").contains("src0"), F.col("text").contains("password")
    kept = F.array_compact(F.array(*(F.when(rules.listing_predicate(m, a, k), F.lit(m)) for m in ("and", "or", "pass"))))
    return docs.select("source", F.explode(kept).alias("mode")).groupBy("source", "mode").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_type), 'a') AND NOT contains(lower(p_name), 'e')")
def whitelist_with_exclusions(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.where(rules.whitelisted(F.lower("p_type"), ["a"], []) & rules.whitelisted(F.concat(F.lit("#"), F.lower("p_name")), ["#"], ["e"])).select("p_partkey", "p_name")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def blocked_ids_removed(spark, sf_dir):
    return rules.without_listed(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").where("toxic = 1"), "doc_id").select("doc_id")


# --- best row of a group


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lower(left(source, 30)), lang, lower(left(text, 40)) ORDER BY n_chars DESC NULLS LAST, doc_id) AS r FROM documents) WHERE r = 1")
def dedup_best_row(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.left("text", F.lit(40)).alias("head"))
    return ranking.best_row(d, [T.dedup_key((F.col("source"), 30), (F.col("lang"), 2), (F.col("head"), 40))], [ranking.descending(F.col("n_chars")), F.col("doc_id")]).select("doc_id", "lang", "source")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY (CASE WHEN value IS NOT NULL AND value <> 0 THEN 1 ELSE 0 END + CASE WHEN props IS NOT NULL AND props <> '' THEN 1 ELSE 0 END) DESC, ts DESC, event_id) AS r FROM events) WHERE r = 1")
def dedup_completeness(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return ranking.best_row(e, ["user_id", "event_type"], [-ranking.completeness([F.col("props")], [F.col("value")]), -F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")]).select("event_id", "user_id", "event_type")


@query("SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def dedup_latest(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")).select("o_custkey", F.col("m.o_orderkey"), F.date_format("m.o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def first_wins(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy("l_partkey").agg(F.min(F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("m")).select("l_partkey", "m.l_orderkey", "m.l_linenumber")


@query("SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY 1")
def first_seen(spark, sf_dir):
    return ranking.first_seen(read(spark, sf_dir, "events"), "user_id", "ts").select("user_id", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("SELECT o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || ':7'), o_orderkey) AS r FROM orders) WHERE r <= 5")
def sample_of_each_status(spark, sf_dir):
    return ranking.sample_of_each(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey", 5, 7).select("o_orderstatus", "o_orderkey")


@query("SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC NULLS LAST, p_partkey) AS r FROM part) WHERE r = 1")
def max_value_index(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice")
    return ranking.best_row(p, ["p_brand"], [ranking.descending(F.col("p_retailprice")), F.col("p_partkey")])


# --- joins and set operations


@query("""WITH base AS (SELECT 'S' || s_suppkey AS id, s_nationkey || '' AS k, CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal END AS v, s_suppkey AS o FROM supplier),
 other AS (SELECT 'C' || c_custkey AS id, c_nationkey || '' AS k, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS v, c_custkey AS o FROM customer UNION ALL SELECT 'S' || s_suppkey, s_nationkey || '', 0, s_suppkey FROM supplier),
 fresh AS (SELECT * FROM other WHERE id NOT IN (SELECT id FROM base)), last AS (SELECT k, arg_max(id, o) AS id FROM base GROUP BY 1),
 donor AS (SELECT k, arg_min(v, o) FILTER (v IS NOT NULL) AS v FROM fresh WHERE k IN (SELECT k FROM base) GROUP BY 1)
 SELECT b.id, round(coalesce(b.v, d.v), 2) AS v, CASE WHEN d.k IS NULL THEN 'kept' ELSE 'enriched' END AS merged FROM base b LEFT JOIN last l USING (k, id) LEFT JOIN donor d ON d.k = l.k
 UNION ALL SELECT id, round(v, 2), 'appended' FROM fresh WHERE k NOT IN (SELECT k FROM base)""")
def merge_anti_enrich(spark, sf_dir):
    s, c = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "customer")
    base = s.select(F.concat(F.lit("S"), "s_suppkey").alias("id"), F.col("s_nationkey").cast("string").alias("k"), F.when(F.col("s_suppkey") % 5 != 0, F.col("s_acctbal")).alias("v"), F.col("s_suppkey").alias("o"))
    other = c.select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("k"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"), F.col("c_custkey").alias("o"))
    again = base.withColumn("v", F.lit(0).cast(base.schema["v"].dataType))
    return merge.merge_sources(base, other.unionByName(again), "id", "k", "o", ["v"]).select("id", F.round("v", 2).alias("v"), F.col("_merge").alias("merged"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')")
def anti_missing(spark, sf_dir):
    return read(spark, sf_dir, "customer").join(read(spark, sf_dir, "orders").where("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def semi_subset(spark, sf_dir):
    return read(spark, sf_dir, "part").join(read(spark, sf_dir, "lineitem").where("l_quantity >= 49"), F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_name")


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def intersect_ids(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id").intersect(read(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_ids(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id").subtract(read(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT l.l_orderkey, l.l_linenumber, coalesce(a.s_name, b.s_name) AS s_name FROM lineitem l LEFT JOIN supplier a ON a.s_suppkey = CASE WHEN l.l_linenumber % 2 = 0 THEN l.l_suppkey END LEFT JOIN supplier b ON b.s_suppkey = l.l_partkey")
def award_lookup_fallback_key(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).alias("k1"), F.col("l_partkey").alias("k2"))
    return merge.lookup_with_fallback(li, read(spark, sf_dir, "supplier"), ["k1", "k2"], "s_suppkey", "s_name").select("l_orderkey", "l_linenumber", "s_name")


@query("SELECT a AS order_id, b AS other_id, days, CAST(r AS INTEGER) AS rank FROM (SELECT x.o_orderkey AS a, y.o_orderkey AS b, CAST(abs(date_diff('day', CAST(y.o_orderdate AS DATE), CAST(x.o_orderdate AS DATE))) AS INTEGER) AS days, row_number() OVER (PARTITION BY x.o_orderkey ORDER BY abs(date_diff('day', CAST(y.o_orderdate AS DATE), CAST(x.o_orderdate AS DATE))), y.o_orderkey) AS r FROM orders x JOIN orders y ON x.o_custkey = y.o_custkey AND x.o_orderkey <> y.o_orderkey AND abs(date_diff('day', CAST(y.o_orderdate AS DATE), CAST(x.o_orderdate AS DATE))) <= 120) WHERE r <= 5")
def candidate_topk_range(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    a, b = o.select("o_custkey", F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("d1")), o.select("o_custkey", F.col("o_orderkey").alias("other_id"), F.col("o_orderdate").alias("d2"))
    return linkage.range_candidates(a, b, "o_custkey", "order_id", "other_id", "d1", "d2", 120, 5)


_OFFER_NOISE, _OFFER_GOODS = ("new", "old"), ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
_TOKENS_SQL = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{3,}}'))"
_OFFERS_SQL = f"""WITH t AS (SELECT l_orderkey AS id, list_distinct(flatten(list({_TOKENS_SQL.format("p_name")}))) AS w, list_distinct(list(left(p_type, 5))) AS codes FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
 o AS (SELECT o_orderkey AS id, o_custkey AS b, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS s, {_TOKENS_SQL.format("o_orderpriority")} AS authority, coalesce(list_filter(w, lambda x: x NOT IN {_OFFER_NOISE}), []) AS title, coalesce(list_filter(w, lambda x: x IN {_OFFER_GOODS}), []) AS goods, coalesce(codes, []) AS codes FROM orders LEFT JOIN t ON id = o_orderkey),
 x AS (SELECT * FROM o WHERE s = 'O'), y AS (SELECT * FROM o WHERE s IN ('F', 'P')),
 xy AS (SELECT x.*, y.id AS other, y.d AS e, y.s AS other_s, y.authority AS a2, y.title AS t2, y.goods AS g2, y.codes AS c2 FROM x JOIN y ON x.b = y.b UNION ALL SELECT x.*, y.id, y.d, y.s, y.authority, y.title, y.goods, y.codes FROM x, y WHERE x.b IS NULL UNION ALL SELECT x.*, y.id, y.d, y.s, y.authority, y.title, y.goods, y.codes FROM x, y WHERE x.b IS NOT NULL AND y.b IS NULL),
 m AS (SELECT id, other, other_s, len(list_intersect(authority, a2)) AS na, len(list_intersect(title, t2)) AS nt, len(list_intersect(goods, g2)) AS ng, len(list_intersect(codes, c2)) AS nc FROM xy WHERE coalesce(abs(date_diff('day', d, e)) <= 365, TRUE))"""


def _offers(spark, sf_dir):
    """Orders as notices: still open ones, and decided ones within a year of the same customer, with what they share."""
    kinds = read(spark, sf_dir, "part").select("p_partkey", T.tokens(F.col("p_name")).alias("words"), F.left("p_type", F.lit(5)).alias("code"))
    met = read(spark, sf_dir, "lineitem").join(kinds, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("o_orderkey"), "words", "code")
    # dealt out first: an order's lines lie in many tasks, so sets made before the shuffle would only be sorted and written again
    lines = met.repartition("o_orderkey").groupBy("o_orderkey").agg(F.array_distinct(F.flatten(F.collect_set("words"))).alias("w"), F.collect_set("code").alias("codes"))
    within = lambda terms: F.array(*(F.lit(t) for t in terms))
    o = read(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", T.tokens(F.col("o_orderpriority")).alias("authority"), F.array_except("w", within(_OFFER_NOISE)).alias("title"), F.array_intersect("w", within(_OFFER_GOODS)).alias("goods"), "codes")
    return o.where("o_orderstatus = 'O'").withColumnsRenamed({"o_orderkey": "order_id", "o_orderdate": "d1"}), o.where("o_orderstatus IN ('F', 'P')").withColumnsRenamed({"o_orderkey": "other_id", "o_orderdate": "d2"})


@query(_OFFERS_SQL + " SELECT id AS order_id, other AS other_id, score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS r FROM (SELECT id, other, round(na * 1.0::DOUBLE + nt * 0.6::DOUBLE + nc * 0.7::DOUBLE, 6) AS score FROM m) WHERE score > 0) WHERE r <= 5")
def award_candidates(spark, sf_dir):
    open_, decided = _offers(spark, sf_dir)
    pairs = linkage.shared_counts(open_, decided, ["authority", "title", "codes"], "o_custkey", "order_id", "other_id", "d1", "d2", 365)
    return linkage.scored_candidates(pairs, {"authority": 1.0, "title": 0.6, "codes": 0.7}, "order_id", "other_id", 5)


@query(_OFFERS_SQL + " SELECT id AS order_id, other AS other_id, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS r FROM (SELECT id, other, nc * 2 + least(na * 0.5::DOUBLE, 3.0) + ng AS score FROM m WHERE other_s = 'F') WHERE score >= 1) WHERE r = 1")
def award_best_match(spark, sf_dir):
    open_, decided = _offers(spark, sf_dir)
    pairs = linkage.shared_counts(open_, decided.where("o_orderstatus = 'F'"), ["codes", "authority", "goods"], "o_custkey", "order_id", "other_id", "d1", "d2", 365)
    scored_pairs = pairs.select("order_id", "other_id", linkage.match_score(F.col("codes"), F.col("authority"), F.col("goods")).alias("score"))
    return linkage.best_match(scored_pairs, "order_id", "other_id", "score", 1.0)


_WORDS_SQL = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{4,}}'))"


@query(f"WITH b AS (SELECT item_id, unnest({_WORDS_SQL.format('text')}) AS w FROM benchmark), c AS (SELECT conv_id * 1000 + turn AS turn_id, unnest({_WORDS_SQL.format('text')}) AS w FROM conversations) SELECT item_id, turn_id, count(*) AS shared FROM b JOIN c USING (w) GROUP BY 1, 2 HAVING count(*) >= 4")
def token_overlap_join(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), "text")
    return linkage.token_overlap(read(spark, sf_dir, "benchmark"), turns, "item_id", "turn_id", "text", "text", 4, 4)


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem), p AS (
 SELECT o_orderkey, 1 AS s, min(l_partkey) AS other FROM orders JOIN l ON l_orderkey = o_orderkey AND l_linenumber = 4 GROUP BY 1
 UNION ALL SELECT o_orderkey, 2, max(l_partkey) FROM orders JOIN l ON l_orderkey = o_orderkey AND l_linenumber = 2 GROUP BY 1
 UNION ALL SELECT o_orderkey, 3, min(l_partkey) FROM orders JOIN l ON l_orderkey = o_orderkey GROUP BY 1)
 SELECT o_orderkey, other AS l_partkey, s AS strategy FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY s, other) AS r FROM p) WHERE r = 1""")
def cross_reference_priority(spark, sf_dir):
    pairs = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_partkey", "l_linenumber")
    return linkage.by_priority([(pairs.where("l_linenumber = 4"), False), (pairs.where("l_linenumber = 2"), True), (pairs, False)], "o_orderkey", "l_partkey")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN 'OVERRIDDEN' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def overrides_applied(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    over = c.where("c_custkey % 10 = 0").select("c_custkey", F.lit("OVERRIDDEN").alias("c_mktsegment"))
    return merge.apply_overrides(c, over, "c_custkey", ["c_mktsegment"])


@query("SELECT o_orderkey, sha1(o_orderpriority || o_orderstatus) AS key, o_orderkey % 4 <> 0 AND o_orderdate >= TIMESTAMP '1995-01-01' AS hit FROM orders")
def cache_lookup(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", T.cache_key(F.concat("o_orderpriority", "o_orderstatus")).alias("key"), "o_orderdate")
    cache = o.where("o_orderkey % 4 <> 0").select("o_orderkey", F.col("o_orderdate").alias("cached_at"), F.lit(True).alias("value"))
    hits, misses = merge.with_cache(o, cache, "o_orderkey", "value", F.col("cached_at") >= F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")))
    return hits.select("o_orderkey", "key", F.lit(True).alias("hit")).unionByName(misses.select("o_orderkey", "key", F.lit(False).alias("hit")))


# --- resolution


def _rounded(x: str) -> str:
    """Two decimals of the number as it is written: halves of its shortest decimal form go up."""
    return f"CAST(CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(36, 16)) AS DECIMAL(18, 2)) AS DOUBLE)"


@query(f"SELECT o_orderkey, {_rounded('CASE WHEN o_orderkey % 6 = 0 AND o_totalprice > 0.01 THEN o_totalprice WHEN r IS NOT NULL AND o_totalprice > 0.01 THEN o_totalprice * r ELSE 0 END')} AS eur FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.92 WHEN 2 THEN 1.17 WHEN 3 THEN 0.23 END AS r FROM orders)")
def fx_convert(spark, sf_dir):
    cur = F.element_at(F.array(*map(F.lit, ("EUR", "usd", "GBP", "PLN", "XXX"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", resolve.eur_for_ui(F.when(F.col("o_orderkey") % 6 == 0, F.col("o_totalprice")), [(F.col("o_totalprice"), cur)], RATES).alias("eur"))


@query(f"SELECT o_orderkey, {_rounded('CASE WHEN o_totalprice > 0 THEN o_totalprice * coalesce(r, 1.0) END')} AS eur, CAST(round(o_totalprice * r) AS BIGINT) AS sheet_eur FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.92 WHEN 2 THEN 1.17 WHEN 3 THEN 0.23 END AS r FROM orders)")
def fx_unknown_policy(spark, sf_dir):
    cur = F.element_at(F.array(*map(F.lit, ("EUR", "usd", "GBP", "PLN", "XXX"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.round(resolve.eur_for_filter([(F.col("o_totalprice"), cur)], RATES), 2).alias("eur"), resolve.eur_for_sheet(F.col("o_totalprice"), cur, RATES).alias("sheet_eur"))


_STATUS = """SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'Winner' END AS winner, CASE o_orderkey % 7 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'corrigendum' WHEN 2 THEN 'award notice' WHEN 3 THEN 'cn' END AS kind,
 CASE WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'F' THEN 'Closed' END AS trusted, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 60 END AS deadline, CAST(o_orderdate AS DATE) AS published, DATE '1997-06-01' AS today FROM orders"""


def _status(spark, sf_dir):
    k = F.col("o_orderkey")
    published = F.to_date("o_orderdate")
    return read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 13 == 0, "Winner").alias("winner"), F.when(k % 7 == 0, "cancelled").when(k % 7 == 1, "corrigendum").when(k % 7 == 2, "award notice").when(k % 7 == 3, "cn").alias("kind"), F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "F", "Closed").alias("trusted"), F.when(k % 3 == 0, F.date_add(published, 60)).alias("deadline"), published.alias("published"), F.to_date(F.lit(TODAY)).alias("today"))


@query(f"""SELECT o_orderkey, CASE WHEN winner <> '' THEN 'Awarded' WHEN contains(kind, 'cancel') OR contains(kind, 'withdraw') THEN 'Cancelled' WHEN contains(kind, 'modification') OR contains(kind, 'corrigendum') THEN 'Closed' WHEN contains(kind, 'award') OR contains(kind, 'result') THEN 'Awarded'
 WHEN (contains(kind, 'open') OR contains(kind, 'cn')) AND deadline IS NOT NULL THEN CASE WHEN deadline > today THEN 'Open' ELSE 'Closed' END WHEN (contains(kind, 'open') OR contains(kind, 'cn')) AND date_diff('day', published, today) <= 180 THEN 'Open'
 WHEN trusted IS NOT NULL THEN trusted WHEN deadline > today THEN 'Open' WHEN deadline IS NULL AND date_diff('day', published, today) < 90 THEN 'Open' ELSE 'Closed' END AS status FROM ({_STATUS})""")
def status_waterfall_ui(spark, sf_dir):
    c = F.col
    return _status(spark, sf_dir).select("o_orderkey", resolve.status_for_ui(c("winner"), c("kind"), c("trusted"), c("deadline"), c("published"), c("today")).alias("status"))


@query(f"SELECT o_orderkey, CASE WHEN winner <> '' THEN 'Awarded' WHEN deadline IS NOT NULL THEN CASE WHEN deadline >= today THEN 'Open' ELSE 'Closed' END WHEN date_diff('day', published, today) BETWEEN 0 AND 179 THEN 'Open' ELSE 'Closed' END AS status FROM ({_STATUS})")
def status_waterfall_sheet(spark, sf_dir):
    c = F.col
    return _status(spark, sf_dir).select("o_orderkey", resolve.status_for_sheet(c("winner"), c("deadline"), c("published"), F.year("published"), c("today")).alias("status"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Awarded' ELSE '' END AS status FROM orders")
def vendor_status_map(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", resolve.vendor_status(F.col("o_orderstatus"), {"o": "Open", "f": "Closed", "p": "Awarded"}).alias("status"))


@query("SELECT c_custkey, CASE n_name WHEN 'NATION_1' THEN 'DE' WHEN 'NATION_2' THEN 'FR' WHEN 'NATION_3' THEN 'GB' ELSE coalesce(CASE r_name WHEN 'AFRICA' THEN 'ZA' WHEN 'ASIA' THEN 'JP' END, 'Unknown') END AS iso2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def country_alias(spark, sf_dir):
    """The nation's name as an alias in capitals, as written or in title case, else the region's."""
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    written = F.concat(F.when(F.col("n_regionkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")), F.lit("\n"), F.col("n_name"))
    iso = resolve.country({"NATION_1": "DE", "Nation_2": "FR", "NATION_2": "FR", "NATION_3": "GB", "Africa": "ZA", "ASIA": "JP"}, written, F.lower("r_name"), default="Unknown")
    return read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", iso.alias("iso2"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'DE-' || s_suppkey WHEN s_suppkey % 3 = 1 THEN CAST(s_suppkey AS VARCHAR) || '-2024' ELSE 'DE-' || s_suppkey END AS id FROM supplier")
def formatted_ids(spark, sf_dir):
    k = F.col("s_suppkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("DE-DE-"), k)).when(k % 3 == 1, F.concat(k, F.lit("-2024"))).otherwise(k.cast("string"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", T.formatted_id(raw, F.lit("DE")).alias("id"))


@query("SELECT doc_id, CASE WHEN source = 'src0' THEN 'hot portal' WHEN source = 'src1' THEN 'first portal' WHEN lang = 'de' THEN 'German portal' WHEN lang = 'fr' THEN 'French portal' WHEN lang IS NULL THEN 'TED' ELSE 'other' END AS label FROM documents")
def source_labels(spark, sf_dir):
    """By source, else by the language that the id starts with, else by the form of the id."""
    record = F.coalesce(F.concat("lang", F.lit("-"), "doc_id"), F.concat("doc_id", F.lit("-2024")))
    labels = {"src0": "hot portal", "src1": "first portal", "de": "German portal", "fr": "French portal"}
    return read(spark, sf_dir, "documents").select("doc_id", resolve.source_label(F.col("source"), record, labels).alias("label"))


@query("SELECT s_suppkey, 'A ' || s_name || ' / B' AS winner, trim(split_part(s_name || ', Dept - X', ',', 1)) AS short FROM supplier")
def names_cleaned(spark, sf_dir):
    n = F.col("s_name")
    lines = F.concat(F.lit(" A "), n, F.lit("\n\nB\nA "), n, F.lit("\n"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", T.distinct_lines(lines).alias("winner"), T.short_name(F.concat(n, F.lit(", Dept - X"))).alias("short"))


# --- metrics


@query("""WITH o AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders), g AS (
 SELECT 'all' AS dim, 'all' AS value, * FROM o UNION ALL SELECT 'o_orderstatus', o_orderstatus, * FROM o UNION ALL SELECT 'o_orderpriority', o_orderpriority, * FROM o)
 SELECT dim, value, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(*) FILTER (o_totalprice IS NULL OR o_totalprice = 0) AS n_without_value, min(d) AS first_date, max(d) AS last_date FROM g GROUP BY 1, 2""")
def snapshot_metrics(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return metrics.snapshot(o, "o_orderkey", "o_totalprice", "d", ["o_orderstatus", "o_orderpriority"])


@query("WITH a AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01' GROUP BY 1), b AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1) SELECT o_orderpriority, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b USING (o_orderpriority)")
def snapshot_delta(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    at = lambda t: F.to_timestamp_ntz(F.lit(t))
    count = lambda d: d.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return metrics.snapshot_delta(count(o.where(F.col("o_orderdate") < at("1995-01-01 00:00:00"))), count(o.where(F.col("o_orderdate") >= at("1997-01-01 00:00:00"))), ["o_orderpriority"])


@query("SELECT source, count(*) AS n, round(avg(CASE WHEN quality IS NOT NULL THEN 100.0 ELSE 0.0 END), 2) AS pct_label, round(avg(CASE WHEN toxic = 1 THEN 100.0 ELSE 0.0 END), 2) AS pct_toxic, round(avg(CASE WHEN length(text) > 2000 THEN 100.0 ELSE 0.0 END), 2) AS pct_long FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def coverage_matrix(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("n_text")).join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return metrics.coverage(d, "source", {"label": F.col("quality").isNotNull(), "toxic": F.col("toxic") == 1, "long": F.col("n_text") > 2000})


@query("SELECT source, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr FROM documents GROUP BY 1")
def crosstab_pivot(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count(F.lit(1))).na.fill(0)


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, p_brand, p_type, l_extendedprice AS v FROM lineitem JOIN part ON l_partkey = p_partkey), a AS (SELECT p_brand, p_type, median(v) AS m FROM l GROUP BY 1, 2 HAVING count(*) >= 2), b AS (SELECT p_brand, median(v) AS m FROM l GROUP BY 1 HAVING count(*) >= 2), c AS (SELECT p_type, median(v) AS m FROM l GROUP BY 1 HAVING count(*) >= 3)
 SELECT l_orderkey, l_linenumber, round(coalesce(a.m, b.m, c.m), 4) AS median, CASE WHEN a.m IS NOT NULL THEN 1 WHEN b.m IS NOT NULL THEN 2 WHEN c.m IS NOT NULL THEN 3 END AS level FROM l LEFT JOIN a USING (p_brand, p_type) LEFT JOIN b USING (p_brand) LEFT JOIN c USING (p_type)""")
def median_waterfall(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_brand", "p_type", F.col("l_extendedprice").alias("v"))
    return metrics.median_waterfall(li, "v", [(["p_brand", "p_type"], 2), (["p_brand"], 2), (["p_type"], 3)]).select("l_orderkey", "l_linenumber", F.round("median", 4).alias("median"), "level")


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 10")
def top_sources(spark, sf_dir):
    return metrics.top_counts(read(spark, sf_dir, "documents"), "source", 10)


@query("SELECT sha1(text) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def repeated_texts(spark, sf_dir):
    return metrics.repeated(read(spark, sf_dir, "documents").select(T.cache_key(F.col("text")).alias("key")), "key")


@query("SELECT o_orderpriority, count(*) FILTER (l_shipdate > o_orderdate) AS n_after, count(*) FILTER (l_shipdate = o_orderdate) AS n_same, count(*) FILTER (l_shipdate < o_orderdate) AS n_before FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def date_directions(spark, sf_dir):
    j = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    s, o = F.col("l_shipdate"), F.col("o_orderdate")
    return metrics.conditional_counts(j, "o_orderpriority", {"after": s > o, "same": s == o, "before": s < o})


@query("SELECT event_type, count(*) AS n, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS rate, round(round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) * 1000, 2) AS expected FROM events GROUP BY 1")
def stratified_rates(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    out = metrics.stratified_rate(e, "event_type", F.coalesce(F.col("value") > 50, F.lit(False)))
    return out.withColumn("expected", F.round(F.col("rate") * 1000, 2))


@query("SELECT l_returnflag, avg(CASE WHEN l_extendedprice / (l_quantity * 1000) BETWEEN 0.9 AND 1.1 THEN 1.0 WHEN l_extendedprice / (l_quantity * 1000) BETWEEN 0.5 AND 2.0 THEN 0.5 ELSE 0.0 END) AS score FROM lineitem GROUP BY 1")
def ratio_eval(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(F.avg(metrics.ratio_score(F.col("l_extendedprice"), F.col("l_quantity") * 1000)).alias("score"))


# --- text functions


@query("SELECT o_orderkey, o_totalprice AS english, o_totalprice AS continental, o_totalprice AS spaced, o_totalprice AS plain FROM orders")
def amount_parse(spark, sf_dir):
    """Every price written with four kinds of separators and read again."""
    english = F.format_number("o_totalprice", 2)
    spaced = F.replace(F.replace(english, F.lit(","), F.lit("\u00a0")), F.lit("."), F.lit(","))
    written = {"english": english, "continental": F.translate(english, ",.", ".,"), "spaced": spaced, "plain": F.col("o_totalprice").cast("decimal(18,2)").cast("string")}
    return read(spark, sf_dir, "orders").select("o_orderkey", *(X.amount(c).alias(n) for n, c in written.items()))


@query("""SELECT p_partkey, CASE WHEN p_size * 2500 <= 100000 THEN p_size * 2500 END AS quantity, CASE WHEN p_size * 2500 <= 100000 THEN ['up_to_N_trailer', 'N_trailer', 'N_units', 'quantity_field', 'Nx_trailer'][p_partkey % 5 + 1] END AS source FROM part""")
def mined_fields(spark, sf_dir):
    """Each part's number written in one of five forms, with points or commas between thousands, and found again up to 100,000."""
    english = F.format_number(F.col("p_size") * 2500, 0)
    n = F.when(F.col("p_partkey") % 2 == 0, F.translate(english, ",", ".")).otherwise(english)
    forms = (("delivery of up to ", " trailers"), ("wanted: ", " Trailer of any kind"), ("NSN A. Needed: ", " Stück"), ("Menge : ", " in all"), ("about ", " × remorque"))
    text = F.element_at(F.array(*(F.concat(F.lit(a), n, F.lit(b)) for a, b in forms)), (F.col("p_partkey") % 5 + 1).cast("int"))
    return read(spark, sf_dir, "part").withColumn("_found", X.detected_quantity(text)).select("p_partkey", "_found.quantity", "_found.source")


@query(r"SELECT doc_id, nullif(regexp_extract(text, '(?:password|passwd|token)=([0-9a-z]+)', 1), '') AS found, len(list_filter(regexp_split_to_array(regexp_replace(text, '([0-9])\.([0-9])', '\1_\2', 'g'), '[.!?]+'), lambda p: length(trim(p)) > 10)) AS sentences FROM documents")
def sentence_count(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.extract(F.col("text"), r"(?:password|passwd|token)=([0-9a-z]+)").alias("found"), T.sentence_count(F.col("text")).cast("long").alias("sentences"))


@query("SELECT doc_id, length(text) > 0 AND length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / length(text) >= 0.9 AND list_has_any(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'), ['the', 'and', 'with']) AS english FROM documents")
def likely_english(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.likely_english(F.col("text"), ["the", "and", "with"]).alias("english"))


@query("SELECT doc_id, sha1(text) AS key, left(sha1(text), 16) AS short_key FROM documents")
def sha1_cache_key(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.cache_key(F.col("text")).alias("key"), T.cache_key(F.col("text"), 16).alias("short_key"))


@query(r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS t FROM pages),
 b AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM a)
 SELECT page_id, md5(trim(regexp_replace(t, '[ \t\r\n\f\v]+', ' ', 'g'))) AS digest, length(trim(regexp_replace(t, '[ \t\r\n\f\v]+', ' ', 'g'))) AS n FROM b""")
def html_strip(spark, sf_dir):
    text = T.strip_html(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.md5(text).alias("digest"), F.length(text).cast("long").alias("n"))


_HOST = r"lower(nullif(regexp_extract(CASE WHEN regexp_matches(url, '^https?://') THEN url ELSE 'https://' || url END, '^https?://([^/?#:]+)', 1), ''))"


@query(f"SELECT page_id, {_HOST} AS host FROM pages")
def url_host(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.url_host(F.col("url")).alias("host"))


@query(f"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1")
def url_host_counts(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(T.url_host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'gone' WHEN 2 THEN 'blocked' WHEN 3 THEN 'error' ELSE 'redirect' END AS health FROM pages")
def url_health(spark, sf_dir):
    code = F.element_at(F.array(*map(F.lit, (200, 404, 403, 500, 302))), (F.col("page_id") % 5 + 1).cast("int"))
    return read(spark, sf_dir, "pages").select("page_id", T.url_health(code, F.lit("fine"), ["page not found"]).alias("health"))


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    fixed = T.repaired_json(F.concat(F.lit("```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n```")))
    return read(spark, sf_dir, "events").select("event_id", F.from_json(fixed, "k long")["k"].alias("k"))


@query("SELECT vec_id, 'LOT-' || lpad(CAST(i AS VARCHAR), 4, '0') AS lot, CAST(embedding[i] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def lots_zip(spark, sf_dir):
    lots = resolve.numbered_lots(F.col("embedding"), F.transform("embedding", lambda x: x.cast("string")))
    return read(spark, sf_dir, "embeddings").select("vec_id", F.explode(lots).alias("l")).select("vec_id", "l.lot", F.col("l.value").cast("double").alias("value"))


@query("SELECT w AS word, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{3,}'))) AS w FROM documents) GROUP BY 1 ORDER BY n DESC, word LIMIT 50")
def document_frequencies_top(spark, sf_dir):
    words = read(spark, sf_dir, "documents").select(F.explode(T.tokens(F.col("text"))).alias("word"))
    return metrics.top_counts(words, "word", 50)


_TYPES_SQL = " ".join(f"WHEN regexp_matches(text, '{p}', 'i') THEN '{name}'" for name, p in mining.KINDS.items())


@query(f"SELECT doc_id, CASE WHEN source = 'src0' THEN 'framework_agreement' {_TYPES_SQL} ELSE 'one_time' END AS kind FROM documents")
def contract_types(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", mining.contract_profile(F.when(F.col("source") == "src0", "FA-mix"), F.col("text"))["contract_type"].alias("kind"))


# --- increments


@query("SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def hwm_incremental(spark, sf_dir):
    return read(spark, sf_dir, "events").where(F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))).select("event_id", "event_type")


@query("""SELECT strftime(greatest(m, first), '%Y-%m-%d') AS first, strftime(least(m + INTERVAL 1 MONTH - INTERVAL 1 DAY, last), '%Y-%m-%d') AS last, count(o_orderkey) AS n FROM (SELECT min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last FROM orders) b,
 (SELECT unnest(generate_series(date_trunc('month', (SELECT min(o_orderdate) FROM orders)), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 MONTH)) AS m) g LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1, 2""")
def month_windows(spark, sf_dir):
    """Orders in each month between the first and the last, the outer months cut to these days."""
    o = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    span = o.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    windows = span.select(F.explode(readers.month_windows(F.col("a"), F.col("b"))).alias("w")).select("w.first", "w.last", F.trunc("w.first", "month").alias("month"))
    counts = o.groupBy(F.trunc("day", "month").alias("month")).agg(F.count("*").alias("n"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return windows.join(counts, "month", "left").select(text("first").alias("first"), text("last").alias("last"), F.coalesce("n", F.lit(0)).alias("n"))
