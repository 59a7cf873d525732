"""Queries that keep notices in order: listings by source, dates, specs, decisions, keywords, evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import notice_rules as N
from ..operators import metrics, portals
from .tables import query, read

_BUYERS, _WORDS, _CODES, _MARKERS = {"*": ("src1", "src7")}, {"*": ("the ", "die "), "EE-RP": ("que ",)}, ("src12", "src3"), {"DE-SB": "password", "FR-BP": "license"}
_MODE_SQL = {
    "and": "b AND k", "or": "b OR k", "buyer": "b", "keyword": "k", "pass": "true", "code": "b AND (k OR c)", "tiers": "(b AND (k OR c)) OR (k AND c)", "rich": "trim(coalesce(source, '')) = '' OR b", "marked": "m OR b", "fallback": "b AND k", "either": "b OR k",
}
_IN = {"buyer": "lower(coalesce(source, ''))", "title": "lower(coalesce(left(text, 80), ''))", "snippet": "lower(coalesce(substr(text, 81, 200), ''))"}


def _has_sql(fields, words) -> str:
    return "(" + (" OR ".join(f"contains({_IN[f]}, '{w}')" for f in fields for w in words) or "false") + ")"


def _portal_sql(flag: int) -> str:
    tables = (_BUYERS, _WORDS)
    return "CASE portal " + " ".join(f"WHEN '{p[0]}' THEN {_has_sql(p[2 + flag], tables[flag].get(p[0], tables[flag]['*']))}" for p in portals.PORTALS) + " END"


_SOURCES_SQL = "[" + ", ".join(f"'{p[0]}'" for p in portals.PORTALS) + "]"
_PASS_SQL = "CASE mode " + " ".join(f"WHEN '{m}' THEN {t}" for m, t in _MODE_SQL.items()) + " END"
_MODES_SQL = "CASE portal " + " ".join(f"WHEN '{p[0]}' THEN '{p[1]}'" for p in portals.PORTALS) + " END"


@query(f"""WITH d AS (SELECT *, {_SOURCES_SQL}[doc_id % 26 + 1] AS portal FROM documents), t AS (SELECT doc_id, portal, source, {_MODES_SQL} AS mode, {_portal_sql(0)} AS b, {_portal_sql(1)} AS k, coalesce(starts_with(source, 'src12') OR starts_with(source, 'src3'), false) AS c,
 CASE portal WHEN 'DE-SB' THEN contains({_IN["snippet"]}, 'password') WHEN 'FR-BP' THEN contains({_IN["snippet"]}, 'license') ELSE false END AS m FROM d), p AS (SELECT *, {_PASS_SQL} AS passes FROM t), s AS (SELECT portal, bool_or(passes) AS served FROM p GROUP BY 1)
 SELECT doc_id, portal, CASE WHEN mode = 'tiers' AND NOT b THEN 'medium' ELSE 'high' END AS confidence FROM p JOIN s USING (portal) WHERE passes OR (NOT served AND ((mode = 'fallback' AND b) OR mode = 'either'))""")
def portal_listings(spark, sf_dir):
    """Documents as listings of 26 portals, each by its own rule."""
    portal = F.element_at(F.array(*(F.lit(p[0]) for p in portals.PORTALS)), (F.col("doc_id") % 26 + 1).cast("int"))
    d = read(spark, sf_dir, "documents").select("doc_id", portal.alias("portal"), "source", F.left("text", F.lit(80)).alias("title"), F.substring("text", 81, 200).alias("snippet"), F.array("source").alias("codes"))
    rules = portals.portal_table(spark, _BUYERS, _WORDS, _CODES, _MARKERS)
    return portals.wanted_listings(d, rules, "portal", "source", "title", "snippet", "codes").select("doc_id", "portal", "confidence")


@query("""SELECT o_orderkey, d AS plain, d AS compact, d AS mail, d AS dashed, d AS leading, d AS dotted, NULL::VARCHAR AS none FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""")
def dates_in_all_forms(spark, sf_dir):
    """Every order's day as portals write it, and read again; a mere month is none."""
    at = lambda form: F.date_format("o_orderdate", form)
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", text(N.plain_date(F.concat(at("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))).alias("plain"), text(N.plain_date(at("yyyyMMdd"))).alias("compact"), N.portal_date(at("EEE, dd MMM yyyy HH:mm:ss 'GMT'"), "mail").alias("mail"),
        N.portal_date(F.when(F.col("o_orderkey") % 2 == 0, at("d-MMM-yyyy hh:mm a")).otherwise(at("d MMM yyyy")), "dashed").alias("dashed"), N.portal_date(F.when(F.col("o_orderkey") % 2 == 0, at("yyyy-MM-dd HH:mm")).otherwise(at("dd.MM.yyyy")), "leading").alias("leading"),
        N.portal_date(F.concat(F.lit("bis "), at("d.M.yyyy"), F.lit(" um 12 Uhr")), "dotted").alias("dotted"), text(N.plain_date(at("yyyy-MM"))).alias("none"),
    )


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN d WHEN 1 THEN d WHEN 2 THEN d ELSE r END AS day, CASE o_orderkey % 4 WHEN 0 THEN 'tender_period_start' WHEN 1 THEN 'tender_notice' WHEN 2 THEN 'tender_notice' ELSE 'contract_notice_fallback' END AS picked,
 CASE o_orderkey % 7 WHEN 0 THEN 'pin_notice' WHEN 1 THEN 'tender_notice' WHEN 2 THEN 'contract_notice_fallback' WHEN 3 THEN 'tender_notice' WHEN 4 THEN CASE WHEN o_orderstatus = 'F' THEN 'contract_notice_fallback' WHEN o_orderstatus = 'O' THEN 'pin_notice' ELSE 'tender_notice' END ELSE 'unknown' END AS told
 FROM (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate + INTERVAL 9 DAY, '%Y-%m-%d') AS r FROM orders)""")
def publication_sources(spark, sf_dir):
    """Which of four dates is the publication, and what the date of a record is by its id and kind."""
    k, d = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")
    empty = F.array().cast("array<string>")
    picked = N.picked_date(F.when(k == 0, d), F.when(k == 1, d).otherwise(""), F.when(k == 2, F.array(d, F.lit("2000-01-01"))).otherwise(empty), F.date_format(F.date_add("o_orderdate", 9), "yyyy-MM-dd"))
    n = F.col("o_orderkey").cast("string")
    beginnings = ("X", "CA-", "AU-CN", "AU-", "", "", "Q-")
    record = F.element_at(F.array(*(F.concat(F.lit(b), n, F.lit("-2024" if i == 4 else "")) for i, b in enumerate(beginnings))), (F.col("o_orderkey") % 7 + 1).cast("int"))
    kind = F.when(F.col("o_orderstatus") == "F", "Contract AWARD notice").when(F.col("o_orderstatus") == "O", "Prior information").otherwise("cn-standard")
    told = N.date_source(F.when(F.col("o_orderkey") % 7 == 0, "pin_notice").otherwise("unknown"), record, kind)
    return read(spark, sf_dir, "orders").withColumn("_p", picked).select("o_orderkey", "_p.day", F.col("_p.source").alias("picked"), told.alias("told"))


@query(r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || '-axle' WHEN 1 THEN 'single-axle' WHEN 2 THEN p_size || '-axle' END AS axles, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size * 1000 WHEN 1 THEN p_size * 2000 WHEN 2 THEN p_size * 500 ELSE p_size * 10 END AS BIGINT) AS payload_kg,
 CASE p_partkey % 4 WHEN 0 THEN p_size || 'mm × ' || (p_size + 1) || 'mm' WHEN 1 THEN p_size || 'mm × ' || (p_size + 1) || 'mm × ' || (p_size + 2) || 'mm' END AS dimensions, CASE WHEN p_type LIKE 'PROMO%' THEN 'armoured' END AS protection,
 CASE p_partkey % 4 WHEN 0 THEN 'good' WHEN 1 THEN 'empty' WHEN 2 THEN 'none' ELSE 'none' END AS quality, CASE p_partkey % 4 WHEN 0 THEN 'specific' WHEN 1 THEN 'specific' WHEN 2 THEN 'generic' ELSE 'specific' END AS class FROM part""")
def vehicle_specs(spark, sf_dir):
    """Specs of parts as if they were vehicles: from a structure for half of them, from words for the others."""
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    n = size.cast("string")
    spec = F.struct(
        F.when(k == 0, F.concat(n, F.lit(" axle low bed"))).when(k == 1, "low bed").alias("type"), F.when(k == 1, 9.0).alias("axle_load_t"), F.when(k == 0, size.cast("double")).alias("payload_t"), F.when(k < 2, size * 2.0).alias("mass_t"),
        F.when(k < 2, size.cast("double")).alias("length_mm"), F.when(k < 2, size + 1.4).alias("width_mm"), F.when(k == 1, size + 2.0).when(k == 0, 0.0).alias("height_mm"),
    )
    kind = F.when(k == 2, F.concat((size / 2).cast("string"), F.lit("t "), n, F.lit("-Axle trailer"))).when(k == 3, F.concat((size * 10).cast("string"), F.lit(" kg dolly")))
    specs = N.lifted_specs(spec, kind, F.when(F.col("p_type").startswith("PROMO"), "with a Blast-proof cabin").otherwise(F.col("p_type")))
    types = F.when(k == 0, F.array("p_name")).when(k == 1, F.array().cast("array<string>"))
    return read(spark, sf_dir, "part").withColumn("_s", specs).select("p_partkey", "_s.*", N.spec_quality(types, F.when(k < 2, 0.5)).alias("quality"), N.type_class(kind, spec["type"], r"(?i)trailer$").alias("class"))


@query(r"""WITH x AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'Note: ' || text ELSE left(text, 300) END AS t, CASE doc_id % 3 WHEN 0 THEN left(text, 300) ELSE '' END AS s, n_chars, text FROM documents),
 n AS (SELECT *, len(list_filter(regexp_split_to_array(regexp_replace(t, '([0-9])\.([0-9])', '\1_\2', 'g'), '[.!?]+'), lambda p: length(trim(p)) > 10)) AS sentences FROM x)
 SELECT doc_id, t IS NULL OR t = '' OR starts_with(lower(trim(t)), 'note:') OR sentences > 4 AS unclean, (CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'w' END) = '' OR n_chars IS NULL OR n_chars / 100000.0 <= 0.01 OR doc_id % 2 = 0 AS incomplete FROM n""")
def upkeep_needed(spark, sf_dir):
    """Which texts still want cleaning, and which records lack a winner, an amount or a quantity."""
    d = F.col("doc_id")
    t = F.when(d % 5 == 0, "").when(d % 5 == 1, F.concat(F.lit("Note: "), "text")).otherwise(F.left("text", F.lit(300)))
    unclean = N.needs_cleaning(t, F.when(d % 3 == 0, F.left("text", F.lit(300))).otherwise(""))
    incomplete = N.needs_enrichment(F.when(d % 3 == 0, "").otherwise("w"), F.col("n_chars") / 100000.0, F.when(d % 2 == 1, 1))
    return read(spark, sf_dir, "documents").select("doc_id", unclean.alias("unclean"), incomplete.alias("incomplete"))


@query("""WITH c AS (SELECT user_id AS k, max(ts) AS seen, count(*) AS n FROM events GROUP BY 1), j AS (SELECT c_custkey, c_mktsegment, c_acctbal, c.* FROM customer LEFT JOIN c ON k = c_custkey)
 SELECT c_custkey, k IS NOT NULL AND NOT (c_custkey % 5 = 0 OR n % 2 = 0 OR date_diff('second', seen, TIMESTAMP '2024-01-31 00:00:00') >= 10 * 86400 OR (c_mktsegment = 'BUILDING' AND c_custkey % 3 > 0)) AS fresh FROM j""")
def fresh_decisions(spark, sf_dir):
    """Whether a customer's cached decision still counts: by text, model, age and source."""
    c = read(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("at"), F.count("*").alias("n"))
    j = read(spark, sf_dir, "customer").join(c, F.col("user_id") == F.col("c_custkey"), "left")
    k = F.col("c_custkey")
    entry = F.struct(F.md5(k.cast("string")).alias("hash"), F.when(F.col("n") % 2 == 0, "old").otherwise("new").alias("model"), F.col("at").cast("timestamp").alias("checked_at"), F.when(k % 3 == 0, "structured").alias("source"))
    stale = N.is_stale(entry, F.md5(F.when(k % 5 == 0, "changed").otherwise(k.cast("string"))), "new", F.lit("2024-01-31 00:00:00").cast("timestamp"), 10, F.col("c_mktsegment") == "BUILDING", "structured")
    return j.select("c_custkey", (F.col("user_id").isNotNull() & ~stale).alias("fresh"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN nullif(p_type, '') WHEN 1 THEN p_name END AS first_type, CASE l_linenumber % 3 WHEN 2 THEN 7 ELSE coalesce(CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS INTEGER) END, 7) END AS first_quantity, CASE WHEN l_linenumber % 3 = 1 THEN 3 WHEN l_linenumber % 3 = 2 THEN 3 END AS second_quantity
 FROM lineitem JOIN part ON p_partkey = l_partkey""")
def decisions_applied(spark, sf_dir):
    """Slots after a decision of the old form, of the new one, and of the new one without any slot; known quantities 7 and 3."""
    j = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    kind = "array<struct<type:string,category:string,quantity:int>>"
    k, q = F.col("l_linenumber") % 3, F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("int"))
    one = F.struct(F.col("p_name").alias("type"), F.lit("").alias("category"), q.alias("quantity"))
    result = F.struct(F.when(k == 1, F.array(one)).when(k == 2, F.array()).cast(kind).alias("slots"), F.col("p_type").alias("type"), F.lit("c").alias("category"), q.alias("quantity"))
    known = F.array(*(F.struct(F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("category"), F.lit(n).alias("quantity")) for n in (7, 3)))
    slots = N.applied_slots(result, known)
    at = lambda n, field: F.get(F.col("_s"), F.lit(n))[field]
    return j.withColumn("_s", slots).select("l_orderkey", "l_linenumber", at(0, "type").alias("first_type"), at(0, "quantity").alias("first_quantity"), at(1, "quantity").alias("second_quantity"))


@query(r"""WITH w AS (SELECT DISTINCT unnest(string_split(p_type, ' ') || [p_name, ' ' || p_brand]) AS term FROM part), t AS (SELECT term, trim(term) AS t FROM w)
 SELECT term, NOT (length(t) < 4 OR lower(t) IN ('tank', 'promo') OR t LIKE 'Brand#1%') AS keep, CASE WHEN t = '' THEN 'empty' WHEN length(t) < 4 THEN 'length <4 (' || length(t) || ')' WHEN lower(t) IN ('tank', 'promo') THEN 'stoplist' WHEN t LIKE 'Brand#1%' THEN 'already in settings' WHEN regexp_matches(t, '\S\s+\S') THEN 'multi-word phrase' WHEN length(t) >= 6 THEN 'single word ≥6 chars (' || length(t) || ')' ELSE 'borderline single word (' || length(t) || ' chars)' END AS reason FROM t""")
def keywords_curated(spark, sf_dir):
    terms = read(spark, sf_dir, "part").select(F.explode(F.concat(F.split("p_type", " "), F.array("p_name", F.concat(F.lit(" "), "p_brand")))).alias("term")).distinct()
    return terms.withColumn("_c", N.curated(F.col("term"), ("tank", "promo"), F.trim("term").startswith("Brand#1"))).select("term", "_c.*")


@query("""SELECT o_orderkey, rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END, (CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 60""")
def reclassify_first(spark, sf_dir):
    """The 60 records to ask about anew: national ones first, then those that lack most."""
    k = F.col("o_orderkey")
    missing = N.gaps(F.when(k % 2 == 1, "x"), F.when(F.col("o_orderstatus") != "F", 5), F.when(k % 5 > 0, "y").otherwise(""))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, 0).otherwise(1).alias("n"), missing.alias("m")).orderBy("n", F.desc("m"), "o_orderkey").limit(60)
    return rows.select("o_orderkey", F.row_number().over(Window.orderBy("n", F.desc("m"), "o_orderkey")).cast("long").alias("rank"))  # 60 rows


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN 'https://second.org/' || page_id ELSE url END AS picked FROM pages""")
def page_urls_picked(spark, sf_dir):
    p = F.col("page_id")
    return read(spark, sf_dir, "pages").select("page_id", N.candidate_url(F.when(p % 3 == 0, F.col("url")).otherwise("www.none.org"), F.when(p % 3 == 1, F.concat(F.lit("https://second.org/"), p.cast("string"))), F.col("url")).alias("picked"))


_OLD, _NEW = ("die ", "the "), ("die ", "the ", "que ", "password")
_POINTS = lambda terms: " + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN 15 ELSE 0 END" for t in terms)


@query(f"""WITH d AS (SELECT coalesce(source, '(none)') AS stratum, doc_id, coalesce({_POINTS(_OLD)}, 0) AS b, coalesce({_POINTS(_NEW)}, 0) AS a, ('0x' || left(md5(doc_id || ':42'), 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents),
 g AS (SELECT stratum, count(*) AS rows, count(*) FILTER (i) AS sampled, count(*) FILTER (i AND b < 25 AND a >= 25) AS gained, count(*) FILTER (i AND b >= 25 AND a < 25) AS lost FROM (SELECT *, u < CASE stratum WHEN 'src0' THEN 0.25 WHEN 'src1' THEN 0.5 ELSE 1.0 END AS i FROM d) GROUP BY 1)
 SELECT *, round(gained * rows / nullif(sampled, 0)::DOUBLE, 4) AS gained_total, CASE WHEN rows = sampled THEN 0.0 WHEN sampled > 1 THEN round(rows * sqrt(gained / sampled::DOUBLE * (1 - gained / sampled::DOUBLE) / (sampled - 1) * (1 - sampled / rows::DOUBLE)), 4) END AS gained_error,
 round(lost * rows / nullif(sampled, 0)::DOUBLE, 4) AS lost_total, CASE WHEN rows = sampled THEN 0.0 WHEN sampled > 1 THEN round(rows * sqrt(lost / sampled::DOUBLE * (1 - lost / sampled::DOUBLE) / (sampled - 1) * (1 - sampled / rows::DOUBLE)), 4) END AS lost_error FROM g""")
def rescore_flips(spark, sf_dir):
    """What two more keywords would let pass, by source: two sources sampled, the others whole."""
    low = F.lower("text")
    points = lambda terms: F.coalesce(sum((F.when(low.contains(t), 15).otherwise(0) for t in terms), F.lit(0)), F.lit(0))
    return metrics.flips(read(spark, sf_dir, "documents"), F.coalesce("source", F.lit("(none)")), F.col("doc_id"), points(_OLD), points(_NEW), 25, {"src0": 0.25, "src1": 0.5})


@query("""WITH e AS (SELECT event_type, value, user_id % 3 <> 0 AS y FROM events WHERE value IS NOT NULL AND value BETWEEN 0 AND 100)
 SELECT event_type, CAST(least(floor(value / 10), 9) * 10 AS INTEGER) AS bin, count(*) AS n, round(avg(value), 4) AS mean_confidence, round(avg(CAST(y AS INTEGER)), 6) AS accuracy, round(abs(avg(value) / 100 - avg(CAST(y AS INTEGER))), 6) AS gap FROM e GROUP BY 1, 2""")
def confidence_bins(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("value BETWEEN 0 AND 100")
    return metrics.calibration(e, F.col("value"), (F.col("user_id") % 3 != 0).cast("int"), ["event_type"])


@query("""WITH s AS (SELECT l_shipdate, l_returnflag || l_linestatus AS model, CASE WHEN t = p THEN 1.0 WHEN p / t BETWEEN 0.8 AND 1.2 THEN 1.0 WHEN p / t BETWEEN 0.5 AND 2.0 THEN 0.5 ELSE 0.0 END AS score, l_tax AS cost FROM (SELECT *, CAST(l_quantity AS BIGINT)::DOUBLE AS t, CAST(floor(l_extendedprice / 1500) AS BIGINT)::DOUBLE AS p FROM lineitem)),
 m AS (SELECT model, count(*) AS n, round(avg(score), 6) AS score, round(sum(cost), 6) AS cost FROM s GROUP BY 1) SELECT *, rank() OVER (ORDER BY score DESC, cost) AS rank FROM m""")
def models_ranked(spark, sf_dir):
    """Return flags and statuses as models that estimate quantities from prices."""
    li = read(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("model"), metrics.count_band(F.floor(F.col("l_extendedprice") / 1500).cast("string"), F.col("l_quantity").cast("string")).alias("score"), F.col("l_tax").alias("cost"))
    return metrics.ranked_models(li, "model", "score", "cost")


_LANDS = ("Sweden", "Czech Republic", "United Kingdom", "Unknown")


@query("""WITH d AS (SELECT doc_id, ['Sweden', 'Czech Republic', 'United Kingdom', 'Unknown'][doc_id % 4 + 1] AS country, left(text, 5 + doc_id % 30) AS h FROM documents)
 SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN CASE WHEN country <> 'Unknown' AND length(h) >= 8 THEN h ELSE country || ' - ' || h END WHEN 1 THEN CASE WHEN country = 'Sweden' AND length(h) >= 8 THEN h ELSE 'SWEDEN Defence – ' || h END WHEN 2 THEN CASE WHEN country = 'Czech Republic' AND length(h) >= 8 THEN h ELSE 'Czechia Ministry of Defence- ' || h END WHEN 3 THEN CASE WHEN country = 'United Kingdom' AND length(h) >= 8 THEN h ELSE 'UK -  ' || h END ELSE country || '-' || h END AS title FROM (SELECT doc_id, country, trim(regexp_replace(h, '\\s', 'x', 'g')) AS h FROM d)""")
def titles_without_country(spark, sf_dir):
    """Heads of documents with a country before them in five forms, the last of which is no prefix."""
    d = F.col("doc_id")
    country = F.element_at(F.array(*(F.lit(c) for c in _LANDS)), (d % 4 + 1).cast("int"))
    head = F.regexp_replace(F.left("text", (5 + d % 30).cast("int")), r"\s", "x")
    forms = (F.concat(country, F.lit(" - "), head), F.concat(F.lit("SWEDEN Defence – "), head), F.concat(F.lit("Czechia Ministry of Defence- "), head), F.concat(F.lit("UK -  "), head), F.concat(country, F.lit("-"), head))
    title = F.element_at(F.array(*forms), (d % 5 + 1).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", N.without_country(title, country).alias("title"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN '' ELSE cc || '-' || page_id END AS tender_id, cc || '-X' AS source, strftime(DATE '2024-01-01' + CAST(page_id % 700 AS INTEGER), '%Y-%m-%d') AS published, CASE WHEN page_id % 2 = 0 THEN 'USD' WHEN cc = 'PL' THEN 'PLN' ELSE 'EUR' END AS currency, md5(left(html, 500)) AS description, length(left(html, 10000)) AS raw, '' AS status
 FROM (SELECT *, ['PL', 'FR', 'UA'][page_id % 3 + 1] AS cc FROM pages)""")
def pages_as_standard_notices(spark, sf_dir):
    """Pages as details of three portals, one without references and one that prefixes them itself."""
    p = F.col("page_id")
    code = F.element_at(F.array(F.lit("PL"), F.lit("FR"), F.lit("UA")), (p % 3 + 1).cast("int"))
    n, none = p.cast("string"), F.lit(None).cast("string")
    reference = F.when(p % 3 == 1, n).when(p % 3 == 2, F.concat(F.lit("UA-"), n))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (p % 700).cast("int")), "yyyy-MM-dd'T'00:00")
    detail = F.struct(reference.alias("reference"), F.col("url").alias("url"), none.alias("title"), none.alias("authority"), day.alias("date"), F.lit(1.0).alias("value"), F.when(p % 2 == 0, "USD").otherwise("").alias("currency"), none.alias("winner"), F.col("html").alias("description"), F.col("html").alias("raw_text"), none.alias("status"), F.lit(1).alias("quantity"), none.alias("duration"))
    s = N.standard_notice(detail, code, F.lit("Land"), F.concat(code, F.lit("-X")))
    return read(spark, sf_dir, "pages").withColumn("_s", s).select("page_id", "_s.tender_id", "_s.source", "_s.published", "_s.currency", F.md5("_s.description").alias("description"), F.length("_s.raw_text").cast("long").alias("raw"), "_s.status")
