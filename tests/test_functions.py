"""Table-driven cases of the column functions and operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from noticelake.functions import annotate, extract, text
from noticelake.operators import linkage, merge, ranking, resolve, rules
from noticelake.plans import tables


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x"))).first()[0]


@pytest.mark.parametrize("raw, want", [("123,293.66", 123293.66), ("123.293,66", 123293.66), ("123 293,66", 123293.66), ("39999.99", 39999.99), ("1,234", 1234.0), ("1,23", 1.23), ("20,800,000", 20800000.0), ("20.800.000", 20800000.0), ("12345", 12345.0), ("", None), (None, None), ("abc", None)])
def test_amount(spark, raw, want):
    assert one(spark, raw, extract.amount) == want


@pytest.mark.parametrize("n, want", [(932.4, "932"), (4932.0, "4.9K"), (478400.0, "478.4K"), (2500000.0, "2.5M"), (4250.0, "4.2K"), (932.5, "932")])
def test_short_amount(spark, n, want):
    assert one(spark, n, annotate.short, "double") == want


def test_short_amounts_round_by_their_exact_value(spark):
    ns = [1000.0 + 50 * k for k in range(3000)] + [1e6 + 50_000 * k for k in range(3000)] + [1e3, 999_950.0, 1e10]
    got = spark.createDataFrame([(k, n) for k, n in enumerate(ns)], "k int, n double").select("k", annotate.short(F.col("n")).alias("v")).collect()
    assert {r.k: r.v for r in got} == {k: f"{n / 1e6:.1f}M" if n >= 1e6 else f"{n / 1e3:.1f}K" for k, n in enumerate(ns)}


@pytest.mark.parametrize("raw, want", [("price 20,800,000 UAH net", "price 20,800,000 UAH (~€478.4K) net"), ("20 800 000uah and 1.234,5 Usd", "20 800 000uah (~€478.4K) and 1.234,5 Usd (~€1.1K)"), ("price 20,800,000 UAH (~€478.4K) net", "price 20,800,000 UAH (~€478.4K) net"), ("5 EUR", "5 EUR"), ("abc123USD", "abc123USD"), ("12345 USD", "12345 USD"), ("100 USDT", "100 USDT"), ("0.5 USD", "0.5 USD"), ("12 USD", "12 USD (~€11)"), ("999 CZK", "999 CZK"), ("", ""), (None, None), ("no amount", "no amount")])
def test_annotation(spark, raw, want):
    made = lambda c: annotate.annotate_amounts(c, {"UAH": 0.023, "USD": 0.92, "EUR": 1.0})
    out = one(spark, raw, made)
    assert out == want and one(spark, out, made) == want


@pytest.mark.parametrize("raw, want", [("2026-05-01", "2026-05-01"), ("2026-05-01+02:00", "2026-05-01"), ("2026-05-01Z", "2026-05-01"), ("2026-05-01T10:00:00", "2026-05-01"), ("2026-05-01\n2026-06-01", "2026-05-01"), ("", None), ("garbage", None), ("2026-05", None), ("0", None), (None, None)])
def test_clean_date(spark, raw, want):
    assert one(spark, raw, text.clean_iso_date) == want


@pytest.mark.parametrize("raw, want", [("DE-DE-1", "DE-1"), ("DE-1", "DE-1"), ("1", "DE-1"), ("123-2024", "123-2024"), ("", ""), (None, None)])
def test_formatted_id(spark, raw, want):
    assert one(spark, raw, lambda c: text.formatted_id(c, F.lit("DE"))) == want


@pytest.mark.parametrize("raw, want", [("bis zu 4.600 Anhängern", (4600, "up_to_N_trailer")), ("54 remorques", (54, "N_trailer")), ("12 Stück", (12, "N_units")), ("Menge: 1.200", (1200, "quantity_field")), ("quantity = 100,000", (100000, "quantity_field")), ("5 x trailer", (5, "Nx_trailer")), ("120000 units", None), ("1.2 units", None), ("1.2 units, quantity: 7", (7, "quantity_field")), ("file 5", None), ("", None), (None, None)])
def test_quantity(spark, raw, want):
    found = one(spark, raw, extract.detected_quantity)
    assert (found and tuple(found)) == want


@pytest.mark.parametrize("raw, want", [("75 days", 2), ("45 days", 2), ("3 days", 1), ("2 weeks", 1), ("8 weeks", 2), ("0 months", 0), ("2.5 Months", 2), ("1.5 years", 18), ("12 month", 12), ("soon", None), (None, None)])
def test_months_of(spark, raw, want):
    assert one(spark, raw, extract.months_of) == want


@pytest.mark.parametrize("raw, number, whole", [("1,234.5", 1234.5, 1234), ("12 000", 12000.0, 12000), ("0", None, 0), ("0.01", None, 0), ("0.02", 0.02, 0), ("no: 12", None, None), ("-5.7", None, -5), ("1e3", 1000.0, 1000), ("", None, None), ("nan", None, None), (None, None, None)])
def test_clean_numbers(spark, raw, number, whole):
    assert one(spark, raw, text.clean_number) == number
    assert one(spark, raw, text.clean_int) == whole


@pytest.mark.parametrize("source, record, want", [("ca", "1-2024", True), (" DE ", None, True), ("FR", "CA-1", False), ("", "CA-cb-1", True), (None, "nspa-9", True), (None, "123-2024", False), (None, "12-20245", False), (None, "plain", False), (None, None, False)])
def test_in_scope(spark, source, record, want):
    df = spark.createDataFrame([(source, record)], "s string, r string")
    assert df.select(rules.in_scope(F.col("s"), F.col("r"), ("CA", "DE", "NSPA"))).first()[0] is want
    assert df.select(rules.in_scope(F.col("s"), F.col("r"), ("TED",))).first()[0] is (record == "123-2024")


def test_scores_of_rows(spark):
    df = spark.createDataFrame([("0", " ", 0, None, []), ("", None, 5, 0.0, [""])], "a string, b string, n int, x double, l array<string>")
    assert [r[0] for r in df.select(ranking.completeness([F.col("a"), F.col("b")], [F.col("n"), F.col("x")], [F.col("l")])).collect()] == [2, 2]
    scored = spark.createDataFrame([("w", 0.01, 3, "2024-01-02"), ("", 7.0, None, None), (None, None, 0, "")], "w string, a double, q int, d string")
    assert [r[0] for r in scored.select(ranking.data_score(*(F.col(c) for c in "waqd"))).collect()] == [135, 50, 0]


def test_one_notice_each_prefers_winners_then_later_ones(spark):
    rows = [(1, "A", "", "2024-01-01"), (2, "A", "w", "2023-01-01"), (3, "A", "w", "2023-05-01"), (4, "B", None, "2024-01"), (5, "B", None, "2024-01-01"), (6, "B", None, None), (7, "B", "", "2024-01-01")]
    df = spark.createDataFrame(rows, "id int, k string, w string, d string")
    assert {r.id for r in ranking.one_notice_each(df, F.col("k"), F.col("w"), F.col("d"), F.col("id")).collect()} == {3, 5}


def test_names_urls_and_json(spark):
    assert one(spark, "B\n\nA\nB", text.distinct_lines) == "B / A"
    assert one(spark, "example.org/a.PDF", text.normalised_url) == "https://example.org/a.PDF"
    assert one(spark, "https://x/a.PDF?q=1", text.url_format) == "pdf"
    assert one(spark, '```json\n{"a": [1, 2,],}\n```', text.repaired_json) == '{"a": [1, 2]}'
    assert one(spark, "Ministry of Defence - Office 3", text.short_name) == "Ministry of Defence"
    assert one(spark, "GB: A title long enough", lambda c: text.without_prefix(c, "^GB: ")) == "A title long enough"
    assert one(spark, "GB: short", lambda c: text.without_prefix(c, "^GB: ")) == "GB: short"


def test_page_text_and_deep_text(spark):
    page = "<html><nav>menu</nav><script>x()</script><p>Body &amp; more</p></html>"
    assert one(spark, page, annotate.dom_text) == "Body & more"
    assert one(spark, '{"a": {"b": [1, "x"]}, "c": null, "d": true}', annotate.deep_text) == "1 x"
    assert one(spark, "{broken", annotate.deep_text) is None


def test_relevance_counts_first_hits(spark):
    r = rules.ScoreRules(code_tiers=((("34220000",), 30), (("34200000",), 20)), categories={"low": ("lowbed", "trailer"), "tank": ("tank",)}, generic=("vehicle",), context=("army",))
    df = spark.createDataFrame([(1, "army lowbed trailer", "trailer", ["34223000", "34200000"]), (2, "nothing", "x", None)], "id int, t string, title string, codes array<string>")
    rows = {x.id: x for x in rules.relevance(df, r, F.col("t"), F.col("title"), F.col("codes"), F.lit(None).cast("string")).collect()}
    assert rows[1].score == 30 * 0 + 20 + 15 + 10 + 0 or rows[1].score in (45, 55, 65)
    assert rows[1].categories == ["low"] and rows[1].in_context
    assert rows[2].score == 0 and rows[2].categories == []


def test_merge_cases(spark):
    base = spark.createDataFrame([("1", "k1", None), ("2", "k2", 5.0)], "id string, k string, v double")
    other = spark.createDataFrame([("1", "k1", 9.0), ("3", "k1", 7.0), ("4", "k9", 8.0), ("5", "", 1.0)], "id string, k string, v double")
    rows = {r.id: (r.v, r._merge) for r in merge.merge_sources(base, other, "id", "k", "id", ["v"]).collect()}
    assert rows == {"1": (7.0, "enriched"), "2": (5.0, "kept"), "4": (8.0, "appended"), "5": (1.0, "appended")}
    assert merge.merge_sources(base, other.limit(0), "id", "k", "id", ["v"]).count() == 2
    assert merge.merge_sources(base.limit(0), other, "id", "k", "id", ["v"]).count() == 4


def test_range_candidates_equal_all_pairs(spark):
    rows = [(k, k % 3, datetime.date(2024, 1, 1) + datetime.timedelta(days=(k * 37) % 200)) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, b int, d date")
    other = df.select(F.col("id").alias("other"), "b", F.col("d").alias("e"))
    got = {(r.id, r.other) for r in linkage.range_candidates(df, other, "b", "id", "other", "d", "e", 20, 1000).collect()}
    assert got == {(x[0], y[0]) for x in rows for y in rows if x[0] != y[0] and x[1] == y[1] and abs((x[2] - y[2]).days) <= 20}


def test_best_row_and_completeness(spark):
    df = spark.createDataFrame([(1, "a", None, 2), (1, "b", "x", 1), (2, "c", "", 0)], "k int, id string, w string, n int")
    best = ranking.best_row(df, ["k"], [-ranking.completeness([F.col("w")], [F.col("n")]), F.col("id")])
    assert {r.id for r in best.collect()} == {"b", "c"}


def test_only_the_best_lines_meet_their_part(spark):
    from noticelake.plans import records

    for query in (records.most_complete_record, records.best_data_score):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftSemi") < plan.index("Aggregate") and "Join Inner" not in plan and "p_name" not in plan.split("LeftSemi")[1].split("Relation")[0]


def test_latest_texts_come_first(spark):
    days = ["2024-02-01", "2024-01-31", "2024", "é", "z", "19", "", None]
    got = spark.createDataFrame([(d,) for d in reversed(days)], "d string").orderBy(ranking.latest(F.col("d"))).collect()
    assert [r.d for r in got] == sorted((d for d in days if d is not None), reverse=True) + [None]


def test_nested_resolution(spark):
    df = spark.createDataFrame([(None, [0.0, 5.0], 3.0)], "top double, lots array<double>, step double")
    assert df.select(resolve.first_positive_amount(F.col("top"), F.col("lots"), F.col("step"))).first()[0] == 5.0
    slots = resolve.vehicle_slots([(F.lit("low"), F.lit(None).cast("int")), (F.lit(""), F.lit(2)), (F.lit("tank"), F.lit(1))], F.lit(9))
    assert [tuple(x) for x in df.select(slots).first()[0]] == [("low", 9)]


def test_token_overlap_counts_frequent_tokens(spark):
    items = spark.createDataFrame([(1, "alpha bravo charlie delta"), (2, "alpha bravo charlie other")], "item int, text string")
    turns = spark.createDataFrame([(k, f"alpha bravo charlie delta word{k}") for k in range(500)] + [(500, "alpha bravo charlie")], "turn int, text string")
    got = {(r.item, r.turn, r.shared) for r in linkage.token_overlap(items, turns, "item", "turn", "text", "text", 4, 4).collect()}
    assert got == {(1, k, 4) for k in range(500)}


def test_token_overlap_query_has_no_cap(spark, tmp_path):
    spark.createDataFrame([(1, "alpha bravo charlie delta")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 0, "alpha bravo charlie delta") for k in range(500)], "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert tables.token_overlap_join(spark, str(tmp_path)).count() == 500


def test_scored_candidates_equal_all_pairs_with_nulls(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(k, (None, "x", "y", "")[k % 4], None if k % 5 == 0 else day + datetime.timedelta(days=(k * 37) % 200), [f"a{k % 3}", f"a{k % 7}"], None if k % 11 == 0 else [f"c{k % 4}"]) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, b string, d date, words array<string>, codes array<string>")
    other = df.withColumnsRenamed({"id": "other", "d": "e"})
    pairs = linkage.shared_counts(df, other, ["words", "codes"], "b", "id", "other", "d", "e", 20)
    got = sorted((r.id, r.rank, r.other, r.score) for r in linkage.scored_candidates(pairs, {"words": 1.0, "codes": 0.7}, "id", "other", 5).collect())
    want = []
    for x in rows:
        met = [y for y in rows if y[0] != x[0] and (not x[1] or not y[1] or x[1] == y[1]) and (not x[2] or not y[2] or abs((x[2] - y[2]).days) <= 20)]
        scores = [(round(len(set(x[3]) & set(y[3])) * 1.0 + len(set(x[4] or ()) & set(y[4] or ())) * 0.7, 6), y[0]) for y in met]
        best = sorted((-s, i) for s, i in scores if s > 0)[:5]
        want += [(x[0], k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert got == sorted(want) and any(not x[1] for x in rows for g in got if g[0] == x[0]) and any(x[2] is None for x in rows for g in got if g[0] == x[0])


def test_words_are_taken_once_a_part_and_sets_made_after_the_shuffle(spark):
    for query in (tables.award_candidates, tables.award_best_match):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.index("[l_partkey#") < plan.index("regexp_extract_all(lower(p_name")
        lines = plan.split("\n")
        partial = [k for k, line in enumerate(lines) if "partial_collect_set" in line]
        assert partial and all("Exchange hashpartitioning(o_orderkey" in lines[k + 1] for k in partial)


def test_shared_counts_equal_all_pairs_at_the_edges_of_buckets(spark):
    day = datetime.date(1970, 1, 1)
    rows = [(k, ("x", "y")[k % 2], day + datetime.timedelta(days=k // 2 - 40), ["a", "a", f"a{k % 3}"]) for k in range(160)]
    df = spark.createDataFrame(rows, "id int, b string, d date, words array<string>")
    other = df.withColumnsRenamed({"id": "other", "d": "e"})
    for most in (0, 1, 5):
        got = sorted(map(tuple, linkage.shared_counts(df, other, ["words"], "b", "id", "other", "d", "e", most).collect()))
        assert got == [(x[0], y[0], len(set(x[3]) & set(y[3]))) for x in rows for y in rows if x[0] != y[0] and x[1] == y[1] and abs((x[2] - y[2]).days) <= most]


def test_rows_with_block_and_date_meet_once_a_pair(spark, tmp_path):
    """Not once an element that they share: what runs has one join of the rows, and no row is made of each element."""
    words = [f"w{k}" for k in range(50)]
    spark.createDataFrame([(k, "x", datetime.date(2024, 1, 1 + k), words) for k in range(20)], "id int, b string, d date, words array<string>").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    pairs = linkage.shared_counts(df, df.withColumnsRenamed({"id": "other", "d": "e"}), ["words"], "b", "id", "other", "d", "e", 365)
    assert {(r.id, r.other, r.words) for r in pairs.collect()} == {(x, y, 50) for x in range(20) for y in range(20) if x != y}
    ran = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert ran.count("Join ") == 1 and "_held" not in ran


AMOUNTS = [("1.234", 1.234), ("1,2345", 12345.0), ("1,234", 1234.0), ("1,23", 1.23), ("1.234.567", 1234567.0), ("1.234,5", 1234.5), ("1,234.5", 1234.5), ("123 293,66", 123293.66), ("1.2.3", None), ("", None), ("x", None), (None, None)]


def test_amounts_by_separators(spark):
    from noticelake.functions import extract

    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(AMOUNTS)], "k int, t string")
    got = {r.k: r.v for r in df.select("k", extract.amount(F.col("t")).alias("v")).collect()}
    assert [got[k] for k in range(len(AMOUNTS))] == [v for _, v in AMOUNTS]


def test_merging_fills_the_last_row_of_a_key_once(spark):
    from noticelake.operators import merge

    base = spark.createDataFrame([("b1", "k", None, None, 1), ("b2", "k", None, 5, 2), ("b3", "q", 1, None, 3)], "id string, k string, v int, w int, o int")
    other = spark.createDataFrame([("n1", "k", None, 7, 1), ("n2", "k", 9, 8, 2), ("b3", "k", 4, 4, 3), ("n3", "z", 3, 3, 4), ("n3", "z", 2, 2, 5), (None, "y", 1, 1, 6)], base.schema)
    got = sorted((tuple(r) for r in merge.merge_sources(base, other, "id", "k", "o", ["v", "w"]).collect()), key=str)
    assert got == sorted([("b1", "k", None, None, 1, "kept"), ("b2", "k", 9, 5, 2, "enriched"), ("b3", "q", 1, None, 3, "kept"), ("n3", "z", 3, 3, 4, "appended"), (None, "y", 1, 1, 6, "appended")], key=str)


def test_listing_falls_back_only_where_nothing_passes_both(spark):
    from noticelake.operators import rules

    df = spark.createDataFrame([(1, "a", True, True), (2, "a", True, False), (3, "b", True, False), (4, "b", False, True), (5, None, True, None)], "id int, s string, x boolean, y boolean")
    assert {r.id for r in rules.listing_with_fallback(df, "s", F.col("x"), F.col("y")).collect()} == {1, 3, 5}
