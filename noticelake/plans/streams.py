"""Queries that need state, custom functions or recorded sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import annotate
from ..session import shared_folder
from ..streaming import state
from .tables import RATES, query, read


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_deduplicated(spark, sf_dir):
    """Events as a stream, one a user and type within 48 hours of event time; all of one batch here."""
    stream = state.late_deduplicated(state.file_stream(spark, sf_dir, "events.parquet"), "ts", ["user_id", "event_type"]).select("user_id", "event_type")
    return state.run_to_end(stream, shared_folder(spark, "stream"), shared_folder(spark, "stream-state"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 48 HOUR FROM events) GROUP BY 1, 2")
def stream_daily_counts(spark, sf_dir):
    """Counts of closed days: those that the watermark has passed."""
    counts = state.windowed_counts(state.file_stream(spark, sf_dir, "events.parquet"), "ts", "event_type")
    out = state.run_to_end(counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), shared_folder(spark, "stream"), shared_folder(spark, "stream-state"))
    return out


@query("SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY 1")
def stream_first_seen(spark, sf_dir):
    seen = state.first_seen_stream(state.file_stream(spark, sf_dir, "events.parquet"), "user_id", "ts")
    out = state.run_to_end(seen, shared_folder(spark, "stream"), shared_folder(spark, "stream-state"), "update")
    return out.groupBy("user_id").agg(F.date_format(F.min("first_seen"), "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


_FX_EUR = " ".join(f"WHEN {k} THEN {RATES[c]}" for k, c in enumerate(("PLN", "USD", "CZK")))


@query(f"""WITH e AS (SELECT o_orderkey, printf('%.2f', o_totalprice) AS plain, o_totalprice * CASE o_orderkey % 5 {_FX_EUR} END AS eur, o_orderkey % 5 AS k, CASE WHEN o_totalprice >= 1000 THEN printf('%d', CAST(floor(o_totalprice / 1000) AS BIGINT)) || ' ' || right('00' || printf('%.2f', o_totalprice - floor(o_totalprice / 1000) * 1000), 6) ELSE printf('%.2f', o_totalprice) END AS spaced FROM orders)
 SELECT o_orderkey, CASE k WHEN 0 THEN 'Value ' || spaced || 'pln' || note || ' net' WHEN 1 THEN 'Value ' || spaced || ' USD' || note || ' net' WHEN 2 THEN 'Value ' || spaced || ' Czk' || note || ' (~€1) net' WHEN 3 THEN 'Value ' || spaced || ' EUR net' ELSE 'x' || spaced || ' USDT net' END AS text
 FROM (SELECT *, CASE WHEN k < 2 THEN ' (~€' || CASE WHEN eur >= 1e6 THEN printf('%.1fM', eur / 1e6) WHEN eur >= 1e3 THEN printf('%.1fK', eur / 1e3) ELSE printf('%.0f', eur) END || ')' ELSE '' END AS note FROM e)""")
def annotate_fx_text(spark, sf_dir):
    """Prices with blanks between thousands in currencies of any case; noted ones, euros and longer words stay."""
    o = read(spark, sf_dir, "orders")
    n = F.translate(F.format_number("o_totalprice", 2), ",", " ")
    forms = (("Value ", "pln net"), ("Value ", " USD net"), ("Value ", " Czk (~€1) net"), ("Value ", " EUR net"), ("x", " USDT net"))
    text = F.element_at(F.array(*(F.concat(F.lit(a), n, F.lit(b)) for a, b in forms)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return o.select("o_orderkey", annotate.annotate_amounts(text, RATES).alias("text"))


@query("SELECT event_id, props ->> '$.k' AS text FROM events")
def deep_text(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", annotate.deep_text(F.col("props")).alias("text"))


@query()
def html_dom_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", annotate.dom_text(F.col("html")).alias("text"))
