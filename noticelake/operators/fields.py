"""Fields of notices by a table of rules: one join on the language, the first valid rule of each field."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.field_rules import RULES, STATUS

FIELDS = ("title", "authority", "date", "reference", "description", "quantity", "value", "winner", "status", "code", "duration", "deadline")
_COLUMNS = "language string, field string, convert string, pattern string, least double, most double, cut int"


def rule_table(spark: SparkSession, rules: Sequence[tuple] = RULES, names: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The rules as rows with ``place``, their order within language and field.

    ``names`` by language are authorities that are looked for in the text itself
    where no other rule of the authority gives one.
    """
    more = [(language, "authority", "listed", name, None, None, None) for language, known in (names or {}).items() for name in known]
    places: dict[tuple[str, str], int] = {}
    rows = []
    for language, field, convert, pattern, least, most, cut in (*rules, *more):
        place = places[language, field] = places.get((language, field), 0) + 1
        rows.append((language, field, convert, pattern, None if least is None else float(least), None if most is None else float(most), cut, place))
    return spark.createDataFrame(rows, _COLUMNS + ", place int")


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _number(text: Column) -> Column:
    """A plain decimal number with white space around it; null for anything else."""
    t = _stripped(text)
    return F.when(t.rlike(r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"), t.try_cast("double"))


def _ymd(text: Column) -> Column:
    parts = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    return F.concat_ws("-", F.get(parts, F.lit(2)), F.lpad(F.get(parts, F.lit(1)), 2, "0"), F.lpad(F.get(parts, F.lit(0)), 2, "0"))


def _first_lines(text: Column, strip: bool) -> Column:
    lines = F.filter(F.split(_stripped(text), "\n"), lambda x: _stripped(x) != "")
    return F.array_join(F.slice(F.transform(lines, _stripped) if strip else lines, 1, 3), " ")


def _json_number(text: Column, path: Column) -> Column:
    """A scalar at the path, or what ``MONTANT`` or ``val`` hold below it; digits and a decimal point only."""
    tries = (F.call_function("get_json_object", text, F.concat(path, F.lit(tail))) for tail in (".MONTANT", ".val", ""))
    plain = (F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit(","), F.lit(".")) for t in tries)
    return F.coalesce(*(F.when(p.rlike("^[0-9.]+$"), _number(p)) for p in plain))


def converted(text: Column, rule: Column) -> Column:
    """A rule's value in a text, as text; null where the pattern is absent or its match is no valid value."""
    flags = F.when(rule["field"] == "description", "(?diuUs)").otherwise("(?diuU)")
    patterned = ~rule["convert"].isin("listed", "json")
    raw = F.when(patterned, F.nullif(F.call_function("regexp_extract", text, F.when(patterned, F.concat(flags, rule["pattern"])).otherwise("()"), F.lit(1)), F.lit("")))
    return F.transform(F.array(raw), lambda found: _value(text, found, rule))[0]  # as a lambda's variable the match is searched once


def _value(text: Column, raw: Column, rule: Column) -> Column:
    kind, cut = rule["convert"], F.coalesce(rule["cut"], F.lit(1_000_000))
    less = lambda c, *gone: less(F.replace(c, F.lit(gone[0]), F.lit("")), *gone[1:]) if gone else c
    decimal = lambda c: F.replace(c, F.lit(","), F.lit("."))
    in_range = lambda n: F.when((n >= F.coalesce(rule["least"], n)) & (n <= F.coalesce(rule["most"], n)), n)
    over = lambda n: F.when(n > F.coalesce(rule["least"], n - 1), n)
    whole = lambda c: F.when(_stripped(c).rlike("^[0-9]{1,18}$"), _stripped(c).try_cast("long"))
    bare = less(_stripped(raw), " ")
    mixed = F.when(bare.contains(",") & ~bare.contains("."), decimal(bare)).otherwise(F.regexp_replace(bare, r"\.(?=.*\.)", ""))
    stripped = F.left(_stripped(raw), cut)
    status = F.coalesce(*(F.when(F.lower(raw).contains(word), meaning) for word, meaning in STATUS.items()))
    text_of = {
        "text": stripped,
        "name": F.when(~_stripped(raw).rlike(r"(?U)^[\d\s,.+€]+$"), stripped),
        "lines": F.left(_first_lines(raw, True), cut),
        "block": F.left(_first_lines(raw, False), cut),
        "dmy": _ymd(raw),
        "date": F.left(raw, F.lit(10)),
        "count": in_range(whole(less(raw, " "))).cast("string"),
        "dotted": in_range(whole(less(raw, "."))).cast("string"),
        "dots": over(_number(decimal(less(raw, ".")))).cast("string"),
        "blanks": over(_number(decimal(less(raw, " ")))).cast("string"),
        "commas": over(_number(less(bare, ","))).cast("string"),
        "mixed": over(_number(mixed)).cast("string"),
        "status": status,
        "listed": F.when(F.contains(F.lower(text), F.lower(rule["pattern"])), rule["pattern"]),
        "json": _json_number(text, rule["pattern"]).cast("string"),
    }
    out = F.lit(None).cast("string")
    for name, value in text_of.items():
        out = F.when(kind == name, value).otherwise(out)
    return F.nullif(out, F.lit(""))


def extracted_fields(df: DataFrame, rules: DataFrame, text: Column, language: Column, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Adds a struct ``value, rule`` for each field: the first valid rule's value as text, and ``language:field:place``.

    The rules of a language and of these fields come with one broadcast join (as
    many rows as there are languages) and run within a row, so nothing is
    shuffled; after a field's first valid rule its others are not tried. Rows of
    other languages, and null texts, have nulls.
    """
    rule = F.struct("place", "field", "convert", "pattern", "least", "most", "cut")
    wanted = rules.where(F.col("field").isin(*fields))
    by_language = wanted.groupBy(F.col("language").alias("_language")).agg(F.sort_array(F.collect_list(rule)).alias("_rules"))
    joined = df.withColumn("_text", text).join(F.broadcast(by_language), language == F.col("_language"), "left")

    def told(r: Column) -> Column:
        by = F.concat_ws(":", "_language", r["field"], r["place"].cast("string"))
        return F.transform(F.array(converted(F.col("_text"), r)), lambda value: F.when(value.isNotNull(), F.struct(value.alias("value"), by.alias("rule"))))[0]

    def first(field: str) -> Column:
        none = F.lit(None).cast("struct<value:string,rule:string>")
        return F.aggregate(F.filter("_rules", lambda r: r["field"] == field), none, lambda found, r: F.coalesce(found, told(r)))

    return joined.withColumns({f: first(f) for f in fields}).drop("_text", "_language", "_rules")
