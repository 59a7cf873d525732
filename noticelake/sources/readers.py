"""Sources: JSON, CSV, XML and the union of searches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_folder(spark: SparkSession, path: str, schema: T.StructType, failed_flag: str = "_fetch_failed") -> DataFrame:
    """One JSON object a file; broken files and those marked as failed are left out. Adds ``_file``."""
    full = T.StructType([f for f in schema.fields if f.name not in (failed_flag, "_corrupt")] + [T.StructField(failed_flag, T.BooleanType()), T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"))
    return rows.where(F.col("_corrupt").isNull() & ~F.coalesce(F.col(failed_flag), F.lit(False))).drop("_corrupt", failed_flag)


def aliased(df: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns under one name whatever a year's file calls them; null where none of the names is there."""
    def pick(options: Sequence[str]) -> Column:
        there = [F.col(f"`{o}`") for o in options if o in df.columns]
        return F.coalesce(*there) if there else F.lit(None).cast("string")

    return df.select(*(pick(options).alias(name) for name, options in names.items()))


def yearly_csv(spark: SparkSession, paths: Mapping[int, str], names: Mapping[str, Sequence[str]], since: int | None = None, until: int | None = None) -> DataFrame:
    """The files of the wanted years under common column names, with ``year``."""
    out = None
    for year in sorted(y for y in paths if (since is None or y >= since) and (until is None or y <= until)):
        part = aliased(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths[year]), names).withColumn("year", F.lit(year))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no file of the wanted years")
    return out


def clean_csv(spark: SparkSession, path: str, date: str, key: str, version: str) -> DataFrame:
    """Rows with a valid date, the highest version of each key; a byte-order mark is no part of the first name."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows.toDF(*(c.lstrip("﻿") for c in rows.columns))
    rows = rows.where(F.col(date).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"))
    rank = F.struct(F.coalesce(F.col(version).try_cast("int"), F.lit(-1)).alias("v"), F.struct(*rows.columns).alias("row"))
    return rows.groupBy(key).agg(F.max(rank).alias("m")).select("m.row.*")


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """``title, link, description, guid, published`` of RSS files, descriptions without their tags."""
    schema = "title string, link string, description string, guid string, pubDate string"
    items = spark.read.option("rowTag", "item").schema(schema).xml(path)
    return items.select("title", "link", F.trim(F.regexp_replace("description", "<[^>]*>", " ")).alias("description"), "guid", F.try_to_timestamp(F.regexp_replace("pubDate", "^[A-Za-z]+, *", ""), F.lit("d MMM yyyy HH:mm:ss Z")).alias("published"))


def xml_path(xml: Column, *names: str) -> Column:
    """Text at a path of element names, whatever their namespaces; null where there is none."""
    return F.nullif(F.xpath_string(xml, F.lit("//" + "/".join(f"*[local-name()='{n}']" for n in names))), F.lit(""))


def month_windows(since: Column, until: Column) -> Column:
    """First and last day of each month that the two days touch, cut to them."""
    months = F.sequence(F.trunc(since, "month"), until, F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.struct(F.greatest(m, since).alias("first"), F.least(F.last_day(m), until).alias("last")))


def union_of_searches(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Several searches as one table: of rows with the same key that of the first search stays."""
    out = None
    for k, f in enumerate(frames):
        part = f.withColumn("_search", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    names = [c for c in out.columns if c != "_search"]
    return out.groupBy(key).agg(F.min_by(F.struct(*names), F.struct("_search", *(c for c in names if c != key))).alias("_row")).select("_row.*")
