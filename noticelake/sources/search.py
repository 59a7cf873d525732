"""Paged searches recorded on disk, as a batch source with pushed conditions and as a stream that goes on where it was.

A search is a folder of ``page-*.json`` files, each with a list under ``results``.
``pages.json`` beside them may say for each page the least and greatest value of one
field, ``{"by": "date", "pages": {"page-1.json": ["2024-01-01", "2024-01-09"]}}``; pages
that no wanted row can be on are then not read. Folders may be in any store that
Arrow's file systems know; their paths are the same for driver and executors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringContains, StringStartsWith

# What each pushed condition means for a value that isn't null.
TESTS = {
    EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
    IsNotNull: lambda x, v: True, In: lambda x, v: x in v, StringContains: lambda x, v: v in x, StringStartsWith: lambda x, v: x.startswith(v),
}


def _store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


def _json(path: str) -> dict:
    store, at = _store(path)
    with store.open_input_stream(at) as f:
        return json.loads(f.read())


def _pages(path: str) -> list[str]:
    store, at = _store(path)
    there = (i.base_name for i in store.get_file_info(arrow_fs.FileSelector(at)))
    return sorted((p for p in there if p.startswith("page-")), key=lambda p: (len(p), p))


class _Pages(InputPartition):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names


class RecordedSearch(DataSource):
    """One recorded search. Options: ``path``, ``schema``; ``any_of`` and ``all_of``, terms between ``|``
    that must be in the fields of ``text`` (between commas), case ignored; ``limit`` of rows.

    Conditions on columns are pushed by Spark: equality, ranges, lists, parts and
    beginnings of texts. With a limit the pages are read in turn by one task, which
    stops at the last row wanted; else a page is a partition.
    Load it anew for each search: Spark keeps pushed filters with the loaded table.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded_search"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SearchReader(dict(self.options), [f.name for f in schema.fields])


class _SearchReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.names, self.pushed = options["path"], names, []
        terms = lambda k: [t.lower() for t in options.get(k, "").split("|") if t]
        self.any_of, self.all_of, self.text = terms("any_of"), terms("all_of"), [t for t in options.get("text", "").split(",") if t]
        self.limit = int(options["limit"]) if "limit" in options else None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if type(f) in TESTS and len(f.attribute) == 1:
                self.pushed.append((f.attribute[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        there = _pages(self.path)
        store, at = _store(f"{self.path}/pages.json")
        if store.get_file_info(at).type == arrow_fs.FileType.File:
            known = _json(f"{self.path}/pages.json")
            there = [p for p in there if self._may_hold(known["by"], known["pages"].get(p))]
        return [_Pages(self.path, there)] if self.limit is not None else [_Pages(self.path, [p]) for p in there]

    def _may_hold(self, by: str, span: list | None) -> bool:
        for name, kind, v in self.pushed if span else ():
            if name == by:
                least, most = span
                if (kind in (GreaterThan, GreaterThanOrEqual) and not TESTS[kind](most, v)) or (kind in (LessThan, LessThanOrEqual) and not TESTS[kind](least, v)):
                    return False
                if (kind is EqualTo and not least <= v <= most) or (kind is In and not any(least <= x <= most for x in v)):
                    return False
        return True

    def _fits(self, row: dict) -> bool:
        if any(row.get(name) is None or not TESTS[kind](row[name], v) for name, kind, v in self.pushed):
            return False
        text = " ".join(str(row.get(c) or "") for c in self.text).lower()
        return all(t in text for t in self.all_of) and (not self.any_of or any(t in text for t in self.any_of))

    def read(self, partition: _Pages) -> Iterator[tuple]:
        left = self.limit
        for page in partition.names:
            if left == 0:
                return
            for row in _json(f"{partition.path}/{page}").get("results", []):
                if left != 0 and self._fits(row):
                    left = left - 1 if left is not None else None
                    yield tuple(row.get(n) for n in self.names)


def search(spark: SparkSession, path: str, schema: str, text: Sequence[str] = (), any_of: Sequence[str] = (), all_of: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """A recorded search; further conditions are pushed from ``where``. ``limit`` counts rows that the terms let pass."""
    spark.dataSource.register(RecordedSearch)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    found = spark.read.format("recorded_search").option("path", path).option("schema", schema).option("text", ",".join(text)).option("any_of", "|".join(any_of)).option("all_of", "|".join(all_of))
    return (found if limit is None else found.option("limit", limit)).load()


class SearchStream(DataSource):
    """Several recorded searches as one stream. Options: ``paths`` between ``|``, ``schema``; adds ``search``, the path.

    The offset holds for each search how many of its pages were read, so a stopped
    query goes on with each search where that one was. Pages are never changed.
    """

    @classmethod
    def name(cls) -> str:
        return "search_stream"

    def schema(self) -> str:
        return self.options["schema"] + ", search string"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _SearchStreamReader(self.options["paths"].split("|"), [f.name for f in schema.fields][:-1])


class _SearchStreamReader(DataSourceStreamReader):
    def __init__(self, paths: list[str], names: list[str]):
        self.paths, self.names = paths, names

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.paths, 0)

    def latestOffset(self) -> dict:
        return {p: len(_pages(p)) for p in self.paths}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Pages(p, [page]) for p in self.paths for page in _pages(p)[start.get(p, 0) : end.get(p, 0)]]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        for page in partition.names:
            for row in _json(f"{partition.path}/{page}").get("results", []):
                yield (*(row.get(n) for n in self.names), partition.path)


def search_stream(spark: SparkSession, paths: Sequence[str], schema: str, key: str | None = None) -> DataFrame:
    """The searches' rows as a stream; with ``key`` the first row of each key among all searches, kept as state."""
    spark.dataSource.register(SearchStream)
    rows = spark.readStream.format("search_stream").option("paths", "|".join(paths)).option("schema", schema).load()
    return rows.dropDuplicates([key]) if key else rows


def searches_of(spark: SparkSession, table: DataFrame, root: str, schema: str, text: Sequence[str]) -> DataFrame:
    """All searches of a table (``name, any_of array, all_of array, since, until, date``) over folders named as they are, with ``search``.

    A search is a row of a configuration, some dozens at most: the driver makes a
    plan of each. A null bound is none.
    """
    out = None
    for s in table.orderBy("name").limit(10_000).collect():
        part = search(spark, f"{root}/{s.name}", schema, text, s.any_of or (), s.all_of or ())
        part = part.where(F.col(s.date) >= s.since) if s.since is not None else part
        part = (part.where(F.col(s.date) <= s.until) if s.until is not None else part).withColumn("search", F.lit(s.name))
        out = part if out is None else out.unionByName(part)
    return out
