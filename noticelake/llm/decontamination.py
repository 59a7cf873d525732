"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Normalising lower-cases A-Z and makes every run of other ASCII than letters and
digits one space. A window is ``width`` consecutive words of an item (a shorter
item is one window). The automaton holds every distinct window between spaces
and reads each whole text once; the words of a match are mapped back to the
original text's offsets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_by_worker, pieces, slim, table, written

WIDTH = 13
#: Text of benchmark items that one automaton takes; a larger benchmark is read in blocks of about this size.
#: A character is in up to 13 windows of some 50 bytes a node, so a block takes some 600 MB of a worker at most.
BLOCK_BYTES = 1 << 20

_TO_SPACE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_LOWER = {k: k + 32 for k in range(65, 91)}  # keeps every offset
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normalised(text: str | None) -> str:
    """Words between single spaces, a character a UTF-8 byte; "" without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split(b" ") if text else []
    words = [w for w in words if w]
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else ""


def item_windows(text: str | None, width: int = WIDTH) -> set[str]:
    words = normalised(text).split(" ")[1:-1]
    return {" " + " ".join(words[k : k + width]) + " " for k in range(max(1, len(words) - width + 1))} if words else set()


@dataclass(frozen=True)
class Hits:
    n_words: int
    words: list[tuple[int, int]]  # half-open, merged
    items: list[str]
    spans: list[tuple[int, int]]  # code points of the original text, end exclusive


class Windows:
    """The automaton; ``items`` are (item id as text, text) pairs. An item without an id is never named, but its windows hit."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WIDTH):
        owners: dict[str, set[str]] = {}
        for item, text in items:
            for window in item_windows(text, width):
                owners.setdefault(window, set()).update(() if item is None else (item,))
        self.automaton = ahocorasick.Automaton()
        for window, who in owners.items():
            self.automaton.add_word(window, (len(window), window.count(" ") - 1, tuple(sorted(who))))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def find(self, text: str | None) -> Hits:
        norm = normalised(text)
        n_words = max(0, norm.count(" ") - 1)
        found, items, at, first = [], set(), 0, 0
        if norm and not self.empty:
            for end, (length, words, who) in self.automaton.iter(norm):
                start = end - length + 1
                if start >= at:  # word number of start, counted on from the last one
                    first += norm.count(" ", at, start)
                else:
                    first -= norm.count(" ", start, at)
                at = start
                found.append((first, first + words))
                items.update(who)
        merged: list[list[int]] = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        spans = []
        if merged:
            places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
            spans = [(places[a][0], places[b - 1][1]) for a, b in merged]
        return Hits(n_words, [(a, b) for a, b in merged], sorted(items), spans)


@kept_by_worker()
def _windows(sent, width: int) -> Windows:
    """One for each worker and block, kept from task to task."""
    return Windows(sent.value, width)


_OUT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
_OUT_SQL = "row long, doc_id long, n_words long, hits array<array<long>>, items array<string>"


def _scan(docs: DataFrame, items: list[tuple[str | None, str | None]], width: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(sent, width)
        for batch in pieces(batches):
            found = [windows.find(t) for t in batch.column("text").to_pylist()]
            made = [h.n_words for h in found], [[[*words, *span] for words, span in zip(h.words, h.spans, strict=True)] for h in found], [h.items for h in found]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(made, list(_OUT)[2:], strict=True))], schema=_OUT)

    return docs.mapInArrow(run, _OUT_SQL)


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` for every row of ``docs``.

    ``spans`` are code points of the original text (end exclusive) that windows
    cover, ``items`` the ids of items with an occurring window, sorted as
    strings. Null and empty texts have no words. Items without words match
    nothing; equal items are all named, and one with a null id is not named but
    hits. Repeated rows and rows with null ids give a row each; other columns
    are not read; an empty table of documents or items gives no rows or no hits.
    One automaton holds the whole benchmark while its texts have at most
    ``block_bytes`` bytes, which bounds the broadcast and the automaton; a larger
    one is cut into blocks of items. Then every row gets a key and is written
    once with its text, the blocks are scanned in turn, and what they find is
    put together by the key, so the rows are the same for any number of blocks.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = slim(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    if blocks == 1:
        found = _scan(rows, [(r.item, r.text) for r in items.collect()], width)
    else:
        rows, found = written(rows, "keyed"), None
        for k in range(blocks):
            block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
            part = _scan(rows, [(r.item, r.text) for r in block.collect()], width)
            if k:  # only what is found, the rows are there from the first block
                part = part.where(F.size("hits") > 0)
            part = written(part, "block")
            found = part if found is None else found.unionByName(part)
        found = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), _joined(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", F.transform("hits", lambda x: F.slice(x, 3, 2)).alias("spans"))


def _joined(hits: Column) -> Column:
    """Hits ``[first word, end word, start, end]`` of several blocks in order, those whose words overlap or touch made one."""

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        one = F.array(last[0], F.greatest(last[1], x[1]), last[2], F.greatest(last[3], x[3]))
        return F.when((F.size(done) > 0) & (x[0] <= last[1]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(one))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(hits), F.array().cast("array<array<long>>"), step)


def is_contaminated(n_hit, n_words, one_in: int = 20):
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))
