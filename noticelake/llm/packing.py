"""Best-fit-decreasing packing of documents into sequences of at most ``capacity`` tokens.

Best-fit decreasing takes the longest pieces first and puts each into the open
bin with the least room that holds it. Pieces of one length are alike, and so
are bins with the same room. So the whole corpus is packed from its histogram of
lengths alone: a segment tree over the possible rooms finds the tightest room
with an open bin in logarithmic time, and as many pieces as there are such bins
go there in one step. The plan says, for a length, which ranks go to which bins;
pieces are ranked within their length by Spark and look their bin up. Work and
memory of the plan depend on ``capacity``, not on the number of documents.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_by_worker, ranked_within, slim, table, written

CAPACITY = 4096
END_ID = 1
_MOST_WORDS = 400_000  # that a worker keeps, and texts that it takes at once
_TOGETHER = 100


class RoomTree:
    """A segment tree over rooms 0..capacity that counts open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, room: int, bins: int) -> None:
        k = room + self.size
        while k:
            self.counts[k] += bins
            k >>= 1

    def tightest(self, least: int) -> int:
        """The smallest room of at least ``least`` that an open bin has, or -1."""
        k = least + self.size
        if self.counts[k]:
            return least
        while k > 1:
            if not k & 1 and self.counts[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.counts[2 * k] else 2 * k + 1
                return k - self.size
            k >>= 1
        return -1


@dataclass(frozen=True)
class Plan:
    """Pieces of ``length`` with ranks from ``rank`` on go to the bins from ``bin`` on.

    Each bin takes ``per_bin`` of them, one after another from ``offset`` on.
    Rows are in order of length and rank.
    """

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    per_bin: np.ndarray
    bins: int


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing over ``{length: pieces}``; lengths are 1..capacity.

    Of several bins with the tightest room, those opened or filled last are
    taken; new bins take as many pieces of one length as fit, as best fit
    would: a bin just opened is tighter than a new one.
    """
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError("lengths must be from 1 to the capacity")
    tree, open_bins = RoomTree(capacity), {}  # room -> stack of [first bin, bins]
    rows: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put_back(room: int, first: int, n: int) -> None:
        if room:
            tree.add(room, n)
            open_bins.setdefault(room, []).append([first, n])

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room < 0:
                fit = capacity // length
                full, rest = divmod(left, fit)
                for n, each in ((full, fit), (1 if rest else 0, rest)):
                    if n:
                        rows.append((length, rank, bins, 0, each))
                        put_back(capacity - each * length, bins, n)
                        bins, rank, left = bins + n, rank + n * each, left - n * each
                continue
            # Best fit fills the tightest bin again and again while the next piece fits: its room only falls.
            fit = room // length
            first, have = open_bins[room].pop()
            use = min(have, left // fit)
            each = fit
            if not use:
                use, each = 1, left
            if use < have:
                open_bins[room].append([first + use, have - use])
            tree.add(room, -use)
            rows.append((length, rank, first, capacity - room, each))
            put_back(room - each * length, first, use)
            rank, left = rank + use * each, left - use * each
    table_ = np.array(rows, np.int64).reshape(-1, 5)
    order = np.lexsort((table_[:, 1], table_[:, 0]))
    return Plan(*(table_[order, k] for k in range(5)), bins)


class WordTokenizer:
    """Ids of the public word vocabulary, with the ids of each word remembered.

    In texts below U+0250 the vocabulary's normaliser only lower-cases and its
    splitting is one pattern, so a text's ids are its words' ids in order. Any
    other text goes through the tokenizer whole.
    """

    _WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\t-\r \x85\xa0]|_)+")
    _SIMPLE = re.compile(r"[\x00-ɏ]*")

    def __init__(self, path: str | None = None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.words: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True

    def _learn(self, words: list[str], together: int = 64) -> None:
        """Encodes words many to a text: blanks keep them apart, and each ends with the one id that ends a word."""
        texts = [" ".join(words[k : k + together]) for k in range(0, len(words), together)]
        for k, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            part, ids = words[k * together : (k + 1) * together], np.array(e.ids, "<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(ends) != len(part):
                self.words.update((w, self._whole(w)) for w in part)
                continue
            data = ids.tobytes()
            self.words.update(zip(part, (data[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    @classmethod
    def _simple(cls, text: str) -> bool:
        if "<|" in text:
            return False
        try:
            text.encode("latin-1")
            return True
        except UnicodeEncodeError:
            return bool(cls._SIMPLE.fullmatch(text))

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of some texts; words not met before are encoded together."""
        found = [self._WORDS.findall(t.lower()) if t and self._simple(t) else None for t in texts]
        new = set().union(*(w for w in found if w)).difference(self.words)
        if len(self.words) + len(new) > _MOST_WORDS:
            self.words.clear()
            new = set().union(*(w for w in found if w))
        self._learn(list(new))
        get = self.words.__getitem__
        return [b"".join(map(get, w)) if w is not None else self._whole(t) if t else b"" for t, w in zip(texts, found, strict=True)]


@kept_by_worker()
def word_tokenizer(path: str | None) -> WordTokenizer:
    """One for each worker: the vocabulary is read once and words are kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordTokenizer(path)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: a document's ids with ``end_id`` after them, cut only where longer than ``capacity``.

    A null or empty text is the end id alone.
    """
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, step = word_tokenizer(vocabulary), 4 * capacity
        for batch in batches:
            cols: dict[str, list] = {f.name: [] for f in _PIECES}
            docs_, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for first in range(0, len(docs_), _TOGETHER):
                for doc, ids in zip(docs_[first : first + _TOGETHER], tokenizer.ids_of(texts.slice(first, _TOGETHER).to_pylist()), strict=True):
                    ids += last
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        for name, value in zip(cols, (doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            cols[name].append(value)
            yield pa.RecordBatch.from_pydict(cols, schema=_PIECES)

    return slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id, piece, length`` (and other columns).

    The histogram has at most ``capacity`` lengths and is all that the driver
    gets; the plan that is broadcast has a size bound by ``capacity`` alone. No
    rows give no sequences.
    """
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)
    sent = pieces.sparkSession.sparkContext.broadcast(plan)
    ranked = ranked_within(pieces, "length", ["doc_id", "piece"])
    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        key = p.length << 40 | p.rank
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length << 40 | rank, side="right") - 1
            at, place = np.divmod(rank - p.rank[k], p.per_bin[k])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(p.bin[k] + at), pa.array(p.offset[k] + place * length)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, a row a piece."""
    return pack_pieces(written(tokenized_pieces(docs, capacity, vocabulary, END_ID, id_col, text_col), "pieces"), capacity)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
