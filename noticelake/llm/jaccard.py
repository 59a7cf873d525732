"""N-gram Jaccard join by prefix filters under several global orders.

A document is its set of distinct word shingles. Two sets with similarity t or
more share a token among the first ``n - ceil(t n) + 1`` of each, whatever
order all tokens are put in, as long as it is one order for all. The first
order puts tokens that repeat often last. Its prefixes are joined on (token,
band of lengths), where places in both sets must leave room for enough shared
tokens: the smaller set of a pair needs only its first ``n - ceil(2 t n / (1 + t)) + 1``
tokens there. The pairs must then share prefix tokens under each further
order too, and only sets of pairs that pass all are compared in full.

No group is expanded into pairs. Equal sets are one class from the start. Sets
that share first tokens under two further orders at least are compared with one
centre a token, which joins groups of near copies in linear work. After that
all sets that are still in different clusters meet, which makes the links
complete.

The exactness rests on 64-bit hashes: of shingles within a compared pair, and
of sets (a second hash tells if two different sets ever meet there).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept_by_worker, pieces, slim, table, written
from .components import connected_components

#: A-Z to lower case, white space to blanks; other bytes of UTF-8 are parts of words.
_TO_WORDS = bytes(k + 32 if 65 <= k <= 90 else 32 if 9 <= k <= 13 else k for k in range(256))
_MULTIPLIERS = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class JaccardSettings:
    """``percent`` is the similarity; ``orders`` counts the token orders, the joined one included.

    ``frequent_in_block``: a shingle in so many distinct sets of a block (sets of
    one task, ``block_tokens`` shingles at least where it has them) is counted as
    frequent; ``most_frequent`` bounds the table of frequent shingles. Both only
    change the first order, never the result. ``most_broadcast`` bounds the ids
    that are sent to all executors; more are joined by a shuffle. ``leads`` is
    the number of orders whose first tokens join near copies, ``nearest`` that of
    further centres; they only save work: all pairs of sets that are still apart
    are looked at.
    """

    width: int = 5
    percent: int = 80
    orders: int = 3
    frequent_in_block: int = 3
    block_tokens: int = 1 << 20
    most_frequent: int = 1 << 19
    most_broadcast: int = 1_000_000
    sketch_words: int = 8
    leads: int = 8
    nearest: int = 16


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A word's hash is a polynomial of random values of its bytes, modulo 2**64;
    all words of a text come from one running sum.
    """

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, width: int):
        self.width = width
        self.values = np.random.default_rng(2024).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.values[32] = 0
        self.powers = self.inverses = np.ones(1, np.uint64)
        self.weights = [np.uint64(pow(0xD6E8FEB86659FD93, k, 2**64)) for k in range(width)]

    def words(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TO_WORDS), np.uint8)
        if len(raw) >= len(self.powers):
            n = 2 * len(raw) + 1
            self.powers, self.inverses = (np.cumprod(np.array([1] + [x] * n, np.uint64)) for x in (self._BASE, pow(self._BASE, -1, 2**64)))
        inside = np.concatenate([[False], raw != 32, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[raw] * self.powers[: len(raw)])])
        return _mix((sums[ends] - sums[starts]) * self.inverses[starts])

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.words(text) if text else ()
        if not len(words):
            return np.empty(0, np.uint64)
        used = min(self.width, len(words))
        n = len(words) - used + 1
        out = np.full(n, used, np.uint64)  # a short sequence differs from a full shingle
        for k in range(used):
            out += words[k : k + n] * self.weights[k]
        return np.unique(_mix(out))


@kept_by_worker(2)
def shingler(width: int) -> Shingler:
    """One for each worker, so that its words are kept from task to task."""
    return Shingler(width)


def set_hashes(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set: its id, and one that tells if two sets ever share that."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def prefix_size(n: int, percent: int) -> int:
    """How many first tokens of a set of n hold one of any set that is similar enough."""
    return n - -(-percent * n // 100) + 1


def order_key(tokens: np.ndarray, order: int) -> np.ndarray:
    return _mix(tokens * _MULTIPLIERS[1] + np.uint64(order))


def prefix_keys(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The prefix under one of the further orders, each a permutation of all 64-bit tokens, as 32 bits of each key."""
    p, key = prefix_size(len(tokens), percent), order_key(tokens, order)
    return ((np.partition(key, p - 1)[:p] if p < len(key) else key) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def sketch(tokens: np.ndarray, words: int) -> np.ndarray:
    """The parity of the hashed tokens at each bit: bits that differ between two sets are tokens that only one has."""
    parity = np.bincount((tokens >> np.uint64(20)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view("<i8")


def wide_sketch(tokens: np.ndarray) -> np.ndarray:
    """As ``sketch``, of at least two bits a token: 64 times a power of two, so that the wider of two folds onto the other."""
    return sketch(tokens, 1 << max(0, math.ceil(len(tokens) / 32) - 1).bit_length())


def lead_keys(tokens: np.ndarray, leads: int) -> np.ndarray:
    """The first token, as its key, under each order that puts one ``leads``-th of all tokens first; no key where a set has none of those."""
    key = np.sort(order_key(tokens, 1))
    top = (key // np.uint64(-(-(2**64) // leads))).astype(np.int64)
    return key[np.flatnonzero(np.diff(top, prepend=-1))].view(np.int64)


def _lists(parts: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.empty(0, kind)]).astype(kind, copy=False)))


_SETS = pa.schema([*((c, pa.int64()) for c in ("doc_id", "key", "n", "set_id", "check")), ("bits", pa.list_(pa.int64())), ("leads", pa.list_(pa.int64())), ("token", pa.int64()), ("count", pa.int64())])
_SETS_SQL = "doc_id long, key long, n long, set_id long, check long, bits array<long>, leads array<long>, token long, count long"


def _often(distinct: dict[int, np.ndarray], least: int) -> Iterator[pa.RecordBatch]:
    """The shingles that are in ``least`` of the distinct sets or more."""
    tokens = np.sort(np.concatenate([*distinct.values(), np.empty(0, np.uint64)]))
    edge = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]])) if len(tokens) else np.zeros(1, int)
    n = np.diff(edge)
    many = n >= least
    if many.any():
        rows = int(many.sum())
        yield pa.RecordBatch.from_arrays([*(pa.nulls(rows, f.type) for f in list(_SETS)[:7]), pa.array(tokens[edge[:-1][many]].view(np.int64)), pa.array(n[many])], schema=_SETS)


def _sets_and_counts(s: JaccardSettings):
    """A row for each document, and for each block the shingles that are in many of its sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler(s.width)
        distinct: dict[int, np.ndarray] = {}
        held = 0
        for batch in pieces(batches):
            sizes, ones, twos, bits, leads = [], [], [], [], []
            made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for text in batch.column("text").to_pylist():
                tokens = shingles(text)
                one, two = set_hashes(tokens)
                if one not in made:
                    made[one] = sketch(tokens, s.sketch_words), lead_keys(tokens, s.leads)
                if one not in distinct:
                    distinct[one] = tokens
                    held += len(tokens)
                for out, value in ((sizes, len(tokens)), (ones, one), (twos, two), (bits, made[one][0]), (leads, made[one][1])):
                    out.append(value)
                if held > s.block_tokens:
                    yield from _often(distinct, s.frequent_in_block)
                    distinct, held = {}, 0
            if rows := len(sizes):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *(pa.array(c, pa.int64()) for c in (sizes, ones, twos)), _lists(bits, np.int64), _lists(leads, np.int64), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], schema=_SETS)
        yield from _often(distinct, s.frequent_in_block)

    return run


_POSTINGS = pa.schema([("token", pa.int64()), ("part", pa.int32()), ("set_id", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])


def _postings(s: JaccardSettings, sent, rows_a_part: int = 5000):
    """Prefix tokens under the first order: frequent shingles last, by how frequent, the others by a hash.

    ``part`` is 0 for a token that is not in the table of frequent ones; rows of
    one that is are dealt into parts from 1 on, so that no group is large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, (frequent, rank) = shingler(s.width), sent.value
        done: set[int] = set()
        for batch in pieces(batches):
            parts: list[tuple[np.ndarray, np.ndarray, int, int]] = []
            for text in batch.column("text").to_pylist():
                tokens = shingles(text)
                own = set_hashes(tokens)[0]
                if not len(tokens) or own in done:  # an equal set of this task has sent them
                    continue
                if len(done) < 200_000:
                    done.add(own)
                p = prefix_size(len(tokens), s.percent)
                key, often = order_key(tokens, 0) >> np.uint64(20), np.zeros(len(tokens), np.uint64)
                if len(frequent):
                    k = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                    often = np.where(frequent[k] == tokens, rank[k], np.uint64(0))
                    key |= often << np.uint64(44)
                first = np.argsort(key, kind="stable")[:p]  # equal keys stay in order of token
                often = often[first].astype(np.int64)
                parts.append((tokens[first], np.where(often > 0, 1 + own % (1 + often // rows_a_part), 0).astype(np.int32), own, len(tokens)))
            if parts:
                sizes = [len(t) for t, *_ in parts]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([t for t, *_ in parts]).view(np.int64)), pa.array(np.concatenate([d for _, d, _, _ in parts])), pa.array(np.repeat(np.array([i for _, _, i, _ in parts], np.int64), sizes)), pa.array(np.repeat(np.array([n for *_, n in parts], np.int32), sizes)), pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]))], schema=_POSTINGS)

    return run


def _least_overlap(n: Column, m: Column, percent: int) -> Column:
    return F.ceil((n + m) * percent / (100 + percent) - 1e-6)


def _bits_apart(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)


def _folded(bits: Column, size: Column) -> Column:
    """A wide sketch on ``size`` words, its own number or half of it."""
    halves = F.zip_with(F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) > size, halves).otherwise(bits)


def _verify(s: JaccardSettings):
    """Which pairs of whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            left, right = batch.column("left"), batch.column("right")
            keep = []
            for k in range(batch.num_rows):
                a, b = (c[k].values.to_numpy().view(np.uint64) for c in (left, right))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= s.percent * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"])

    return run


class _Join:
    """One run of the join over a table ``doc_id, key, text`` of documents."""

    def __init__(self, docs: DataFrame, s: JaccardSettings):
        self.docs, self.s = docs, s
        self.tokens: DataFrame | None = None
        self.wide: DataFrame | None = None
        self.spark = docs.sparkSession
        both = written(docs.mapInArrow(_sets_and_counts(s), _SETS_SQL), "sets")
        self.sets = both.where("n IS NOT NULL").select("doc_id", "n", "set_id")
        #: a row for each distinct set that is not empty; ``doc_id, key`` are those of one of its texts
        classes = both.where("n > 0").groupBy("set_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("one"), F.min("check").alias("check"), F.max("check").alias("other"), F.first("bits").alias("bits"), F.first("leads").alias("leads"), F.first("n").alias("n"))
        self.classes = written(classes.select("set_id", "one.doc_id", "one.key", "check", "other", "bits", "leads", "n"), "classes")
        if self.classes.where("check <> other").limit(1).count():
            raise RuntimeError("two different sets have the same 64-bit hash; use another hash")
        top = both.where("count IS NOT NULL").groupBy("token").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "token").limit(s.most_frequent).toArrow()
        tokens, counts = (top.column(c).to_numpy() for c in ("token", "count"))
        order = np.argsort(tokens.view(np.uint64))
        #: at most most_frequent pairs of numbers
        self.frequent = self.spark.sparkContext.broadcast((tokens.view(np.uint64)[order], np.minimum(counts, 2**20 - 1).astype(np.uint64)[order]))

    def first_pairs(self) -> DataFrame:
        """Each set with centres of its first tokens, where two orders offer the same centre.

        The first centre of a token is the set, of those that begin with it,
        whose first tokens are the most common ones. In a group of copies of one
        text those nearest to any member are those nearest to the text, so the
        nearest of each part of a centre's sets are centres too: of up to
        ``nearest`` parts, of some ``nearest`` sets where the group is small.
        A set has at most ``leads * (1 + nearest)`` of them.
        """
        leads = self.classes.select("set_id", F.explode("leads").alias("lead"))
        sizes = leads.groupBy("lead").agg(F.count("*").alias("size")).where("size > 1")
        shared = written(leads.join(sizes, "lead"), "leads")
        score = shared.groupBy("set_id").agg(F.sum("size").alias("score"))
        centres = shared.join(score, "set_id").groupBy("lead").agg(F.max(F.struct("score", "set_id"))["set_id"].alias("centre"))
        met = shared.join(centres, "lead").where("centre <> set_id").groupBy("set_id", "centre").agg(F.count("*").alias("times")).where("times > 1")
        met = written(self.measured(met.select(F.col("set_id").alias("a"), F.col("centre").alias("b"))), "centres")
        parts = met.groupBy("b").agg(F.least(F.lit(self.s.nearest), 1 + F.floor(F.count("*") / self.s.nearest)).alias("parts"))
        near = met.join(parts, "b").groupBy("b", F.pmod(F.xxhash64("a"), "parts")).agg(F.min(F.struct("apart", "a"))["a"].alias("near")).select("b", "near")
        pairs = met.select("a", "b").unionByName(met.select("a", "b").join(near, "b").select("a", F.col("near").alias("b")))
        return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def postings(self, links: DataFrame, main_rows: int = 8) -> DataFrame:
        """Prefix tokens that sets of two clusters have: ``token, set_id, n, at, cluster, main, bits_0`` and so on.

        ``main`` marks rows of the cluster with most rows of the token, where those
        are ``main_rows`` or more: true for its rows, false for others, null where
        no cluster has as many. The bits are the set's sketch.
        """
        rows = self.docs.select("text").mapInArrow(_postings(self.s, self.frequent), "token long, part int, set_id long, n int, at int")
        group = Window.partitionBy("token", "part")
        t, left, over = self.s.percent, F.col("n") - F.col("at"), lambda c: c.over(group)
        # A token is of use if one of its sets may be the smaller one of a pair, and two rows alone if they are such a pair.
        two = (over(F.min(left)) >= _least_overlap(over(F.sum("n")), F.lit(0), t)) & (over(F.min("n")) * 100 >= over(F.max("n")) * t)
        waits = over(F.max(left >= _least_overlap(F.col("n"), F.col("n"), t)))
        rows = rows.select("*", ((over(F.min("set_id")) != over(F.max("set_id"))) & waits & ((over(F.count("*")) > 2) | two)).alias("useful"))
        rows = rows.where("part > 0 OR useful").groupBy("token", "part", "set_id", "n", "at").agg(F.lit(1).alias("_")).select("token", "set_id", "n", "at")
        rows = rows.join(connected_components(links), F.col("set_id") == F.col("node"), "left").withColumn("cluster", F.coalesce("component", "set_id")).drop("node", "component")
        rows = written(rows, "postings")
        counts = rows.groupBy("token", "cluster").agg(F.count("*").alias("size"))
        tokens = counts.groupBy("token").agg(F.count("*").alias("clusters"), F.max(F.struct("size", "cluster")).alias("first")).where("clusters > 1").select("token", F.when(F.col("first.size") >= main_rows, F.col("first.cluster")).alias("first"))
        rows = rows.join(tokens, "token").withColumn("main", F.col("cluster") == F.col("first")).drop("first")
        # Sketches are eight times as wide as a row, so only rows that may meet another cluster get them.
        bits = self.classes.select("set_id", *(F.col("bits")[k].alias(f"bits_{k}") for k in range(self.s.sketch_words)))
        return written(rows.join(bits, "set_id"), "meeting")

    def far_apart(self, rows: DataFrame) -> DataFrame:
        """All pairs of sets of different clusters that share a prefix token, sizes, places and sketches allowing.

        The larger set of a pair waits at its band of lengths, the smaller one
        looks into all bands that it may find similar sets in. Two rows of a
        token's main cluster never meet.
        """
        t, of = self.s.percent, 100 + self.s.percent
        band = lambda n: F.floor(F.log(n.cast("double")) / math.log(100 / t))
        left, main, n = F.col("n") - F.col("at"), F.col("main"), F.col("n").cast("long")
        # Larger sets of the main cluster are at side 1, where only smaller ones of other clusters look.
        sides = F.when(~main, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        large = rows.where(F.floor(left * of / t + 1e-6) - n >= F.ceil(n * t / 100 - 1e-6)).withColumns({"band": band(n), "side": F.coalesce(main.cast("int"), F.lit(0))})
        most = F.least(F.floor(n * 100 / t + 1e-6), F.floor(left * of / t + 1e-6) - n)
        small = rows.withColumn("most", most).where(n <= F.col("most")).withColumn("band", F.explode(F.sequence(band(n), band(F.col("most"))))).withColumn("side", F.explode(sides)).drop("most")
        x, y = large.alias("x"), small.alias("y")
        n, m = F.col("x.n"), F.col("y.n")
        enough = F.least(n - F.col("x.at"), m - F.col("y.at")) >= _least_overlap(n, m, t)
        in_order = (n > m) | ((n == m) & (F.col("x.set_id") > F.col("y.set_id")))
        apart = reduce(add, (F.bit_count(F.col(f"x.bits_{k}").bitwiseXOR(F.col(f"y.bits_{k}"))) for k in range(self.s.sketch_words)))
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("token", "band", "side")]
        met = x.join(y, reduce(and_, same) & (F.col("x.cluster") != F.col("y.cluster")) & in_order & (m * 100 >= n * t) & enough & (apart * of <= (n + m) * (100 - t)))
        return met.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct()

    def measured(self, pairs: DataFrame) -> DataFrame:
        """``a, b`` with their sizes ``n_a, n_b`` and the bits that are ``apart``, no more than the tokens that one of them lacks."""
        for side in ("a", "b"):
            pairs = pairs.join(self.classes.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
        return pairs.select("a", "b", "n_a", "n_b", _bits_apart(F.col("bits_a"), F.col("bits_b")).alias("apart"))

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes fit and that are not too far apart: 9 * apart <= n + m at 80 percent."""
        t, n, m = self.s.percent, F.col("n_a"), F.col("n_b")
        return self.measured(pairs).where((F.least(n, m) * 100 >= F.greatest(n, m) * t) & (F.col("apart") * (100 + t) <= (n + m) * (100 - t))).select("a", "b")

    def similar(self, pairs: DataFrame) -> DataFrame:
        """The links among the pairs: wide sketches must be near, prefixes must meet under each further order, then whole sets are compared."""
        pairs = written(self.plausible(pairs), "pairs")
        close = written(self.close(pairs), "close")
        ids = self.unknown(close, self.tokens)
        new = self.token_sets(ids)
        self.tokens = new if self.tokens is None else self.tokens.unionByName(new)
        both = close
        for side in ("b", "a"):
            both = both.join(self.tokens.select(F.col("set_id").alias(side), F.col("prefixes").alias(f"prefixes_{side}")), side)
        meet = [F.arrays_overlap(F.col("prefixes_a")[k], F.col("prefixes_b")[k]) for k in range(self.s.orders - 1)]
        both = written(both.where(reduce(and_, meet, F.lit(True))).select("a", "b"), "met")
        for side, name in (("b", "right"), ("a", "left")):
            both = both.join(self.tokens.select(F.col("set_id").alias(side), F.col("tokens").alias(name)), side)
        return written(both.select("a", "b", "left", "right").mapInArrow(_verify(self.s), "a long, b long"), "links")

    def unknown(self, pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        """The sets of the pairs that ``known`` has no row of."""
        ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        return written(ids if known is None else ids.join(known.select("set_id"), "set_id", "left_anti"), "ids")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose wide sketches are not too far apart: for long sets the short ones say little."""
        new = self.wide_sketches(self.unknown(pairs, self.wide))
        self.wide = new if self.wide is None else self.wide.unionByName(new)
        for side in ("b", "a"):
            pairs = pairs.join(self.wide.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("wide").alias(f"wide_{side}")), side)
        size = F.least(F.size("wide_a"), F.size("wide_b"))
        apart = _bits_apart(*(_folded(F.col(f"wide_{side}"), size) for side in ("a", "b")))
        return pairs.where(apart * (100 + self.s.percent) <= (F.col("n_a") + F.col("n_b")) * (100 - self.s.percent)).select("a", "b")

    def remade(self, ids: DataFrame, columns, schema: str, name: str) -> DataFrame:
        """``columns`` of the wanted sets, each set made again from one of its texts."""
        own = self.classes.select("set_id", "doc_id", "key").join(ids, "set_id")
        if ids.count() <= self.s.most_broadcast:  # three numbers a row, so at most some 70 MB
            own = F.broadcast(own)
        width = self.s.width
        names = [c.split()[0] for c in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            make, done = shingler(width), set()
            for batch in pieces(batches, 200):
                found = []
                for own, text in zip(batch.column("set_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    tokens = make(text) if own not in done else ()
                    if len(tokens) and set_hashes(tokens)[0] == own:  # other texts may have its id and key too
                        done.add(own)
                        found.append((own, tokens))
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), *columns([t for _, t in found])], names=names)

        docs = self.docs.alias("d").join(own.alias("o"), F.col("d.key").eqNullSafe(F.col("o.key")) & F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")))
        rows = docs.select("o.set_id", "d.text").mapInArrow(run, schema)
        return written(rows, name)

    def wide_sketches(self, ids: DataFrame) -> DataFrame:
        """``set_id, n, wide`` of the wanted sets."""

        def columns(sets: list[np.ndarray]) -> list[pa.Array]:
            return [pa.array([len(t) for t in sets], pa.int64()), _lists([wide_sketch(t) for t in sets], np.int64)]

        return self.remade(ids, columns, "set_id long, n long, wide array<long>", "wide")

    def token_sets(self, ids: DataFrame) -> DataFrame:
        """``set_id, prefixes, tokens`` of the wanted sets.

        ``prefixes`` has an array of 32-bit keys for each further order.
        """
        orders, percent = self.s.orders, self.s.percent

        def columns(sets: list[np.ndarray]) -> list[pa.Array]:
            prefixes = [prefix_keys(t, o, percent) for t in sets for o in range(1, orders)]
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * (orders - 1)
            return [pa.ListArray.from_arrays(pa.array(offsets), _lists(prefixes, np.int32)), _lists([t.view(np.int64) for t in sets], np.int64)]

        return self.remade(ids, columns, "set_id long, prefixes array<array<int>>, tokens array<long>", "tokens")

    def links(self) -> DataFrame:
        """Links that connect all sets that links connect: few within a group of copies, all that join two groups."""
        near = self.similar(self.first_pairs())
        return near.unionByName(self.similar(self.far_apart(self.postings(near))))


def near_duplicates(docs: DataFrame, settings: JaccardSettings = JaccardSettings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    The component is the smallest id that links reach. Null texts and texts
    without words have no shingles and are their own component. Fewer words than
    the width are one shingle. Repeated rows give a row each, of the same
    component; a row with a null id takes part, and its component is null where
    links reach no id. Other columns of ``docs`` are not read. An empty table
    gives no rows.
    """
    rows = slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    join = _Join(rows, settings)
    of_set = connected_components(join.links())
    smallest = join.classes.select("set_id", "doc_id").join(of_set, F.col("set_id") == F.col("node"), "left").select("set_id", "doc_id", F.coalesce("component", "set_id").alias("cluster"))
    root = smallest.groupBy("cluster").agg(F.min("doc_id").alias("component_id"))
    of_class = written(smallest.join(root, "cluster").select("set_id", "component_id"), "of_class")
    return join.sets.select("doc_id", "n", "set_id").join(of_class, "set_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id for every whole text of ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents"))
