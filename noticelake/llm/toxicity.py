"""Toxicity: a counterfactual-regularised classifier.

A document is the set of its lower-cased words. A word contributes hashed
features (itself and its stems), so a score is a sum over distinct words and a
text of any length is scored whole with one lookup a word. Training minimises
the logistic loss of labelled documents plus ``penalty`` times the mean squared
change of the logit when the identity terms of one of a labelled document's
sentences, or of all, are swapped for each other term of their group. A mention
of a group alone therefore moves a score little, whatever the labels say on
average.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTERS, Memo, id_mod, kept_by_worker, pieces, slim, table
from .ftrl import Ftrl

# Identity terms, by group, in the four languages of the tables. A term is swapped within its group.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("frauen", "männer"),
    ("muslimisch", "christlich", "jüdisch"),
    ("muslime", "christen", "juden"),
    ("schwul", "lesbisch", "hetero"),
    ("femmes", "hommes"),
    ("musulman", "chrétien", "juif"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


@dataclass(frozen=True)
class ToxicitySettings:
    """Parameters of training; ``most_rows`` bounds the labelled sample that one task fits on.

    ``distinct_rows``: copies, which a corpus has many of, count once in training.
    A sample of few rows is gone through more than ``epochs`` times, until
    ``least_steps`` are made or ``most_epochs`` are done.
    """

    bits: int = 18
    stems: tuple[int, ...] = (4, 5, 6)
    most_rows: int = 12_000
    epochs: int = 6
    most_epochs: int = 24
    least_steps: int = 12_000
    alpha: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    penalty: float = 1.0
    threshold: float = 0.7
    distinct_rows: bool = True
    groups: Sequence[Sequence[str]] = field(default=IDENTITY_GROUPS)

    def swaps(self) -> list[dict[str, str]]:
        """All swaps of a term for another of its group: in the k-th each term is replaced by the k-th after it."""
        most = max((len(g) for g in self.groups), default=0)
        return [{w: g[(at + k) % len(g)] for g in self.groups for at, w in enumerate(g) if k < len(g)} for k in range(1, most)]


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    settings: ToxicitySettings


def word_features(word: str, settings: ToxicitySettings) -> list[int]:
    """Hashed ids of a word and of its stems; ids may repeat."""
    mask = (1 << settings.bits) - 1
    return [zlib.crc32(b"w" + word.encode()) & mask] + [zlib.crc32(b"s" + word[:n].encode()) & mask for n in settings.stems if len(word) > n]


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


def counterfactuals(text: str, swaps: Sequence[Mapping[str, str]]) -> set[tuple[frozenset[str], frozenset[str]]]:
    """The distinct (words that go, words that come) when the identity terms of one sentence, or of all, are swapped."""
    sentences = [LETTERS.findall(part) for part in re.split(r"[.!?\n]+", text.lower())]
    own = {w for s in sentences for w in s}
    out = set()
    for swap in swaps:
        named, elsewhere = [], set()
        for k, words in enumerate(sentences):
            if swap.keys().isdisjoint(words):
                elsewhere.update(words)
            else:
                named.append(k)
        times = Counter(w for k in named for w in set(sentences[k]))
        for changed in [named, *([k] for k in named if len(named) > 1)]:
            before = Counter(w for k in changed for w in set(sentences[k]))
            after = {swap.get(w, w) for w in before}
            kept = elsewhere | {w for w, n in times.items() if n > before[w]}
            out.add((frozenset(before.keys() - after - kept), frozenset(after - own)))
    return {x for x in out if x[0] or x[1]}


_SAMPLE = pa.schema([("toxic", pa.int32()), ("ids", pa.list_(pa.int32())), ("times", pa.list_(pa.int16())), ("moved", pa.list_(pa.list_(pa.int32()))), ("by", pa.list_(pa.list_(pa.int16())))])
_SAMPLE_SQL = "toxic int, ids array<int>, times array<short>, moved array<array<int>>, by array<array<short>>"


def _counted(came: list[int], gone: list[int] = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Feature ids and how often each comes, less how often it goes; those where both are equal are left out."""
    ids, where = np.unique(np.array([*came, *gone], np.int32), return_inverse=True)
    n = np.bincount(where, weights=np.repeat([1.0, -1.0], [len(came), len(gone)]), minlength=len(ids)).clip(-32768, 32767).astype(np.int16)
    return ids[n != 0], n[n != 0]


def _sample_features(settings: ToxicitySettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swaps, ids = settings.swaps(), Memo(lambda w: word_features(w, settings))
        terms = {w for swap in swaps for w in swap}
        flat = lambda words: [i for w in words for i in ids[w]]
        for batch in pieces(batches):
            cols: dict[str, list] = {f.name: [] for f in _SAMPLE}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = words_of(text)
                own = _counted(flat(words))
                changes = counterfactuals(text, swaps) if not words.isdisjoint(terms) else ()
                moves = [_counted(flat(came), flat(gone)) for gone, came in sorted(changes, key=lambda x: (sorted(x[0]), sorted(x[1])))]
                moves = [m for m in moves if len(m[0])]
                for name, value in (("toxic", int(toxic > 0)), ("ids", own[0]), ("times", own[1]), ("moved", [m[0] for m in moves]), ("by", [m[1] for m in moves])):
                    cols[name].append(value)
            yield pa.RecordBatch.from_pydict(cols, schema=_SAMPLE)

    return run


class _Lists:
    """A column of lists, or of lists of lists, as flat arrays, without an object a row."""

    def __init__(self, chunks: list[pa.Array]):
        whole = pa.concat_arrays(chunks)
        self.at, values = whole.offsets.to_numpy(), whole.values
        self.values = _Lists([values]) if pa.types.is_list(values.type) else values.to_numpy()

    def __getitem__(self, k: int):
        return self.values[self.at[k] : self.at[k + 1]]


def _fit(toxic: np.ndarray, examples: dict[str, _Lists], s: ToxicitySettings) -> np.ndarray:
    """Weights by FTRL over the examples in an order of their own; the bias is the feature after the last hashed one."""
    dim = 1 << s.bits
    ftrl, rng = Ftrl(dim + 1, 1, s.alpha, 1.0, s.l1, s.l2), np.random.default_rng(0)
    if len(toxic):
        ids, times, outer = examples["ids"], examples["times"], examples["moved"].at
        moved, by = examples["moved"].values, examples["by"].values
        named = {}  # examples by content, in an order that the order of tasks can't change
        for k in range(len(toxic)):
            key = (hashlib.blake2b(ids[k].tobytes() + times[k].tobytes(), digest_size=16).digest(), int(toxic[k]))
            named.setdefault(key if s.distinct_rows else (*key, k), k)
        rows = np.array([named[key] for key in sorted(named)])
        one = np.ones(1)
        for _ in range(max(s.epochs, min(s.most_epochs, s.least_steps // len(rows)))):
            for k in rng.permutation(rows):
                rows_k, x = np.append(ids[k], dim), np.append(times[k], one)
                w = ftrl.weights(rows_k)[:, 0]
                p = 1 / (1 + math.exp(-min(30.0, max(-30.0, float(w @ x)))))
                ftrl.update(rows_k, w[:, None], ((p - toxic[k]) * x)[:, None])
                for m in range(outer[k], outer[k + 1]) if s.penalty else ():
                    d = by[m].astype(float)
                    v = ftrl.weights(moved[m])[:, 0]
                    ftrl.update(moved[m], v[:, None], (2 * s.penalty / (outer[k + 1] - outer[k]) * float(v @ d) * d)[:, None])
    return ftrl.weights()[:, 0]


def fit_toxicity(labelled: DataFrame, settings: ToxicitySettings = ToxicitySettings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fits on the labelled rows, which the caller bounds (``train_on_tables`` does), in one task.

    Rows without an id or a label are left out and a null text counts as empty.
    Of equal word sets with equal labels one is kept if ``settings.distinct_rows``.
    The order of rows does not matter. Without any row the model scores every
    text 0.5. The driver gets the weights that are not 0 alone.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        examples = {c: _Lists([b.column(c) for b in got]) for c in _SAMPLE.names[1:]} if got else {}
        toxic = np.concatenate([np.zeros(0, np.int32), *(b.column("toxic").to_numpy() for b in got)])
        got.clear()  # from here on there is one copy of all
        weights = _fit(toxic, examples, settings)
        ids = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(weights[ids])], names=["id", "weight"])

    rows = labelled.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(label_col).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    examples = rows.select("text", "toxic").mapInArrow(_sample_features(settings), _SAMPLE_SQL)
    found = examples.repartition(1).mapInArrow(fit, "id long, weight double").toArrow()
    weights = np.zeros((1 << settings.bits) + 1)
    weights[found.column("id").to_numpy()] = found.column("weight").to_numpy()
    return ToxicityModel(weights[:-1], float(weights[-1]), settings)


def bounded(labels: DataFrame, most: int, id_col: str = "doc_id") -> DataFrame:
    """About ``most`` rows at most, by a hash of the id: the same rows in every run."""
    n = labels.count()
    if n <= most:
        return labels
    scale = 1 << 30
    return labels.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(scale)) < int(scale * 0.97 * most / n))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


@kept_by_worker()
def _scores(sent) -> Callable[[str | None], float]:
    m = sent.value
    weight = Memo(lambda w: float(m.weights[word_features(w, m.settings)].sum()))

    def score(text: str | None) -> float:
        z = m.bias + math.fsum(weight[w] for w in words_of(text))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row.

    Null and empty texts get the score of no words. Equal texts get equal scores,
    repeated rows a row each, and a text of any length is scored whole. Null ids
    stay null, other columns are not read, and an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores(sent)
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(score, batch.column("text").to_pylist()), pa.float64())], schema=_SCORED)

    rows = slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= model.settings.threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)
    threshold = model.settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scores(sent)
        for batch in pieces(batches):
            yield batch.filter(pa.array([score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def train_on_tables(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(), folds: int = 3, held_out: int = 1) -> ToxicityModel:
    """Fits on the labelled documents outside the held-out fold of ids."""
    mine = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(id_mod("doc_id", folds) != held_out)
    few = bounded(mine, settings.most_rows)
    # few has at most about most_rows rows of two numbers: that is the checked size of this broadcast.
    return fit_toxicity(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"), settings)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = train_on_tables(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", (id_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
