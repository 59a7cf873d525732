"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The n-grams of a word (padded with its two borders) are hashed; a document's
vector is its n-gram counts times IDF, divided by their sum. IDF comes from the
document counts of all training documents. Weights are fitted with
follow-the-regularised-leader and elastic-net penalties on a bounded sample and
are then divided by a temperature that is fitted on a part kept out of it.
The n-grams of a whole text are hashed together, by array operations.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTERS, id_mod, slim, table
from .ftrl import Ftrl

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """``most_rows`` bounds the sample that is fitted on the driver; counts cover all training rows."""

    bits: int = 16
    longest: int = 4
    most_rows: int = 8_000
    epochs: int = 3
    alpha: float = 0.5
    l1: float = 0.5
    l2: float = 0.1
    scale: float = 50.0
    calibration_share: float = 0.2


@dataclass(frozen=True)
class LanguageModel:
    classes: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    settings: LanguageSettings


def gram_ids(words: list[str], s: LanguageSettings) -> np.ndarray:
    """Hashed ids of the character n-grams of each ``<word>``, with repeats, all words at once."""
    chars = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.cumsum(chars == ord("<"))
    h, out = np.zeros(len(chars) + 1, np.uint64), []
    for n in range(1, s.longest + 1):
        h = h[:-1] * np.uint64(0x100000001B3) + chars[n - 1 :]
        mixed = ((h ^ (h >> np.uint64(29))) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - s.bits)
        out.append(mixed[word[: len(h)] == word[n - 1 :]])  # not over the border of two words
    return np.concatenate(out).astype(np.int64)


def _words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


_COUNTS = pa.schema([("gram", pa.int32()), ("n", pa.int64()), ("lang", pa.string()), ("docs", pa.int64())])


def _document_counts(s: LanguageSettings):
    """Of each task: in how many documents a gram is, and the documents of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = Counter()
        df, some, n = np.zeros(1 << s.bits, np.int64), np.zeros(1 << s.bits, np.uint16), 0
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words = _words(text)
                if words:
                    here = np.zeros(1 << s.bits, np.uint8)
                    here[gram_ids(words, s)] = 1
                    some += here
                    langs[lang] += 1
                    n += 1
                    if n % 60_000 == 0:  # before the small counters overflow
                        df += some
                        some[:] = 0
        df += some
        got = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(df[got]), pa.nulls(len(got), pa.string()), pa.nulls(len(got), pa.int64())], schema=_COUNTS)
        if langs:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(langs), pa.int32()), pa.nulls(len(langs), pa.int64()), pa.array(list(langs), pa.string()), pa.array(list(langs.values()), pa.int64())], schema=_COUNTS)

    return run


_BAGS = pa.schema([("lang", pa.string()), ("grams", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])


def _bags(s: LanguageSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {f.name: [] for f in _BAGS}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words = _words(text)
                if words:
                    n = np.bincount(gram_ids(words, s))
                    got = np.flatnonzero(n)
                    cols["lang"].append(lang)
                    cols["grams"].append(got.astype(np.int32))
                    cols["n"].append(n[got].astype(np.int32))
            yield pa.RecordBatch.from_pydict(cols, schema=_BAGS)

    return run


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """Smallest log loss over a grid of temperatures; 1 without rows."""
    if not len(target):
        return 1.0
    grid = np.exp(np.linspace(math.log(0.05), math.log(20), 121))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(target)), target], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_language(rows: DataFrame, settings: LanguageSettings = LanguageSettings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns the distinct non-null values of ``lang_col``.

    Rows without a language, id, text or letter teach nothing. With no rows at
    all the model knows no language and every text is ``und``.
    """
    s = settings
    train = slim(rows, id_col, text_col, F.col(lang_col).cast("string").alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    counts = train.select("text", "lang").mapInArrow(_document_counts(s), "gram int, n long, lang string, docs long").groupBy("gram", "lang").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).collect()  # 2**bits grams and the languages, whatever the input
    langs = {r.lang: r.docs for r in counts if r.lang is not None}
    classes, total = tuple(sorted(langs)), sum(langs.values())
    df = np.zeros(1 << s.bits)
    for r in counts:
        if r.gram is not None:
            df[r.gram] = r.n
    idf = np.log((1 + total) / (1 + df)) + 1
    if not classes:
        return LanguageModel((), idf, np.zeros((1 << s.bits, 0)), np.zeros(0), 1.0, s)
    scale = 1 << 30
    few = train if total <= s.most_rows else train.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(scale * 0.97 * s.most_rows / total))
    examples = []
    for batch in few.select("text", "lang").mapInArrow(_bags(s), "lang string, grams array<int>, n array<int>").toArrow().to_batches():
        grams, n = batch.column("grams"), batch.column("n")
        for k, lang in enumerate(batch.column("lang").to_pylist()):
            g = grams[k].values.to_numpy()
            x = n[k].values.to_numpy() * idf[g]
            examples.append((classes.index(lang), g, x * (s.scale / x.sum())))
    examples.sort(key=lambda e: (e[1].tobytes(), e[0]))  # the order of tasks must not matter
    rng = np.random.default_rng(0)
    order = rng.permutation(len(examples))
    held = order[: int(len(order) * s.calibration_share)] if len(order) >= 50 else order[:0]
    ftrl, dim = Ftrl((1 << s.bits) + 1, len(classes), s.alpha, 1.0, s.l1, s.l2), 1 << s.bits
    for _ in range(s.epochs):
        for k in rng.permutation(order[len(held) :]):
            y, g, x = examples[k]
            g, x = np.append(g, dim), np.append(x, 1.0)
            w = ftrl.weights(g)
            p = _softmax(x @ w)
            p[y] -= 1
            ftrl.update(g, w, x[:, None] * p)
    w = ftrl.weights()
    logits = np.array([examples[k][2] @ w[examples[k][1]] + w[dim] for k in held]).reshape(len(held), len(classes))
    return LanguageModel(classes, idf, w[:dim], w[dim], _temperature(logits, np.array([examples[k][0] for k in held], int)), s)


_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row: the likeliest language and its probability.

    A null text and one without a letter are ``und`` with score 0; equal
    probabilities go to the first language in order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits rows of weights, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.classes)
        sums_of = np.column_stack([m.idf[:, None] * m.weights, m.idf])  # of a gram: its weighted IDF by language, and its IDF
        for batch in batches:
            preds, scores = [], []
            for text in batch.column("text").to_pylist():
                words = _words(text)
                if not k or not any(c.isalpha() for w in words for c in w):
                    preds.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                n = np.bincount(gram_ids(words, m.settings))
                got = np.flatnonzero(n)
                sums = n[got] @ sums_of[got]
                p = _softmax((sums[:k] * (m.settings.scale / sums[k]) + m.bias) / m.temperature)
                best = int(np.argmax(p))
                preds.append(m.classes[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], schema=_OUT)

    return slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs.where(id_mod("doc_id", 5) != 0))
    return predict_language(docs, model).select("doc_id", (id_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
