"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates every vocabulary match of a word; dynamic
programming over character positions carries only the best score and its piece
count. The rules are those of the `tokenizers` library's Unigram model with byte
fallback: matches are offered by start and then length, a later one replaces an
earlier one at the same end only with a strictly higher score, a character
without a one-character piece may be unknown at the lowest score less 10 and
then counts as its UTF-8 bytes. Words begin at a space, written as U+2581, so a
word's count depends on the word alone and is remembered.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, kept_by_worker, slim, table

SPACE = "▁"
#: What the library's Metaspace splitting makes of a text whose spaces are written U+2581.
_WORDS = re.compile(f"{SPACE}[^{SPACE}]*|[^{SPACE}]+")


def unigram_vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces of a public vocabulary file with log probabilities falling with rank (1/rank, normalised)."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    total = math.log(sum(1 / (k + 1) for k in range(len(pieces))))
    return [(p, -math.log(k + 1) - total) for k, p in enumerate(pieces)]


class CountOnlyViterbi:
    """Counts the pieces of the best segmentation of a word."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: str = "<unk>"):
        self.automaton = ahocorasick.Automaton()
        self.single = set()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        self.unknown_score = min(s for _, s in vocabulary) - 10.0

    def count(self, word: str) -> int:
        n = len(word)
        by_start: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (length, score) in self.automaton.iter(word):
            by_start[end - length + 1].append((end + 1, score))
        best: list[float | None] = [None] * (n + 1)
        pieces = [0] * (n + 1)
        best[0] = 0.0
        for start in range(n):
            here = best[start]
            if here is None:
                continue
            for end, score in sorted(by_start[start]):
                if best[end] is None or here + score > best[end]:
                    best[end], pieces[end] = here + score, pieces[start] + 1
            if word[start] not in self.single:
                end = start + 1
                if best[end] is None or here + self.unknown_score > best[end]:
                    best[end], pieces[end] = here + self.unknown_score, pieces[start] + len(word[start].encode("utf-8", "surrogatepass"))
        return pieces[n]


def words_for_counting(text: str | None) -> list[str]:
    """The text's words as the model sees them; none of a null or empty text."""
    if not text:
        return []
    text = text.replace(" ", SPACE)
    return _WORDS.findall(text if text.startswith(SPACE) else SPACE + text)


@kept_by_worker()
def _counts(vocabulary_path: str | None) -> Memo:
    """One for each worker, so that its words are kept from task to task."""
    return Memo(CountOnlyViterbi(unigram_vocabulary(vocabulary_path)).count)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, vocabulary_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for every row; 0 for a null or empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary_path)
        for batch in batches:
            n = [sum(map(counts.__getitem__, words_for_counting(text))) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], schema=_OUT)

    return slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens for every whole text of ``documents``."""
    return count_tokens(table(spark, sf_dir, "documents"))
