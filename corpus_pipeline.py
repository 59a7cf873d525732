"""The corpus pipeline: stages that each call one operator and hand their rows on as Parquet.

1. toxicity: documents that the classifier rejects go.
2. jaccard: of each group of near duplicates (5 words, 0.8) the smallest id stays.
3. decontamination: documents with too many benchmark words go.
4. secrets: secrets in the texts are masked; no document goes.
5. packing: what is left is packed into sequences of at most 4096 tokens.

The first four return the columns of ``documents``. Null and empty texts pass
all filters. SQL can't express the stages: they are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import table, without_ids, written
from noticelake.llm.decontamination import find_contamination, is_contaminated
from noticelake.llm.jaccard import near_duplicates
from noticelake.llm.packing import pack_documents
from noticelake.llm.secrets import mask_secrets
from noticelake.llm.toxicity import train_on_tables, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score below the threshold of a model fitted on ``labels``; columns as they came.

    Null and empty texts score as no words and stay unless that alone is toxic.
    Equal texts share their fate, repeated and null ids don't matter, further
    columns are handed on, and an empty table gives none.
    """
    return without_toxic(docs, train_on_tables(docs, table(spark, sf_dir, "labels")))


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the rows of its smallest id; columns as they came.

    An id is a document: repeated rows of one id stay or go together, and a row
    with a null id always stays. Texts that are null, empty or without words are
    nobody's duplicate. An empty table gives none.
    """
    return without_ids(docs, near_duplicates(docs).where("component_id <> doc_id").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of documents that are not contaminated by ``benchmark``; columns as they came.

    If one of several texts of an id is contaminated, all rows of the id go; a
    row with a null id always stays. Null and empty texts have no words and
    stay, and without benchmark items all do. An empty table gives none.
    """
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return without_ids(docs, found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in ``text`` masked and ``n_chars`` counted anew.

    Null texts stay null and empty ones empty. Equal texts are masked alike;
    ids don't matter, and further columns are handed on. An empty table gives none.
    """
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its place in a sequence.

    A null text packs as an empty one, that is its end token alone. Repeated
    rows are packed each; ties of length are dealt in any order. An empty table
    gives no rows.
    """
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("jaccard", jaccard),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: None: no stage can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's rows written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
