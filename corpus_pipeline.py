"""A training corpus from raw documents, in stages that are written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept: documents of
no recognised language go, one document of each group of near copies stays, passages that repeat
are removed, secrets are replaced by a mark, and what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from regiofact.llm import language, packing, secrets, simhash, suffix_dedup
from regiofact.llm.base import picked, query, recorded, released, stored, table, tokenizer

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: What the stages of the latest run wrote on their way.
_WRITTEN: list[str] = []


def stage(function: Stage) -> Stage:
    """A stage that first deletes what earlier stages of its run wrote and its documents don't read.

    So the folder of written steps holds the last complete stage, from which a run can go on, and
    the steps of the present one.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        first = function.__name__ == STAGES[0][1].__name__  # another run's steps are its own
        _WRITTEN[:] = [] if first else released(_WRITTEN, docs)
        with recorded(_WRITTEN):
            return function(spark, docs, sf_dir)

    return run


@stage
def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from four fifths of them."""
    return language.accepted(docs, language.fit(docs))


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of three words at two bits, the one of the smallest doc_id.

    Documents without doc_id are all kept. Of rows of one group that repeat its doc_id
    one stays.
    """
    return simhash.representatives(docs, size=3)


@stage
def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; emptied documents stay, as empty texts."""
    return suffix_dedup.shortened(docs)


@stage
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    return secrets.redacted(docs)


@stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 4096 tokens."""
    return packing.packed(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", recognised),
    ("simhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", without_passages),
    ("secret_scan", without_secrets),
    ("packing", sequences),
]

#: A trained classifier and whole-text fingerprints are not to be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = picked(table(spark, sf_dir, "documents"), **COLUMNS)
    for name, step in STAGES:
        lazy = step(spark, docs, sf_dir)
        with recorded(_WRITTEN):
            docs = stored(lazy, name)
    return docs


@query(ORACLE_SQL)
def pipeline(spark, sf_dir):
    """Sequences of the whole corpus."""
    return run(spark, sf_dir)
