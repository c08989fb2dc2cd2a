"""A corpus, step by step: each stage works on all that the stage before kept.

Every stage is written as Parquet to the shared folder of the session and read
again, so the lineage is cut and a lost executor costs no earlier stage.

Every stage takes null ids, texts, langs and sources, empty and long texts, an
empty table and further columns of any name. A null or empty text has no letters
and goes in the first stage. Of rows that repeat doc_id and text one stays in the
second; a null doc_id counts as the smallest there, as the largest in the third.
Mixing may give a document more than once.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import bpe, exact, language, mixing, simhash
from broadsheet.llm.common import table
from broadsheet.llm.queries import vocabulary_path
from broadsheet.plans.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; the rejected ones go."""
    return language.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one of largest doc_id."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest doc_id."""
    return simhash.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources say."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for nth, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if nth < len(STAGES):
            docs = stored(docs, f"stage{nth}")
    return docs


#: SQL has no PPM model, XXH64 or BPE; tests compare run() with a plain version.
ORACLE_SQL = None
