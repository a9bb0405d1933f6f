"""From raw documents to shuffled token rows: five stages, each one corpus operator over all that its predecessor kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of documents. ``run`` applies them to the documents table, every stage's rows written
to the shared folder and read back, so that none is computed twice and a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sonorium.llm import op1_mixing, op2_ngram_join, op5_exact, op7_toxicity, op8_bpe
from sonorium.llm.common import cut, read


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't toxic; the lexicon is completed from the labels table."""
    return op7_toxicity.drop_toxic(docs, op7_toxicity.fit_lexicon(docs, read(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return op5_exact.drop_exact_duplicates(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return op2_ngram_join.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated to the sources' target weights, in a global random order."""
    return op1_mixing.mix_sources(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens and their byte ends of every row."""
    return op8_bpe.encode(docs, columns=["doc_id", "lang", "source"])


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", ngram_jaccard_join), ("mixing sources to target weights", mix), ("byte-level BPE encoding and decoding", bpe)]

#: Learnt lexica and byte-pair merges have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
