"""A corpus pipeline: language ID, near-duplicates, mixing to target weights, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. run() writes each stage's result as Parquet in the shared folder and reads it again for the next.

Defined cases: language_id drops null texts and texts without letters, so later stages see neither from it; on
their own, near_duplicates keeps rows without words, mixing counts them as 0 tokens, and bpe gives them no ids. A
null doc_id is a document like others. Of rows with one doc_id and one text the first by their other columns stays;
with different texts each goes or stays for its own text, and mixing takes them together or not at all. Very long
texts are taken whole by every stage. An empty table, or one without a labelled text, gives no rows. Further columns
pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import bpe, jaccard, langid, mixing
from cellweave.llm.common import Workspace, table
from cellweave.llm.queries import BYTE_BPE

#: A text of which no language has this share is rejected, as is one without letters or in none of the learned languages.
LEAST_SHARE = 0.3
MIXTURE = mixing.Mixture(percent=90, epochs=1)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in none of the learned languages; the others get the predicted language where they had none."""
    return langid.keep_identified(docs, LEAST_SHARE, fill=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays, each row by its own text."""
    return jaccard.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in their leaf's token-prefix."""
    return mixing.select(docs, MIXTURE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the digest of what they decode to."""
    return bpe.digests(docs, BYTE_BPE)


STAGES = [("language_id", language_id), ("ngram_jaccard_join", near_duplicates), ("mixing", mix), ("bpe", encode)]
#: Language proportions by expectation-maximisation can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = table(spark, sf_dir, "documents"), Workspace(spark)
    for _, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir))
    return docs
