"""The corpus pipeline: documents in, token ids out, in stages that are each written and read again.

Null and empty texts have no evidence of toxicity, link with nothing, hold no passage and no words;
they stay until the mix, which takes documents by their words and copies. Rows of null doc_id take no
part in the joins and stay. Exact copies are one document, that of the smallest doc_id; repeated rows
of one doc_id stay or go together. Extra columns, also of names that a stage uses for itself, pass
through all stages; the last adds ``ids`` (in place of any of that name). An empty table gives an
empty table, and texts may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, jaccard_join, mixing, suffix_dedup, toxicity
from millrace.llm.queries import vocabulary
from millrace.llm.tables import Scratch, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one of the smallest doc_id stays."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; a document of nothing else goes."""
    return suffix_dedup.cut_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A column of token ids is added."""
    return bpe.encode_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each_group),
    ("suffix_dedup", cut_repeated_passages),
    ("mixing", mix),
    ("bpe", encode),
]

#: Its stages are no SQL; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
