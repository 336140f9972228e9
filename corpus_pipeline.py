"""A training corpus from raw documents, in five stages.

Toxic documents go, then all but one of equal texts, then all but one of each
group of near copies; of rows repeated with one id or without one, which these
two stages leave, one of each text goes on; sources are mixed to their target weights (a document
stands as often as the mix takes it), and what is left is packed into
sequences.  Each stage works on all that its predecessor kept, written as
Parquet and read again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import load, materialize, small_batches
from ledgerline.llm.exact_dedup import drop_exact_copies, one_per_text
from ledgerline.llm.jaccard import drop_near_copies
from ledgerline.llm.mixing import mixed
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.toxicity import drop_toxic


#: Of text that a task takes at a time: several stages share an executor's memory with what earlier ones left in its Python workers.
BATCH_BYTES = 8 << 20


def _in_small_batches(stage):
    """The stage with Arrow batches of at most BATCH_BYTES, also when its result is written later by whoever called it.

    ``run`` puts the session's setting back; a caller of single stages does so after writing.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@_in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, load(spark, sf_dir, "labels"))


@_in_small_batches
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


@_in_small_batches
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


@_in_small_batches
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(one_per_text(docs))


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_jaccard", ngram_jaccard), ("mixing", mixing), ("packing", packing)]

#: The toxicity model and the packing are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    with small_batches(spark, BATCH_BYTES):  # the setting is put back: each stage is written inside, and packing writes its sequences itself
        docs = load(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)
