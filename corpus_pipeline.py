"""From raw documents to token ids: five stages, each a step of ``quillstat.llm`` over all rows it gets.

    toxicity          documents scored as toxic by the chain model go
    exact_dedup       of equal texts the row with the least id stays
    near_dedup        of linked near duplicates the document with the least id stays
    decontamination   documents that hold a benchmark item go
    piece_codec       whole texts become SentencePiece ids, checked by decoding them

Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillstat.llm import decontaminate, exact_dedup, order_minhash, piece_codec, toxic_crf
from quillstat.llm.catalog import PIECE_MODEL
from quillstat.llm.common import cut, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxic_crf.train_toxicity(docs, labels, ~toxic_crf.held_out_rows())
    return toxic_crf.keep_harmless(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_codec.round_trips(docs, public_tokenizers.path(PIECE_MODEL), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontamination),
    ("piece_codec", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; every one is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained model, a sketch and a piece search are beyond SQL; tests compare each stage with a brute-force form.
ORACLE_SQL = None
