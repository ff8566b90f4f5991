"""A corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes all that its predecessor kept, as a table in the shared folder, and all but the last return the columns
of documents. SQL cannot express learned scores, rounding at random or tokenization, so there is no ORACLE_SQL; the
tests hold every stage against plain code.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from navspan.llm import stages
from navspan.llm.shared import written

ORACLE_SQL = None

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.not_toxic),
    ("exact dedup", stages.distinct_texts),
    ("n-gram Jaccard join", stages.distinct_sets),
    ("mixing sources to target weights", stages.mixed_sources),
    ("packing", partial(stages.packed, tokenizer=public_tokenizers.path("word_bpe_49k.json"))),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
