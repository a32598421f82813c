"""Corpus pipeline: from documents to token batches in five stages.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result
is written and read again as the next one's docs, and then what it was made from, its
predecessor's result and its own scratch, is deleted. All but the last return the columns
of documents:

1. quality rules: documents that fail the rules, or their host's stricter form, go;
2. quality classifier: documents judged bad or toxic go; labels come from ``sf_dir``;
3. SimHash near-dedup: of each group the document with the smallest doc_id stays;
4. suffix-array dedup: of passages of 400 bytes and more only the first copy stays, and
   of what is left then, of passages of more than 50 words, however few their bytes;
5. packing: the documents left are dealt to length buckets and token batches.

Nulls, ties, repeated rows, empty tables and extra columns: as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import cotrain, packing, pieces, rules, simhash, suffix
from ledgerspark.llm.common import table
from ledgerspark.llm.queries import PIECE_MODEL
from ledgerspark.sources.scratch import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.filter_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotrain.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = settled(spark, lambda: suffix.drop_passages(docs))
    return suffix.drop_passages(left, suffix.LEAST_WORDS, suffix.WORDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, pieces.tokenizer_path(PIECE_MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("packing", pack),
]

#: A trained classifier, component search, suffix arrays and bucket planning are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    def after(stages: int) -> DataFrame:
        if not stages:
            return table(spark, sf_dir, "documents")
        stage = STAGES[stages - 1][1]
        return settled(spark, lambda: stage(spark, after(stages - 1), sf_dir))

    return STAGES[-1][1](spark, after(len(STAGES) - 1), sf_dir)
