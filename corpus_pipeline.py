"""A cleaning pipeline over `documents`: each stage is one operator on what the last one kept.

Every stage takes any columns beside `doc_id` and `text`, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from unitledger.llm import decontaminate, ngram_join, pieces, pii, quality
from unitledger.llm.common import bounded_batches, prepare, table, written
from unitledger.llm.queries import PIECES

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, null and empty texts among them; of repeated rows all or
    none stay."""
    bounded_batches(spark)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays, once if the row repeats. Null and
    empty texts and rows without an id have no links and stay."""
    return ngram_join.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go, row by row; null and empty texts stay, and with an empty
    benchmark all do."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; all documents stay, null texts as null."""
    return pii.mask_pii(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are added as `ids`, in place of a column of that name; `text` becomes what they
    decode to. A null text stays null and has the end id alone; all rows stay, repeated ones too."""
    import public_tokenizers

    return pieces.recode_documents(docs, public_tokenizers.path(PIECES))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

# The first stage holds trained trees and the last one encodes, neither of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole of `documents`; each result is written before the next."""
    docs = table(prepare(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
