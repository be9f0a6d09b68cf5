"""A corpus of documents made ready for training, stage by stage.

Each stage is written as Parquet to the shared folder and read back as the next
one's documents: a lost executor costs no more than the stage at work.

Defined results, for all stages: whole texts count, however long; ``doc_id``,
``lang``, ``source`` and every other column may be null; all but the last stage
keep the columns of ``documents`` and any others, whatever their names; an empty
table gives an empty result. What a stage does with null and empty texts,
repeated rows and ties stands with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from littoral.llm import bpe, decontaminate, quality, simhash, suffixes
from littoral.llm.common import materialize, read_table, release


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier estimates reject go.

    Null and empty texts have no words and go by the base rules. Null languages
    and sources count as empty ones. Repeated rows have one verdict and stay
    repeated; rows at the same distance count together.
    """
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    It is the one of the smallest ``doc_id``, null last; of equal ids the one of
    the smallest text hash; of repeated rows any one. Null, empty and blank texts
    are one group.
    """
    return simhash.first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of ``suffixes.SHORT`` bytes that stand in two places go from the texts, the first of them as well.

    Passages of over 50 words are mostly longer than that. Documents stay, with
    what is left of them, null texts as null; ``n_chars`` follows. Of rows with
    the same long text all lose it, so that empty texts may be left.
    """
    return suffixes.clean(docs, suffixes.SHORT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none, and null and empty items are held by none.
    Repeated rows go or stay together; of items it does not matter which one is met.
    """
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of what they decode to.

    Null and empty texts have no ids. Repeated rows stay rows, and null
    ``doc_id``s null; other columns are left out.
    """
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", quality_rules),
    ("simhash", near_dedup),
    ("suffix_array", substring_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: SQL can express neither the estimates nor the suffix arrays nor the encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
