"""Documents to packed sequences, in stages that each call one operator.

Defined cases of every stage: NULL and empty texts are documents without words, which
the quality rules reject; a stage given one all the same keeps it as it is (packing: its
end-of-document token). Rows without an id, rows that share an id and equal rows are
kept and judged row by row, but of near copies with ids one row stays (equal rows that
share its id with it). Extra columns, also ones named like a stage's own, are passed on
unchanged by all stages but the last, which ignores them. Tables without rows give
tables without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelstone.llm import decontaminate, ngram_join, packing, quality_rules, substring_dedup
from keelstone.llm.queries import table, tokenizer_path
from keelstone.llm.shared import stage

# Shingles of five words, and sets that are similar by 0.8 or more.
SHINGLE_WORDS, SIMILARITY = 5, 80
# Repeated passages of this many words or more are removed.
REPEAT_WORDS = 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long passages that an earlier document has."""
    return substring_dedup.remove_repeats(docs, REPEAT_WORDS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage close to a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeats),
    ("benchmark_decontamination", decontaminated),
    ("packing", packed),
]

#: SQL can express neither the components nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, build in STAGES[:-1]:
        docs = stage(build(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
