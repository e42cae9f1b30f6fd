"""A corpus in four stages: drop toxic documents, keep one of each group of near copies, drop documents
that hold benchmark passages, pack the rest into training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written as Parquet
and read again before the next one. All but the last return the columns of ``documents``.

Null and empty texts pass all filters; as documents without shingles they are near copies of nothing, and each is packed as its end
id. Null ids stay. Repeated rows are near copies of one another, so one of them stays. Very long texts are handled whole by each stage.
Other columns of ``documents``, whatever their names, go along up to the last stage. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwright.llm.common import table, tokenizer_path, written
from loomwright.llm.decontaminate import clean
from loomwright.llm.ngram_join import keep_one
from loomwright.llm.packing import pack
from loomwright.llm.toxicity import fit_on, keep_ordinary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_ordinary(docs, fit_on(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path(), end_id=1)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_contaminated), ("packing", pack_sequences)]

#: No SQL dialect can express compression distances or tokenization.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
