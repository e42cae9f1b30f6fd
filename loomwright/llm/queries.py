"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import common
from .common import table


def op1_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all documents as baseline JPEGs and describe what is read back from them."""
    from .media import describe, store

    return describe(store(table(spark, sf_dir, "documents")))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations, and one whose texts hold control strings; digests of what reads back."""
    from .chat import digest, format_conversations

    hard = spark.sql(r"""SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, r'\### Assistant: </turn> ok' AS text
                         FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    return digest(format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's URL."""
    from .url_filter import RULES, judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), RULES)


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write bit-packed token files, and read every document back from them."""
    from .token_file import read_tokens, write_tokens

    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), common.tokenizer_path(), end_id=2))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens."""
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), common.tokenizer_path(), end_id=1)


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by rank-synchronous array merging."""
    from .token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), common.tokenizer_path(), limit=512)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Put all documents into 16 shards, equal texts together."""
    from .sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=16)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find benchmark passages in all documents."""
    from .decontaminate import digest, find_items

    return digest(find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a similarity of 0.8 or more."""
    from .ngram_join import components

    return components(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by compression distance."""
    from .toxicity import fit_on, score

    documents = table(spark, sf_dir, "documents")
    return score(documents, fit_on(documents, table(spark, sf_dir, "labels")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations and repair them at least cost."""
    from .repair import report

    return report(table(spark, sf_dir, "conversations"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw documents whose word runs are distributed like those of the benchmark's items."""
    from .importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, seed=42)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove word runs of 50 or more that an earlier document holds."""
    from .substrings import keep_first

    return keep_first(table(spark, sf_dir, "documents")).drop("kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from . import chat, url_filter

    return {"op2_chat_format": chat.SQL, "op3_url_filter": url_filter.SQL}
