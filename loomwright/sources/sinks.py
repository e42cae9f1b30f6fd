"""Writers: JSON Lines, replacement of a table, event logs, numbered batches, corpus with manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, drop: tuple[str, ...] = ()) -> None:
    df.drop(*drop).write.mode("overwrite").json(path)


def replace_table(df: DataFrame, path: str, stamp: str) -> str:
    """Write a new version beside the old one; readers change over by the returned path. Spark's commit
    protocol makes the version appear whole or not at all."""
    target = f"{path}/version={stamp}"
    df.write.mode("errorifexists").parquet(target)
    return target


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_batches(df: DataFrame, path: str, batch: str) -> None:
    df.write.mode("overwrite").partitionBy(batch).json(path)


def manifest(df: DataFrame, key: str, group: str) -> DataFrame:
    """Rows and an order-free digest of each group: the sum of row hashes, so nothing is gathered."""
    h = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("ids"), F.sum(h).alias("digest"))


def markdown(df: DataFrame, order: list[str]) -> DataFrame:
    """A table (of rows that differ) as lines of a Markdown report: (place, line), with the head first."""
    from loomwright.operators.windows import place_in_order

    cells = lambda xs: F.concat(F.lit("| "), F.concat_ws(" | ", *xs), F.lit(" |"))
    shown = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in df.columns]
    body = place_in_order(df, [*order, *(c for c in df.columns if c not in order)], "_place").select((F.col("_place") + 2).alias("place"), cells(shown).alias("line"))
    head = [(1, "| " + " | ".join(df.columns) + " |"), (2, "|" + " --- |" * len(df.columns))]
    return df.sparkSession.createDataFrame(head, "place long, line string").unionByName(body)
