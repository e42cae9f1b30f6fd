"""Readers: JSON Lines, nested JSON, chat CSV, timestamped text, JSON values in a row, many files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE = r"^\s*\[(?:([0-9]{1,2}):)?([0-9]{1,3}):([0-9]{2})\]\s*(.*)$"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines with a stated schema; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_nested(spark: SparkSession, path: str, schema: str, array: str) -> DataFrame:
    """Whole JSON files with an array each: one row for each element, with its place."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.posexplode(array).alias("pos", "item")).select(*rest, "pos", "item.*")


def read_chat_csv(spark: SparkSession, path: str, columns: list[str], file: str | None = None) -> DataFrame:
    """CSV with quoted line feeds and perhaps a byte order mark; columns are renamed in order, times parsed
    (null and a flag where they can't be). ``file``: the name of a column for the path of a row's file."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    names = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, columns)]
    df = df.select(*names, *([F.col("_metadata.file_path").alias(file)] if file else []))
    ts = F.try_to_timestamp("sent_at", F.lit("yyyy-MM-dd HH:mm:ss"))
    return df.withColumn("ts", F.unix_timestamp(ts)).withColumn("bad_time", ts.isNull())


def chat_csv_stats(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """By file: logical rows, physical lines (with the head), rows without an id, and rows earlier than the last valid
    time before them. A file with quoted line feeds is read by one task, so its order is that of the file."""
    rows = read_chat_csv(spark, path, columns, "file").withColumn("_nth", F.monotonically_increasing_id())
    before = Window.partitionBy("file").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    late = F.col("ts") < F.last("ts", ignorenulls=True).over(before)
    empty = F.coalesce(F.trim(columns[0]), F.lit("")) == ""
    logical = rows.withColumn("_late", late).groupBy("file").agg(F.count("*").alias("logical"), F.count_if(empty).alias("empty_ids"), F.count_if("_late").alias("out_of_order"))
    physical = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("physical"))
    return physical.join(logical, "file", "left").na.fill(0)


def new_until_known(df: DataFrame, keys: list[str], order: list[str], known: str, run: int) -> DataFrame:
    """Rows of a listing that are not known, up to where ``run`` known ones in a row have come; by ``keys``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ended = F.count_if(F.col(known)).over(w.rowsBetween(1 - run, 0)) == run
    stopped = F.coalesce(F.max(F.col("_run")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    return df.withColumn("_run", ended).withColumn("_stopped", stopped).where(~F.col("_stopped") & ~F.col(known)).drop("_run", "_stopped")


def parse_lines(df: DataFrame, column: str) -> DataFrame:
    """Rows of ``[MM:SS] text`` or ``[HH:MM:SS] text``: seconds and label; other rows are dropped."""
    part = lambda i: F.regexp_extract(column, LINE, i)
    hours = F.coalesce(F.nullif(part(1), F.lit("")).cast("long"), F.lit(0))
    return df.where(F.col(column).rlike(LINE)).withColumn("t_sec", hours * 3600 + part(2).cast("long") * 60 + part(3).cast("long")).withColumn("label", part(4))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Timestamped text files: stem, t_sec, label."""
    df = spark.read.text(path).withColumn("stem", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1))
    return parse_lines(df, "value").select("stem", "t_sec", "label")


def read_json_values(spark: SparkSession, path: str) -> DataFrame:
    """Files of JSON values written one after the other, with line feeds inside strings: one row for each."""
    schema = "path string, pos int, value string"

    def run(batches):
        import json

        import pandas as pd

        decoder = json.JSONDecoder(strict=False)
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"]):
                text, at, n = content.decode("utf-8-sig"), 0, 0
                while True:
                    while at < len(text) and text[at].isspace():
                        at += 1
                    if at >= len(text):
                        break
                    value, at = decoder.raw_decode(text, at)
                    rows.append((name, n, json.dumps(value, ensure_ascii=False, sort_keys=True)))
                    n += 1
            yield pd.DataFrame(rows, columns=["path", "pos", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def read_many(spark: SparkSession, path: str, schema: str, exclude: str | None = None, stem: str = r"([^/.]*)[^/]*$") -> DataFrame:
    """All JSON Lines files of a pattern, with their stem (what ``stem`` captures of the path); stems that match
    ``exclude`` are left out."""
    df = spark.read.schema(schema).json(path).withColumn("stem", F.regexp_extract(F.col("_metadata.file_path"), stem, 1))
    return df.where(~F.col("stem").rlike(exclude)) if exclude else df


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """Lines by file that are no JSON."""
    df = spark.read.text(path).where(F.trim("value") != "")
    return df.where(F.try_parse_json("value").isNull()).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("bad_lines"))
