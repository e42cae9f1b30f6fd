"""All strings in nested JSON, walked level by level as VARIANT rows: no Python, and no row holds more than one value's children."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.session import written


def json_strings(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """(``keys``, path, value) for each string of a JSON column: ``$`` for the whole, then ``.key`` and ``[place]``.

    Nulls and texts that are no JSON have no strings; numbers, booleans and nulls inside are left out, empty objects and arrays
    have nothing. Repeated rows are walked each; a key that comes twice in an object is Spark's to refuse (such a text has no
    strings). Each level is stored, as deep as the deepest value goes."""
    spark = df.sparkSession
    level = written(df.select(*keys, F.lit("$").alias("path"), F.try_parse_json(json).alias("v")).where("v is not null"), "level")
    found = []
    while True:
        kind = F.schema_of_variant("v")
        found.append(level.where(kind == "STRING").select(*keys, "path", F.col("v").cast("string").alias("value")))
        inner = level.where(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        child = spark.tvf.variant_explode(F.col("v").outer()).toDF("_pos", "_key", "_v")
        step = F.when(F.col("_key").isNotNull(), F.concat(F.lit("."), "_key")).otherwise(F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")))
        level = written(inner.lateralJoin(child).select(*keys, F.concat("path", step).alias("path"), F.col("_v").alias("v")), "level")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)
