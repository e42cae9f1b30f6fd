"""Redaction and leak scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHAPES = {"mail": r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "secret": r"(?:password|token|key)=[0-9a-f]{8,}", "phone": r"\+[0-9]{2}[ -][0-9 -]{6,}"}


def redact_known(df: DataFrame, ids: DataFrame, key: str, text: str, known: str, mask: str = "<id>") -> DataFrame:
    """Texts with every digit run that equals a known id masked; an id inside a longer run stays."""
    runs = df.select(key, F.posexplode(F.regexp_extract_all(text, F.lit("[0-9]+|[^0-9]+"), F.lit(0))).alias("i", "x"))
    j = runs.join(ids.select(F.col(known).alias("_k")), F.col("x") == F.col("_k"), "left")
    part = F.struct("i", F.when(F.col("_k").isNotNull(), F.lit(mask)).otherwise(F.col("x")).alias("x"))
    return j.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda s: s["x"]), "").alias("redacted"))


def scrub_shapes(c: Column) -> Column:
    """What looks like an address, a secret's value, a phone number or a long number is masked."""
    c = F.regexp_replace(c, SHAPES["mail"], "<mail>")
    c = F.regexp_replace(c, r"(?<=(?:password|token|key)=)[0-9a-f]{8,}", "<secret>")
    c = F.regexp_replace(c, SHAPES["phone"], "<phone>")
    return F.regexp_replace(c, r"(?<![0-9])[0-9]{7,}(?![0-9])", "<number>")


def leaks(df: DataFrame, key: str, text: str) -> DataFrame:
    """All hits of the shapes: (key, kind, hit)."""
    def hits(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("hit")))

    return df.select(key, F.explode(F.concat(*[hits(k, p) for k, p in SHAPES.items()])).alias("f")).select(key, "f.kind", "f.hit")
