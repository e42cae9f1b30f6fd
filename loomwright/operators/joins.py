"""Join shapes beyond plain equi-joins, composed of equi-joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key: the first by ``order``."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def lookup(left: DataFrame, right: DataFrame, on: str, column: str, default, order: list) -> DataFrame:
    """Left join to the first right row of each key, with a default for misses."""
    one = first_of(right, [on], order).select(on, column)
    return left.join(one, on, "left").withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def sharing(a: DataFrame, b: DataFrame, a_id: str, b_id: str, key: str) -> DataFrame:
    """Pairs of rows of two exploded tables that share at least one key, with the number of keys shared."""
    return a.select(a_id, key).distinct().join(b.select(b_id, key).distinct(), key).groupBy(a_id, b_id).agg(F.count("*").alias("shared"))


def in_range(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, low: str, high: str, width: int) -> DataFrame:
    """Points joined to the closed ranges that hold them. Ranges are exploded to bins of ``width``, so the join
    is an equi-join on keys and bin, and each pair is found in the point's bin only."""
    p = points.withColumn("_bin", F.floor(F.col(at) / width).cast("long"))
    r = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long"))))
    return p.join(r, [*keys, "_bin"]).where(F.col(at).between(F.col(low), F.col(high))).drop("_bin")




def overlap_near(quotes: DataFrame, lines: DataFrame, quote_id: str, source: str, at: str, units: str, within: int) -> DataFrame:
    """(``quote_id``, overlap): the largest share of a quote's distinct units (an array) that one line of its source holds, of the lines at most
    ``within`` from its time. Both tables have ``source``, ``at`` and ``units``. Quotes without units, source, time or such a line are left
    out; repeated rows change nothing. Lines meet the quotes of their time bins only."""
    own = F.array_distinct(F.array_compact(F.col(units)))
    asked = quotes.where(F.col(at).isNotNull()).select(quote_id, F.col(source).alias("_s"), (F.col(at) - within).alias("_low"), (F.col(at) + within).alias("_high"), own.alias("_units")).where(F.size("_units") > 0)
    points = lines.select(F.col(source).alias("_s"), F.col(at).alias("_at"), F.col(units).alias("_held"))
    met = in_range(points, asked, ["_s"], "_at", "_low", "_high", 2 * within + 1)
    return met.groupBy(quote_id).agg(F.max(F.size(F.array_intersect("_units", "_held")) / F.size("_units")).alias("overlap")).where("overlap is not null")
