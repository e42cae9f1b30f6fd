"""Order-dependent operators on intervals and sequences, as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwright.session import tasks_of, written


def gap_sessions(df: DataFrame, time: str, gap, keys: list[str], order: list[str], name: str = "session") -> DataFrame:
    """A session number from 0 within ``keys``; a new session begins where the gap to the row before is
    over ``gap``."""
    w = Window.partitionBy(*keys).orderBy(time, *order)
    new = F.coalesce((F.col(time) - F.lag(time).over(w) > gap).cast("long"), F.lit(0).cast("long"))
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def _before(df: DataFrame, order: list[str], value: Column, name: str, keys: tuple[str, ...], fold, joined) -> DataFrame:
    """``fold`` of ``value`` over the rows before, in the order of all rows (of the same ``keys``). Rows are dealt by ranges of keys
    and order and folded within each, and ``joined`` adds what the ranges before hold, so no task sorts all rows or all of a
    key. ``keys`` and ``order`` must tell rows apart; other columns go along, so keep them few."""
    dealt = written(df.withColumn("_v", value).repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    held = dealt.groupBy("_range", *keys).agg(fold("_v").alias("_held"))  # a row for each range and for each key
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(F.col("_range").alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], fold("_held").over(earlier).alias("_before"))
    on = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    within = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    folded = dealt.withColumn("_within", fold("_v").over(within))
    return folded.join(held, on).withColumn(name, joined(F.col("_within"), F.col("_before"))).select(*df.columns, name)


def sum_before(df: DataFrame, order: list[str], value: Column, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """What ``value`` adds up to over the rows before; see ``_before``."""
    return _before(df, order, value, name, keys, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def max_before(df: DataFrame, order: list[str], value: Column, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The largest ``value`` (a struct, say) of the rows before, null where there is none; see ``_before``."""
    return _before(df, order, value, name, keys, F.max, lambda a, b: F.when(a.isNull() | (b > a), b).otherwise(a))


def segments(df: DataFrame, keys: tuple[str, ...], order: list[str], value: Column, opens, name: str = "_segment") -> DataFrame:
    """Rows with a ``_row`` that tells them apart and the number of their segment, from 1, within ``keys``. A segment begins where
    ``opens``, a function of the largest ``value`` of the rows before, is true (or null). A key's rows are handled in many tasks."""
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    seen = max_before(rows, [*order, "_row"], value, "_seen", keys)
    marked = seen.withColumn("_new", F.coalesce(opens(F.col("_seen")), F.lit(True)).cast("long")).drop("_seen")
    return sum_before(marked, [*order, "_row"], F.col("_new"), name, keys).withColumn(name, F.col(name) + F.col("_new")).drop("_new")


def place_in_order(df: DataFrame, order: list[str], name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The place of every row, from 1, in the order of all rows (of the same ``keys``); see ``sum_before``."""
    return sum_before(df, order, F.lit(1).cast("long"), name, keys).withColumn(name, (F.col(name) + 1).cast("long"))


def interval_union(df: DataFrame, start: str, end: str, keys: list[str], touching: bool = True, slack=0) -> DataFrame:
    """Unions of overlapping intervals; with ``touching`` equal ends merge, with ``slack`` gaps below it do."""
    df = df.repartition(tasks_of(df), *keys)
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.col(start) > before + slack if touching else F.col(start) >= before + slack
    marked = df.withColumn("_new", F.coalesce(apart.cast("long"), F.lit(0).cast("long")))
    numbered = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_run")


def overlapping_windows(start: Column, end: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` from ``start`` on, each beginning ``overlap`` before the last one's end, the last one
    clipped: an array of (start, end). One window if all fits."""
    step = size - overlap
    # the last begin is the first whose window reaches the end
    n = F.greatest(F.lit(0), F.ceil((end - start - size) / step)).cast("long")
    return F.transform(F.sequence(F.lit(0).cast("long"), n), lambda i: F.struct((start + i * step).alias("start"), F.least(start + i * step + size, end).alias("end")))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], tolerance=None) -> DataFrame:
    """Each left row with the last right row at or before its time (of equal times the largest values), if
    it is not older than ``tolerance``. One union and one window; no range join."""
    l = left.select(*[F.col(k) for k in keys], F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(right.select(F.struct(right_time, *values)).schema[0].dataType).alias("_r"))
    r = right.select(*[F.col(k) for k in keys], F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), F.struct(right_time, *values).alias("_r"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side", F.col("_r")).rowsBetween(Window.unboundedPreceding, 0)
    hit = l.unionByName(r).withColumn("_hit", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    near = F.col("_t") - F.col(f"_hit.{right_time}") <= tolerance if tolerance is not None else F.lit(True)
    return hit.select("_l.*", *[F.when(near, F.col(f"_hit.{c}")).alias(f"{c}_asof" if c in left.columns else c) for c in [right_time, *values]])


def fill_both_ways(value: str, keys: list[str], order: list[str]) -> Column:
    """The last known value, else the next one, else 0."""
    w = Window.partitionBy(*keys).orderBy(*order)
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(back, ahead, F.lit(0))


def around(df: DataFrame, keys: list[str], order: list[str], anchor: Column, k: int) -> DataFrame:
    """Rows within ``k`` rows of an anchor row; overlapping surroundings have one ``block``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("_a", anchor.cast("int")).withColumn("_near", F.max("_a").over(w.rowsBetween(-k, k)))
    new = (F.col("_near") == 1) & (F.coalesce(F.lag("_near").over(w), F.lit(0)) == 0)
    return rows.withColumn("_new", new.cast("long")).withColumn("block", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_near = 1").drop("_a", "_near", "_new")


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= n).drop("_k")
