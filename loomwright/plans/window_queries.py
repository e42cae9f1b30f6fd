"""Queries of window and segmentation operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.operators import windows as W

from .registry import query
from .text_queries import LINES, lines

EVENTS = "SELECT *, epoch_us(ts) // 1000000 AS s FROM events"


def events(t):
    """Events with seconds since the epoch."""
    return t.events.withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))


@query(
    "win1_fill_missing",
    f"""WITH e AS (SELECT event_id, user_id, s, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM ({EVENTS}))
        SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER w, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS filled
        FROM e WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(t):
    e = events(t).withColumn("v", F.when(F.col("event_id") % 3 == 0, F.col("value")))
    return e.select("event_id", W.fill_both_ways("v", ["user_id"], ["s", "event_id"]).alias("filled"))


@query(
    "win2_flood",
    f"SELECT event_id, coalesce(event_type = lag(event_type) OVER w AND length(event_type) >= 4, false) AS flood FROM ({EVENTS}) WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)",
)
def _(t):
    """The same user repeats the row before."""
    w = Window.partitionBy("user_id").orderBy("s", "event_id")
    return events(t).select("event_id", F.coalesce((F.col("event_type") == F.lag("event_type").over(w)) & (F.length("event_type") >= 4), F.lit(False)).alias("flood"))


@query("win3_out_of_order", "SELECT user_id, count(*) FILTER (ts < prev) AS out_of_order FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY value, event_id) AS prev FROM events) GROUP BY user_id")
def _(t):
    """Rows older than the row before, in an order by value."""
    prev = F.lag("ts").over(Window.partitionBy("user_id").orderBy("value", "event_id"))
    return t.events.select("user_id", "ts", prev.alias("prev")).groupBy("user_id").agg(F.count_if(F.col("ts") < F.col("prev")).alias("out_of_order"))


@query("win4_inversion_flag", "SELECT user_id, coalesce(bool_or(ts < prev), false) AS inverted FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events) GROUP BY user_id")
def _(t):
    prev = F.lag("ts").over(Window.partitionBy("user_id").orderBy("event_id"))
    return t.events.select("user_id", "ts", prev.alias("prev")).groupBy("user_id").agg(F.coalesce(F.bool_or(F.col("ts") < F.col("prev")), F.lit(False)).alias("inverted"))


@query(
    "win5_gap_session",
    f"""WITH e AS (SELECT *, coalesce((s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) > 28800)::BIGINT, 0) AS new FROM ({EVENTS})),
        n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS session FROM e)
        SELECT user_id, session::BIGINT AS session, count(*) AS n, min(s) AS first_s, max(s) AS last_s FROM n GROUP BY user_id, session""",
)
def _(t):
    s = W.gap_sessions(events(t), "s", 28800, ["user_id"], ["event_id"])
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("s").alias("first_s"), F.max("s").alias("last_s"))


_IV = "SELECT l_orderkey AS k, epoch_us(l_shipdate) // 86400000000 AS a, epoch_us(l_shipdate) // 86400000000 + l_quantity::BIGINT AS b FROM lineitem"


def _intervals(t):
    a = F.floor(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) / 86400).cast("long")
    return t.lineitem.select(F.col("l_orderkey").alias("k"), a.alias("a"), (a + F.col("l_quantity").cast("long")).alias("b"))


def _union_sql(apart: str) -> str:
    return f"""WITH i AS ({_IV}), m AS (SELECT *, coalesce(({apart.format(prev='max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')})::BIGINT, 0) AS new FROM i),
        r AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM m)
        SELECT k, min(a) AS a, max(b) AS b, count(*) AS n FROM r GROUP BY k, run"""


@query("win6_interval_union", _union_sql("a > {prev}"))
def _(t):
    return W.interval_union(_intervals(t), "a", "b", ["k"])


@query("win7_segment_merge", _union_sql("a >= {prev} + 8"))
def _(t):
    """Segments less than 8 apart merge; the end is the largest."""
    return W.interval_union(_intervals(t), "a", "b", ["k"], touching=False, slack=8)


@query(
    "win8_clip_cut",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, 0.0::DOUBLE AS a, l_quantity AS b FROM lineitem),
       c AS (SELECT *, unnest(range(0, greatest(0, ceil((b - a - 25) / 24.6))::BIGINT + 1)) AS i FROM s)
       SELECT l_orderkey, l_linenumber, l_partkey, i, round(a + i * 24.6, 2) AS clip_start, round(least(a + i * 24.6 + 25, b), 2) AS clip_end FROM c WHERE least(a + i * 24.6 + 25, b) - (a + i * 24.6) >= 0.5""",
)
def _(t):
    """Segments over 25 are cut with an overlap of 0.4; pieces below 0.5 go."""
    a, b = F.lit(0.0), F.col("l_quantity")
    n = F.greatest(F.lit(0), F.ceil((b - a - 25) / 24.6)).cast("long")
    c = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", b, F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("i"))
    start = a + F.col("i") * 24.6
    end = F.least(start + 25, F.col("l_quantity"))
    return c.where(end - start >= 0.5).select("l_orderkey", "l_linenumber", "l_partkey", "i", F.round(start, 2).alias("clip_start"), F.round(end, 2).alias("clip_end"))


@query("win9_tumbling", f"SELECT s // 240 AS bucket, count(*) AS n, sum(event_id)::BIGINT AS ids FROM ({EVENTS}) GROUP BY s // 240")
def _(t):
    return events(t).groupBy(F.floor(F.col("s") / 240).cast("long").alias("bucket")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    "win10_overlapping_windows",
    """WITH d AS (SELECT doc_id, 0::BIGINT AS a, n_chars AS b FROM documents), w AS (SELECT doc_id, a, b, unnest(range(0, greatest(0, ceil((b - a - 600) / 540.0))::BIGINT + 1)) AS i FROM d)
       SELECT doc_id, i, a + i * 540 AS win_start, least(a + i * 540 + 600, b) AS win_end FROM w""",
)
def _(t):
    """Windows of 600 characters that overlap by 60."""
    w = t.documents.select("doc_id", F.posexplode(W.overlapping_windows(F.lit(0).cast("long"), F.col("n_chars"), 600, 60)).alias("i", "w"))
    return w.select("doc_id", F.col("i").cast("long").alias("i"), F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"))


@query(
    "win12_snap_boundaries",
    """WITH c AS (SELECT conv_id, turn, turn * 10 + turn % 3 AS b FROM conversations), g AS (SELECT DISTINCT conv_id, turn * 11 AS t FROM conversations),
       n AS (SELECT c.conv_id, c.turn, arg_min(t, abs(t - b) * 1000000 + t) AS e FROM c JOIN g ON c.conv_id = g.conv_id GROUP BY c.conv_id, c.turn)
       SELECT * FROM (SELECT conv_id, turn, coalesce(lag(e) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS seg_start, e AS seg_end FROM n) WHERE seg_end > seg_start""",
)
def _(t):
    """Segment ends snap to the nearest grid time (the earlier of two), starts to the end before; empty
    segments go."""
    c = t.conversations.select("conv_id", "turn", (F.col("turn") * 10 + F.col("turn") % 3).alias("b"))
    g = t.conversations.select("conv_id", (F.col("turn") * 11).alias("t")).distinct()
    # The last grid time up to an end, and the first from it on.
    n = W.as_of(c, g, ["conv_id"], "b", "t", []).withColumn("_b", -F.col("b"))
    n = W.as_of(n, g.select("conv_id", (-F.col("t")).alias("_t_after")), ["conv_id"], "_b", "_t_after", []).withColumn("after", -F.col("_t_after"))
    near = F.when(F.col("t").isNull() | (F.col("after") - F.col("b") < F.col("b") - F.col("t")), F.col("after")).otherwise(F.col("t"))
    n = n.select("conv_id", "turn", near.alias("e"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    s = n.select("conv_id", "turn", F.coalesce(F.lag("e").over(w), F.lit(0).cast("long")).alias("seg_start"), F.col("e").alias("seg_end"))
    return s.where("seg_end > seg_start")


@query(
    "win13_around_anchor",
    f"""WITH e AS (SELECT *, max((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM ({EVENTS})),
        f AS (SELECT *, (near = 1 AND coalesce(lag(near) OVER (PARTITION BY user_id ORDER BY s, event_id), 0) = 0)::BIGINT AS new FROM e),
        g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS block FROM f)
        SELECT user_id, block::BIGINT AS block, count(*) AS n, min(event_id) AS first_id FROM g WHERE near = 1 GROUP BY user_id, block""",
)
def _(t):
    a = W.around(events(t), ["user_id"], ["s", "event_id"], F.col("event_type") == "purchase", 2)
    return a.groupBy("user_id", "block").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(
    "win15_window_tiers",
    f"""WITH w AS (SELECT user_id, s // 86400 AS day, count(*) AS n, count(DISTINCT event_type) * CASE WHEN bool_or(event_type = 'purchase') THEN 2 ELSE 1 END AS score FROM ({EVENTS}) GROUP BY ALL)
        SELECT user_id, day, n, score::BIGINT AS score, CASE WHEN n < 2 THEN 'C' WHEN score >= 4 THEN 'A' WHEN score >= 2 THEN 'B' ELSE 'C' END AS tier FROM w""",
)
def _(t):
    w = events(t).groupBy("user_id", F.floor(F.col("s") / 86400).cast("long").alias("day")).agg(F.count("*").alias("n"), (F.countDistinct("event_type") * F.when(F.bool_or(F.col("event_type") == "purchase"), 2).otherwise(1)).cast("long").alias("score"))
    return w.withColumn("tier", F.when(F.col("n") < 2, "C").when(F.col("score") >= 4, "A").when(F.col("score") >= 2, "B").otherwise("C"))


@query("win16_sequential_ids", "SELECT o_orderkey, o_custkey, printf('w%06d', row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS window_id FROM orders")
def _(t):
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey", F.format_string("w%06d", n).alias("window_id"))


@query("win17_rank_in_group", "SELECT lang, doc_id, k FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY n_chars DESC, source DESC, doc_id) AS k FROM documents) WHERE k <= 3")
def _(t):
    k = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("n_chars"), F.desc("source"), "doc_id"))
    return t.documents.select("lang", "doc_id", k.cast("long").alias("k")).where("k <= 3")


@query("win18_quartile_bands", "SELECT doc_id, (4 * rn - 1) // n AS band FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n FROM documents)")
def _(t):
    """Quarters of a source by length."""
    placed = W.place_in_order(t.documents.select("doc_id", "source", "n_chars"), ["n_chars", "doc_id"], "rn", ("source",))
    n = t.documents.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n"))
    j = placed.join(n, F.col("source").eqNullSafe(F.col("s")))
    return j.select("doc_id", F.floor((4 * F.col("rn") - 1) / F.col("n")).cast("long").alias("band"))


@query("win19_target_rank", "SELECT user_id, event_type, n, rank() OVER (PARTITION BY user_id ORDER BY n DESC) AS r FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)")
def _(t):
    n = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.rank().over(Window.partitionBy("user_id").orderBy(F.desc("n"))).cast("long"))


@query(
    "win20_marker_injection",
    """WITH m AS (SELECT o_custkey AS k, o_orderkey, o_orderdate AS t FROM orders WHERE o_orderpriority = '1-URGENT'), l AS (SELECT o_custkey AS k, o_orderkey AS line, o_orderdate AS t FROM orders)
       SELECT m.k, m.o_orderkey, arg_min(l.line, (l.t, l.line)) AS before_line FROM m LEFT JOIN l ON m.k = l.k AND l.t > m.t GROUP BY m.k, m.o_orderkey""",
)
def _(t):
    """Each marker before the first line of its key that is later."""
    o = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_orderdate").alias("t"), "o_orderpriority")
    o = o.withColumn("us", F.unix_micros(F.col("t").cast("timestamp"))).withColumn("n", F.min(F.struct("t", "o_orderkey")).over(Window.partitionBy("k").orderBy("us").rangeBetween(1, Window.unboundedFollowing)))
    return o.where("o_orderpriority = '1-URGENT'").select("k", "o_orderkey", F.col("n.o_orderkey").alias("before_line"))


@query(
    "win21_hit_runs",
    f"""WITH h AS (SELECT doc_id, line_no FROM ({LINES}) WHERE contains(line, 'the')), m AS (SELECT *, coalesce((line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) > 2)::BIGINT, 0) AS new FROM h),
        r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS run FROM m)
        SELECT doc_id, run::BIGINT AS run, greatest(1, min(line_no) - 1)::BIGINT AS first_line, (max(line_no) + 1)::BIGINT AS last_line, (count(*) * 3 * 20 + count(*))::BIGINT AS score FROM r GROUP BY doc_id, run""",
)
def _(t):
    """Lines with a term, joined if at most 2 lines apart, with a line of context."""
    h = W.gap_sessions(lines(t).where(F.contains("line", F.lit("the"))).select("doc_id", "line_no"), "line_no", 2, ["doc_id"], [], "run")
    return h.groupBy("doc_id", "run").agg(F.greatest(F.lit(1).cast("long"), F.min("line_no") - 1).alias("first_line"), (F.max("line_no") + 1).alias("last_line"), (F.count("*") * 3 * 20 + F.count("*")).alias("score"))


@query(
    "win22_best_anchor_crop",
    f"""WITH l AS ({LINES}), b AS (SELECT doc_id, arg_max(line_no, length(line) * 100000 - line_no) AS best FROM l GROUP BY doc_id) SELECT l.doc_id, l.line_no::BIGINT AS line_no FROM l JOIN b ON l.doc_id = b.doc_id WHERE l.line_no BETWEEN b.best - 2 AND b.best + 2""",
)
def _(t):
    """The lines around each document's longest line (the first of equal ones)."""
    w = Window.partitionBy("doc_id")
    l = lines(t).withColumn("best", F.max(F.struct(F.length("line").alias("n"), (-F.col("line_no")).alias("p"))).over(w))
    return l.where(F.abs(F.col("line_no") + F.col("best.p")) <= 2).select("doc_id", "line_no")


@query("win23_drift_flag", "SELECT l_orderkey, sum(l_quantity) AS parts, max(l_linenumber)::DOUBLE * 25 AS whole, abs(sum(l_quantity) - max(l_linenumber) * 25) <= 2.0 AS close FROM lineitem GROUP BY l_orderkey")
def _(t):
    parts, whole = F.sum("l_quantity"), F.max("l_linenumber") * 25.0
    return t.lineitem.groupBy("l_orderkey").agg(parts.alias("parts"), whole.alias("whole"), (F.abs(parts - whole) <= 2.0).alias("close"))
