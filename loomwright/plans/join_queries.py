"""Queries of joins, aggregates, sorts, set operations and sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.operators import joins as J
from loomwright.operators import windows as W
from loomwright.session import tasks_of

from .registry import query
from .text_queries import LINES, lines
from .window_queries import EVENTS, events


@query("jn1_inner_lookup", "SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


@query("jn2_left_default", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN (SELECT doc_id, quality, row_number() OVER (PARTITION BY doc_id ORDER BY toxic, quality) AS k FROM labels) l ON d.doc_id = l.doc_id AND l.k = 1")
def _(t):
    return J.lookup(t.documents.select("doc_id"), t.labels, "doc_id", "quality", -1, ["toxic", "quality"])


@query("jn3_left_chain", "SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(t):
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.select("o_orderkey", "c_name", "n_name", "r_name")


@query("jn4_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _(t):
    return t.customer.select("c_custkey").join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("jn5_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left_anti")


@query("jn6_status_max", "SELECT l_partkey AS p, max(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END)::BIGINT AS status_rank, count(DISTINCT o_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey")
def _(t):
    rank = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0).cast("long")
    n = tasks_of(t.lineitem)
    lines_, orders = t.lineitem.select("l_partkey", "l_orderkey").repartition(n, "l_orderkey"), t.orders.select("o_orderkey", "o_orderstatus").repartition(n, "o_orderkey")
    j = lines_.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_partkey").alias("p"), "o_orderkey", rank.alias("r"))
    once = j.repartition(n, "p", "o_orderkey").groupBy("p", "o_orderkey").agg(F.max("r").alias("r"))
    return once.groupBy("p").agg(F.max("r").alias("status_rank"), F.count("o_orderkey").alias("n"))


@query("jn7_shared_entities", "SELECT a.item_id, b.doc_id, count(*) AS shared FROM (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS w FROM benchmark) a JOIN (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS w FROM documents) b ON a.w = b.w GROUP BY ALL")
def _(t):
    words = lambda df, k: df.select(k, F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), F.lit(0))).alias("w"))
    return J.sharing(words(t.benchmark, "item_id"), words(t.documents, "doc_id"), "item_id", "doc_id", "w")


@query(
    "jn8_theta_pairs",
    "WITH e AS (SELECT l_orderkey AS o, l_suppkey AS s FROM lineitem GROUP BY ALL), p AS (SELECT a.s AS s1, b.s AS s2, count(*) AS shared FROM e a JOIN e b ON a.o = b.o AND a.s < b.s GROUP BY ALL) SELECT s1, s2, shared FROM p WHERE shared >= 2",
)
def _(t):
    """Pairs of suppliers that share two orders or more, blocked on the order."""
    n = tasks_of(t.lineitem)
    e = t.lineitem.select(F.col("l_orderkey").alias("o"), F.col("l_suppkey").alias("s")).repartition(n, "o").distinct()
    pairs = e.withColumnRenamed("s", "s1").join(e.withColumnRenamed("s", "s2"), "o").where("s1 < s2").select("s1", "s2")
    # An order of few suppliers makes one or two pairs of a line.
    return pairs.repartition(3 * n, "s1", "s2").groupBy("s1", "s2").agg(F.count("*").alias("shared")).where("shared >= 2")


@query(
    "jn9_best_match",
    "WITH w AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS w FROM benchmark), d AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS w FROM documents), p AS (SELECT item_id, doc_id, count(*) AS shared FROM w JOIN d USING (w) GROUP BY ALL) SELECT item_id, doc_id, shared FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS k FROM p) WHERE k = 1",
)
def _(t):
    words = lambda df, k: df.select(k, F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), F.lit(0))).alias("w"))
    return J.first_of(J.sharing(words(t.benchmark, "item_id"), words(t.documents, "doc_id"), "item_id", "doc_id", "w"), ["item_id"], [F.desc("shared"), "doc_id"])


@query(
    "jn10_as_of",
    """WITH l AS (SELECT event_id, user_id, ts AS t FROM events WHERE event_type = 'purchase'), r AS (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY ALL)
       SELECT l.event_id, l.user_id, CASE WHEN l.t - r.ts <= INTERVAL 12 HOUR THEN r.view_id END AS view_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.t >= r.ts""",
)
def _(t):
    """Each purchase with the user's last view at or before it, at most 12 hours old."""
    e = t.events.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "us")
    right = e.where("event_type = 'view'").select("user_id", F.col("us").alias("at"), F.col("event_id").alias("view_id"))
    return W.as_of(left, right, ["user_id"], "us", "at", ["view_id"], 12 * 3600 * 10**6).select("event_id", "user_id", "view_id")


@query("jn12_range_slice", f"SELECT a.event_id, b.event_id AS other FROM ({EVENTS}) a JOIN ({EVENTS}) b ON a.user_id = b.user_id AND b.s BETWEEN a.s AND a.s + 3600 WHERE a.event_type = 'purchase'")
def _(t):
    e = events(t).select("event_id", "user_id", "s", "event_type")
    ranges = e.where("event_type = 'purchase'").select("event_id", "user_id", F.col("s").alias("lo"), (F.col("s") + 3600).alias("hi"))
    points = e.select("user_id", "s", F.col("event_id").alias("other"))
    return J.in_range(points, ranges, ["user_id"], "s", "lo", "hi", 3600).select("event_id", "other")


@query(
    "jn13_nearest_context",
    f"""WITH p AS (SELECT a.event_id, b.event_id AS other, abs(a.s - b.s) AS d FROM ({EVENTS}) a JOIN ({EVENTS}) b ON a.user_id = b.user_id AND b.event_id <> a.event_id AND b.s BETWEEN a.s - 86400 AND a.s + 86400 WHERE a.event_type = 'error')
        SELECT event_id, other, d FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, other) AS k FROM p) WHERE k <= 5""",
)
def _(t):
    """The five nearest events of the same user within a day."""
    e = events(t).select("event_id", "user_id", "s", "event_type")
    ranges = e.where("event_type = 'error'").select("event_id", "user_id", F.col("s").alias("c"), (F.col("s") - 86400).alias("lo"), (F.col("s") + 86400).alias("hi"))
    p = J.in_range(e.select("user_id", "s", F.col("event_id").alias("other")), ranges, ["user_id"], "s", "lo", "hi", 86400).where("other <> event_id")
    return W.top_per_group(p.select("event_id", "other", F.abs(F.col("s") - F.col("c")).alias("d")), ["event_id"], ["d", "other"], 5)


@query(
    "jn14_neighbours",
    f"WITH n AS (SELECT doc_id, line_no, line, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS rn FROM ({LINES})) SELECT a.doc_id, a.line_no::BIGINT AS hit, b.line_no::BIGINT AS line_no FROM n a JOIN n b ON a.doc_id = b.doc_id AND b.rn BETWEEN a.rn - 1 AND a.rn + 1 WHERE contains(a.line, 'license')",
)
def _(t):
    """Lines one before to one after each hit."""
    n = lines(t)
    hits = n.where(F.contains("line", F.lit("license"))).select("doc_id", F.col("line_no").alias("hit")).withColumn("line_no", F.explode(F.array(*[F.col("hit") + d for d in (-1, 0, 1)])))
    return hits.join(n.select("doc_id", "line_no"), ["doc_id", "line_no"]).select("doc_id", "hit", "line_no")


@query(
    "jn15_contiguous_slice",
    f"WITH b AS (SELECT user_id, min(event_id) AS lo, max(event_id) AS hi FROM events WHERE event_type = 'error' GROUP BY user_id) SELECT e.user_id, count(*) AS between_n FROM events e JOIN b ON e.user_id = b.user_id AND e.event_id BETWEEN lo AND hi GROUP BY e.user_id",
)
def _(t):
    b = t.events.where("event_type = 'error'").groupBy("user_id").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    return t.events.select("user_id", "event_id").join(b, "user_id").where("event_id between lo and hi").groupBy("user_id").agg(F.count("*").alias("between_n"))


@query(
    "jn16_window_overlap",
    f"""WITH a AS (SELECT DISTINCT s // 3600 AS old_w, user_id FROM ({EVENTS}) WHERE event_type = 'click'), b AS (SELECT DISTINCT s // 7200 AS new_w, user_id, s // 3600 AS h FROM ({EVENTS}) WHERE event_type = 'view')
        SELECT DISTINCT a.old_w, a.user_id, coalesce(b.new_w, -1) AS new_w FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.old_w = b.h""",
)
def _(t):
    """Old windows with the new ones that share a user and an hour; -1 where none does."""
    hour, two = F.floor(F.col("s") / 3600).cast("long"), F.floor(F.col("s") / 7200).cast("long")
    a = events(t).where("event_type = 'click'").select(hour.alias("old_w"), "user_id").distinct()
    b = events(t).where("event_type = 'view'").select(two.alias("new_w"), "user_id", hour.alias("old_w")).distinct()
    return a.join(b, ["user_id", "old_w"], "left").select("old_w", "user_id", F.coalesce("new_w", F.lit(-1).cast("long")).alias("new_w")).distinct()


@query("jn17_fallback_lookup", "WITH x AS (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY 1), y AS (SELECT lower(p_type) AS a, min(p_partkey) AS k FROM part GROUP BY 1) SELECT p.p_partkey, coalesce(x.k, y.k) AS found FROM part p LEFT JOIN x ON x.p_name = p.p_type LEFT JOIN y ON y.a = lower(p.p_type)")
def _(t):
    """By exact name, else by alias."""
    x = t.part.groupBy(F.col("p_name").alias("n")).agg(F.min("p_partkey").alias("x"))
    y = t.part.groupBy(F.lower("p_type").alias("a")).agg(F.min("p_partkey").alias("y"))
    return t.part.join(x, F.col("p_type") == F.col("n"), "left").join(y, F.lower("p_type") == F.col("a"), "left").select("p_partkey", F.coalesce("x", "y").alias("found"))


@query(
    "jn18_supersede",
    "WITH r AS (SELECT doc_id FROM labels WHERE quality = 0), n AS (SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM r) UNION ALL SELECT doc_id + 1000000, 'new' FROM r) SELECT lang, count(*) AS n FROM n GROUP BY lang",
)
def _(t):
    """Replaced documents leave, their replacements enter; counts by kind."""
    r = t.labels.where("quality = 0").select("doc_id")
    new = t.documents.select("doc_id", "lang").join(r, "doc_id", "left_anti").unionByName(r.select((F.col("doc_id") + 1000000).alias("doc_id"), F.lit("new").alias("lang")))
    return new.groupBy("lang").agg(F.count("*").alias("n"))


@query("jn19_counterparts", "SELECT k, list_sort(list(DISTINCT v)) AS counterparts FROM (SELECT o_custkey AS k, o_orderkey AS v FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders) GROUP BY k")
def _(t):
    both = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v")).unionByName(t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")))
    return both.groupBy("k").agg(F.sort_array(F.collect_set("v")).alias("counterparts"))


# --- aggregates ------------------------------------------------------------------------------------


@query("agg1_grouping_sets", "SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), ())")
def _(t):
    return t.documents.groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.count("*").alias("n")).select("lang", "source", "n")


@query("agg2_most_common", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL ORDER BY n DESC, event_type, user_id LIMIT 20")
def _(t):
    return t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type", "user_id").limit(20)


@query("agg3_count_distinct", "SELECT source, count(DISTINCT text) AS texts, count(DISTINCT lang) AS langs FROM documents GROUP BY source")
def _(t):
    return t.documents.groupBy("source").agg(F.countDistinct("text").alias("texts"), F.countDistinct("lang").alias("langs"))


@query("agg4_percentiles", "SELECT lang, quantile_cont(n_chars, 0.25) AS p25, quantile_cont(n_chars, 0.5) AS p50, quantile_cont(n_chars, 0.75) AS p75, quantile_cont(n_chars, 0.9) AS p90, round(avg(n_chars), 2) AS mean, count(*) FILTER (n_chars > 1000) AS over_1000 FROM documents GROUP BY lang")
def _(t):
    return t.documents.groupBy("lang").agg(*[F.percentile("n_chars", p).alias(n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9))], F.round(F.avg("n_chars"), 2).alias("mean"), F.count_if(F.col("n_chars") > 1000).alias("over_1000"))


@query("agg5_nested_counts", "SELECT user_id, list({'kind': event_type, 'n': n, 'first': f} ORDER BY event_type) AS kinds FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL) GROUP BY user_id")
def _(t):
    g = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("f"))
    return g.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(F.col("event_type").alias("kind"), "n", F.col("f").alias("first")))).alias("kinds"))


@query("agg6_status_by_rank", "SELECT o_custkey, arg_max(o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END) AS status FROM orders GROUP BY o_custkey")
def _(t):
    rank = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderstatus", rank).alias("status"))


@query("agg7_best_by_min_rank", "SELECT o_custkey, min(o_orderpriority) AS best FROM orders GROUP BY o_custkey")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderpriority").alias("best"))


@query("agg8_ordered_distinct", "SELECT l_orderkey, list(l_partkey ORDER BY o) AS parts FROM (SELECT l_orderkey, l_partkey, min((l_linenumber, l_partkey)) AS o FROM lineitem GROUP BY ALL) GROUP BY l_orderkey")
def _(t):
    first = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.min("l_linenumber").alias("o"))
    return first.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "l_partkey"))), lambda s: s["l_partkey"]).alias("parts"))


@query("agg9_filtered_ratio", "SELECT user_id, round(count(*) FILTER (event_type = 'purchase') / count(*), 4) AS share FROM events GROUP BY user_id HAVING count(*) >= 50")
def _(t):
    return t.events.groupBy("user_id").agg(F.round(F.count_if(F.col("event_type") == "purchase") / F.count("*"), 4).alias("share"), F.count("*").alias("n")).where("n >= 50").drop("n")


@query("agg10_argmax_share", "WITH g AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, event_type, round(n / total, 4) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY user_id) AS total, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM g) WHERE k = 1")
def _(t):
    g = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("user_id")))
    return W.top_per_group(g, ["user_id"], [F.desc("n"), "event_type"], 1).select("user_id", "event_type", F.round(F.col("n") / F.col("total"), 4).alias("share"))


@query("agg11_month_top3", "SELECT month, user_id, n FROM (SELECT date_trunc('month', ts)::DATE AS month, user_id, count(*) AS n, row_number() OVER (PARTITION BY date_trunc('month', ts) ORDER BY count(*) DESC, user_id) AS k, sum(count(*)) OVER (PARTITION BY date_trunc('month', ts)) AS total FROM events GROUP BY 1, 2, date_trunc('month', ts)) WHERE k <= 3 AND total >= 50")
def _(t):
    g = t.events.groupBy(F.to_date(F.date_trunc("month", F.col("ts"))).alias("month"), "user_id").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy("month")))
    return W.top_per_group(g.where("total >= 50"), ["month"], [F.desc("n"), "user_id"], 3).drop("total")


@query("agg12_literal_histogram", "SELECT num, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS num FROM documents) GROUP BY num HAVING count(*) >= 2")
def _(t):
    """Numbers in texts by the documents that hold them."""
    n = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("num")).distinct()
    return n.groupBy("num").agg(F.count("*").alias("docs")).where("docs >= 2")


@query("agg13_duration_ratio", "SELECT l_returnflag, sum(l_quantity) AS total, round(CASE WHEN sum(l_quantity) > 0 THEN sum(l_quantity) FILTER (l_linestatus = 'O') / sum(l_quantity) END, 4) AS share FROM lineitem GROUP BY l_returnflag")
def _(t):
    total = F.sum("l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(total.alias("total"), F.round(F.when(total > 0, F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))) / total), 4).alias("share"))


@query("agg14_usage_ledger", "SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS calls, round(sum(value), 4) AS units, max(ts) - min(ts) > INTERVAL 10 MINUTE AS spread FROM events GROUP BY ALL")
def _(t):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    g = t.events.groupBy("event_type", F.date_trunc("hour", F.col("ts")).alias("hour")).agg(F.count("*").alias("calls"), F.round(F.sum("value"), 4).alias("units"), (F.max(us) - F.min(us) > 600 * 10**6).alias("spread"))
    return g.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("agg15_cross_tab", "SELECT lang, count(*) FILTER (quality = 1 AND toxic = 0) AS good, count(*) FILTER (quality = 0 AND toxic = 0) AS poor, count(*) FILTER (toxic = 1) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY CUBE (lang)")
def _(t):
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    q, x = F.col("quality"), F.col("toxic")
    return j.cube("lang").agg(F.count_if((q == 1) & (x == 0)).alias("good"), F.count_if((q == 0) & (x == 0)).alias("poor"), F.count_if(x == 1).alias("toxic"))


# --- sorts, limits, sets -----------------------------------------------------------------------------


@query("srt1_stable_sort", f"SELECT event_id, row_number() OVER (ORDER BY s, event_id) AS place FROM ({EVENTS})")
def _(t):
    """The place of every event by time, ties by id."""
    return W.place_in_order(events(t).select("s", "event_id"), ["s", "event_id"], "place").select("event_id", "place")


@query("top1_top_k", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 0 ORDER BY n_chars DESC, doc_id LIMIT 25")
def _(t):
    return t.documents.where("n_chars > 0").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(25)


@query("top2_group_quota", "SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k <= 2 OR source = 'src0' ORDER BY n_chars DESC, doc_id LIMIT 30")
def _(t):
    """At most two of a source, but all of the exempt one; then the top 30."""
    k = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id"))
    return t.documents.select("doc_id", "source", "n_chars", k.alias("k")).where("k <= 2 or source = 'src0'").drop("k").orderBy(F.desc("n_chars"), "doc_id").limit(30)


@query("top3_links_cap", "WITH e AS (SELECT l_partkey AS a, l_suppkey AS b, sum(l_quantity) AS w FROM lineitem GROUP BY ALL), x AS (SELECT a AS node, b AS other, w, 'out' AS way FROM e UNION ALL SELECT b, a, w, 'in' FROM e) SELECT node, other, way FROM (SELECT *, row_number() OVER (PARTITION BY node, way ORDER BY w DESC, other) AS k FROM x) WHERE k <= 8")
def _(t):
    """The eight strongest links of each node, either way."""
    e = t.lineitem.groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.sum("l_quantity").alias("w"))
    x = e.select(F.col("a").alias("node"), F.col("b").alias("other"), "w", F.lit("out").alias("way")).unionByName(e.select(F.col("b").alias("node"), F.col("a").alias("other"), "w", F.lit("in").alias("way")))
    return W.top_per_group(x, ["node", "way"], [F.desc("w"), "other"], 8).drop("w")


@query("top4_context_budget", "SELECT doc_id, left(text, (3000 - coalesce(before, 0))::INT) AS part FROM (SELECT *, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM documents) WHERE coalesce(before, 0) < 3000")
def _(t):
    """Blocks of a source until 3000 characters; the last one is cut. Lengths are summed up first, without the texts."""
    lengths = t.documents.select("doc_id", "source", F.length("text").alias("n"))
    fits = W.sum_before(lengths, ["doc_id"], F.coalesce("n", F.lit(0)).cast("long"), "before", ("source",)).where("before < 3000").select("doc_id", "before")
    return t.documents.select("doc_id", "text").join(fits, "doc_id").select("doc_id", F.substring("text", F.lit(1), (3000 - F.col("before")).cast("int")).alias("part"))


@query("set1_union_duplicates", "SELECT id, count(*) AS n FROM (SELECT doc_id AS id FROM documents UNION ALL SELECT item_id FROM benchmark) GROUP BY id HAVING count(*) > 1")
def _(t):
    return t.documents.select(F.col("doc_id").alias("id")).unionByName(t.benchmark.select(F.col("item_id").alias("id"))).groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


@query("set2_membership", "SELECT 'both' AS side, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'left', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'right', count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def _(t):
    a, b = t.documents.select("doc_id"), t.labels.select("doc_id")
    n = lambda side, df: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return n("both", a.intersect(b)).unionByName(n("left", a.subtract(b))).unionByName(n("right", b.subtract(a)))


@query("set3_last_wins", "SELECT user_id, arg_max(event_type, event_id) AS last_type, min(event_id) AS first_place FROM events GROUP BY user_id")
def _(t):
    """The last value at the first place."""
    return t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"), F.min("event_id").alias("first_place"))


@query(
    "set4_claim_dedupe",
    """WITH k AS (SELECT doc_id, source, regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', '', 'g') AS claim, CASE lang WHEN 'en' THEN 2 WHEN 'de' THEN 1 ELSE 0 END AS r FROM documents),
       n AS (SELECT *, row_number() OVER (PARTITION BY claim ORDER BY r DESC, doc_id) AS rn FROM k)
       SELECT min(doc_id) FILTER (rn = 1) AS doc_id, coalesce(list_sort(list(doc_id) FILTER (rn > 1)), []) AS also_from FROM n GROUP BY claim""",
)
def _(t):
    """One document of each normalised text: the highest rank, of equal ones the first; the others' ids stay."""
    from loomwright.functions.text import normal

    rank = F.when(F.col("lang") == "en", 2).when(F.col("lang") == "de", 1).otherwise(0)
    k = t.documents.select("doc_id", F.xxhash64(normal(F.col("text"))).alias("h"), F.sha2(normal(F.col("text")), 256).alias("claim"), rank.alias("r"))
    g = k.groupBy("claim").agg(F.sort_array(F.collect_list(F.struct((-F.col("r")).alias("r"), "doc_id"))).alias("a"))
    ids = F.transform("a", lambda s: s["doc_id"])
    return g.select(F.element_at(ids, 1).alias("doc_id"), F.array_sort(F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))).alias("also_from"))


@query("set6_quote_dedupe", "SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, text ORDER BY turn) AS k FROM conversations) WHERE k = 1")
def _(t):
    return J.first_of(t.conversations.select("conv_id", "turn", "text"), ["conv_id", "text"], ["turn"])


@query("set7_append_batch", "SELECT doc_id, lang FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id, source FROM documents d WHERE doc_id % 3 = 0 AND NOT EXISTS (SELECT 1 FROM documents e WHERE e.doc_id = d.doc_id AND e.doc_id % 7 <> 0)")
def _(t):
    """A batch is appended only where its ids are new: of every third id, those divisible by 7."""
    old, batch = t.documents.where("doc_id % 7 <> 0").select("doc_id", "lang"), t.documents.where("doc_id % 3 = 0").select("doc_id", F.col("source").alias("lang"))
    return old.unionByName(batch.join(old, "doc_id", "left_anti"))


# --- sources and sinks -------------------------------------------------------------------------------


@query("src5_timestamped_lines", f"SELECT event_id, (s % 3600) AS t_sec, event_type AS label FROM ({EVENTS}) WHERE event_id % 5 <> 0")
def _(t):
    """Lines such as ``[MM:SS] label`` as seconds and label; other lines are dropped."""
    from loomwright.sources.transcripts import parse_lines

    stamp = F.format_string("[%02d:%02d] %s", F.floor(F.col("s") % 3600 / 60).cast("long"), F.col("s") % 60, F.col("event_type"))
    text = events(t).select("event_id", F.when(F.col("event_id") % 5 == 0, "# a header").otherwise(stamp).alias("line"))
    return parse_lines(text, "line").select("event_id", "t_sec", "label")


@query("src6_hour_lines", f"SELECT event_id, s % 86400 AS t_sec, event_type AS label FROM ({EVENTS})")
def _(t):
    """The same with hours, which may be left out."""
    from loomwright.functions.text import hms
    from loomwright.sources.transcripts import parse_lines

    text = events(t).select("event_id", F.concat(F.lit("["), hms(F.col("s") % 86400), F.lit("] "), "event_type").alias("line"))
    return parse_lines(text, "line").select("event_id", "t_sec", "label")


@query("src9_later_wins", "SELECT id, v, src FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o DESC) AS k FROM (SELECT doc_id AS id, lang AS v, 'documents' AS src, 0 AS o FROM documents UNION ALL SELECT doc_id, quality::VARCHAR, 'labels', 1 FROM labels)) WHERE k = 1")
def _(t):
    a = t.documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("v"), F.lit("documents").alias("src"), F.lit(0).alias("o"))
    b = t.labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("v"), F.lit("labels").alias("src"), F.lit(1).alias("o"))
    return J.first_of(a.unionByName(b), ["id"], [F.desc("o")]).drop("o")


@query("snk4_numbered_batches", "SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS batch FROM orders")
def _(t):
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t.orders.select("o_custkey", "o_orderkey", F.floor((n - 1) / 4).cast("long").alias("batch"))


@query("snk5_manifest", "SELECT source, count(*) AS n, sum(('0x' || sha256(doc_id::VARCHAR || ':' || text)[1:15])::BIGINT)::VARCHAR AS digest FROM documents GROUP BY source")
def _(t):
    """Counts and a digest of each source: rows are hashed and the hashes added, so nothing is gathered."""
    h = F.conv(F.left(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "text"), 256), F.lit(15)), 16, 10).cast("decimal(38,0)")
    return t.documents.groupBy("source").agg(F.count("*").alias("n"), F.sum(h).cast("string").alias("digest"))


@query("snk6_public_projection", "SELECT doc_id, lang, n_chars FROM documents")
def _(t):
    return t.documents.select("doc_id", "lang", "n_chars")
