"""Queries of operators that SQL cannot express: folds, difflib, ordered rules, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwright.functions import sequential as S
from loomwright.operators import folds
from loomwright.operators.graph import connected_components
from loomwright.operators.joins import first_of
from loomwright.operators.nested import json_strings
from loomwright.session import spread

from .registry import query
from .text_queries import lines
from .window_queries import events

@query("tx13_ratio")
def _(t):
    return spread(t.part).select("p_partkey", F.round(S.ratio(F.lower("p_name"), F.lower("p_type")), 6).alias("ratio"))


@query("tx14_edit_breakdown")
def _(t):
    return spread(t.part).select("p_partkey", S.edits(F.lower("p_name"), F.lower("p_type")).alias("e")).select("p_partkey", "e.*")


@query("tx20_json_strings", "SELECT doc_id, path, value FROM (SELECT doc_id, '$.meta.lang' AS path, lang AS value FROM documents UNION ALL SELECT doc_id, '$.meta.parts[0]', source FROM documents UNION ALL SELECT doc_id, '$.meta.parts[1].lines[' || i || ']', x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(length(text) + 1)) AS i FROM documents)) WHERE value IS NOT NULL")
def _(t):
    """All strings of documents as nested JSON (language, source, and an object with all lines)."""
    lines_ = F.to_json(F.struct(F.split("text", "\n").alias("lines")))
    pair = F.concat(F.rtrim(F.to_json(F.array("source")), F.lit("]")), F.lit(","), lines_, F.lit("]"))
    nested = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"meta":{"parts":'), pair, F.lit(","), F.substring(F.to_json(F.struct("lang")), 2, 1 << 30), F.lit("}"))
    return json_strings(t.documents.select("doc_id", nested.alias("j")), ["doc_id"], "j")


@query("win11_line_merge")
def _(t):
    """Lines of a document as cues of a second for each 20 characters."""
    cues = lines(t).where("length(line) > 0").withColumn("start", F.col("line_no") * 2.0).withColumn("end", F.col("line_no") * 2.0 + F.length("line") / 20)
    return folds.merge_lines(cues, "doc_id", "start", "end", "line")


@query("win14_anchor_fragments")
def _(t):
    e = events(t).withColumn("anchor", F.col("event_type") == "purchase")
    return folds.anchor_fragments(e, "user_id", "event_id", "s", "anchor", slack=3, gap=86400)


@query("jn11_nearest_unused")
def _(t):
    e = events(t)
    left = e.where("event_type = 'purchase'").select("user_id", "s", F.col("event_id").alias("purchase_id"))
    right = e.where("event_type = 'view'").select("user_id", "s", F.col("event_id").alias("view_id"))
    return folds.match_nearest(left, right, "user_id", "s", "purchase_id", "view_id", 43200)


@query("set5_contained_dedupe")
def _(t):
    """Whole texts as quotes, by the topic key of their first 24 characters."""
    q = t.documents.select(F.substring("text", 1, 24).alias("topic"), "doc_id", F.col("text").alias("quote"))
    return folds.contained_dedupe(q, "topic", "doc_id", "quote").select("doc_id", "topic")


@query("sm6_category_cover")
def _(t):
    x = t.events.groupBy((F.col("user_id") % 10).alias("batch"), "user_id").agg(F.collect_set("event_type").alias("kinds"))
    return folds.cover_categories(x, "batch", "user_id", "kinds", 3)


def _cards(t):
    words = F.array_distinct(F.split(F.lower("p_name"), " "))
    return t.part.select("p_brand", "p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("text"), F.array_union(words, F.split("p_type", " ")).alias("items"))


@query("gr2_duplicate_clusters")
def _(t):
    """Pairs that share two items and are similar in text; their components; one canonical member each."""
    cc = connected_components(folds.similar_links(_cards(t), "p_brand", "p_partkey", "text", "items", 2, 0.6))
    members = cc.join(t.part.select(F.col("p_partkey").alias("node"), "p_retailprice"), "node")
    return first_of(members, ["component"], [F.desc("p_retailprice"), "node"]).select("component", F.col("node").alias("canonical"))


@query("gr4_pack_clusters")
def _(t):
    """Pairs that share two items or are similar in text, within a category."""
    return connected_components(folds.similar_links(_cards(t), "p_brand", "p_partkey", "text", "items", 2, 0.5, either=True))


@query("sx28_mark_near_duplicates")
def _(t):
    """Each card's most similar smaller one of its brand, and whether it counts as a duplicate."""
    best = folds.nearest_before(_cards(t), "p_brand", "p_partkey", "text", "items", 2, 0.0)
    return best.select(F.col("id").alias("p_partkey"), "nearest", (F.col("ratio") > 0.6).alias("duplicate"))


@query("ex3_run_variance", "SELECT event_type, count(*) AS runs, round(stddev_pop(m), 6) AS spread FROM (SELECT event_type, event_id % 5 AS run, avg(value) AS m FROM events GROUP BY ALL) GROUP BY event_type")
def _(t):
    """Spread of a measure over repeated runs (here five splits of the events)."""
    g = t.events.groupBy("event_type", (F.col("event_id") % 5).alias("run")).agg(F.avg("value").alias("m"))
    return g.groupBy("event_type").agg(F.count("*").alias("runs"), F.round(F.stddev_pop("m"), 6).alias("spread"))


@query("win5_session_window", "WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 8 HOUR, true)::INT AS new FROM events), r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM r GROUP BY user_id, k")
def _(t):
    """Sessions by the engine's own session window; the same function runs on a stream."""
    from loomwright.streaming.sessions import session_counts

    s = session_counts(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "user_id", "8 hours", "1 day")
    return s.select("user_id", F.unix_micros("start").alias("start_us"), "n")
