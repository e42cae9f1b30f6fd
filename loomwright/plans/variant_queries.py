"""Queries of smaller operators and variants."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.functions import sequential as S
from loomwright.functions import text as T
from loomwright.operators import joins as J
from loomwright.operators.containment import held_quotes
from loomwright.operators import windows as W

from .registry import query
from .text_queries import LINES, lines


@query("sx6_nested_assembly", "SELECT o_custkey, list({'order': o_orderkey, 'status': o_orderstatus} ORDER BY o_orderkey) AS examples, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_custkey")
def _(t):
    o = t.orders.where("o_totalprice > 100000")
    return o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("order"), F.col("o_orderstatus").alias("status")))).alias("examples"), F.count("*").alias("n"))


@query("sx9_entry_ids", "SELECT conv_id, turn, 'c' || conv_id || '#r' || turn AS entry_id, left(sha1('c' || conv_id || '|' || turn), 8) AS short_id FROM conversations")
def _(t):
    c = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    return t.conversations.select("conv_id", "turn", F.concat(c, F.lit("#r"), F.col("turn").cast("string")).alias("entry_id"), T.short_hash(c, F.col("turn"), n=8).alias("short_id"))


@query(
    "sx14_citation_cascade",
    """WITH n AS (SELECT p_name AS k, min(p_partkey) AS id FROM part GROUP BY 1 HAVING count(*) = 1), ty AS (SELECT p_type AS k, min(p_partkey) AS id FROM part GROUP BY 1 HAVING count(*) = 1), b AS (SELECT p_brand AS k, min(p_partkey) AS id FROM part GROUP BY 1 HAVING count(*) = 1)
       SELECT p.p_partkey, coalesce(n.id, ty.id, b.id) AS resolved FROM part p LEFT JOIN n ON p.p_name = n.k LEFT JOIN ty ON p.p_type = ty.k LEFT JOIN b ON p.p_brand = b.k""",
)
def _(t):
    """By name, else type, else brand; a key that is not unique resolves nothing."""

    def unique(c, name):
        return t.part.groupBy(F.col(c).alias(f"{name}_k")).agg(F.min("p_partkey").alias(name), F.count("*").alias("c")).where("c = 1").drop("c")

    j = t.part
    for c, name in (("p_name", "n"), ("p_type", "y"), ("p_brand", "b")):
        j = j.join(unique(c, name), F.col(c) == F.col(f"{name}_k"), "left")
    return j.select("p_partkey", F.coalesce("n", "y", "b").alias("resolved"))


@query("sx15_three_way_split", "SELECT o_custkey, coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (o_orderstatus = 'F'), '') AS affirmed, coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (o_orderstatus = 'O'), '') AS demoted, count(*) FILTER (o_orderstatus = 'P') AS gated FROM orders GROUP BY o_custkey")
def _(t):
    def ids(status):
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("o_orderstatus") == status, F.col("o_orderkey")))), lambda x: x.cast("string")), ",")

    return t.orders.groupBy("o_custkey").agg(ids("F").alias("affirmed"), ids("O").alias("demoted"), F.count_if(F.col("o_orderstatus") == "P").alias("gated"))


@query("sx17_prefix_tolerant_hits", "SELECT p_partkey, EXISTS (SELECT 1 FROM (VALUES ('STEEL'), ('TIN'), ('BRASS')) g(x) WHERE ends_with(p_type, x)) AS hit FROM part")
def _(t):
    return t.part.select("p_partkey", F.exists(F.array(*map(F.lit, ("STEEL", "TIN", "BRASS"))), lambda x: F.endswith(F.col("p_type"), x)).alias("hit"))


@query("sx19_packet_membership", f"WITH l AS (SELECT x.*, source, lang FROM ({LINES}) x JOIN documents USING (doc_id)) SELECT doc_id, line_no::BIGINT AS line_no FROM l WHERE lang <> 'en' AND NOT EXISTS (SELECT 1 FROM l p WHERE p.lang = 'en' AND p.source = l.source AND p.line = l.line)")
def _(t):
    """Evidence lines (of documents in other languages) that are no line of their source's packet (its English documents)."""
    l = t.documents.select("doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("p", "line"))  # noqa: E741
    packet = l.where("lang = 'en'").select("source", "line").distinct()
    return l.where("lang <> 'en'").join(packet, ["source", "line"], "left_anti").select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"))


@query("sx21_cache_seed", "SELECT doc_id, lag(doc_id) OVER (PARTITION BY source, n_chars ORDER BY doc_id) AS seeded_from FROM documents QUALIFY seeded_from IS NOT NULL")
def _(t):
    """A cached answer may be used where the context and its length agree: that of the nearest row before."""
    a = t.documents.select("doc_id", "source", "n_chars")
    return W.max_before(a, ["doc_id"], F.col("doc_id"), "seeded_from", ("source", "n_chars")).where("seeded_from is not null").select("doc_id", "seeded_from")


@query("sx22_feedback", "SELECT d.doc_id, CASE WHEN toxic = 1 THEN 'archived' ELSE coalesce('q' || quality, 'same') END AS state, sha256(text) AS digest FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    """Rows patched or archived by feedback; the digest shows that others stay as they are."""
    j = t.documents.join(t.labels, "doc_id", "left")
    return j.select("doc_id", F.when(F.col("toxic") == 1, "archived").otherwise(F.coalesce(F.concat(F.lit("q"), F.col("quality").cast("string")), F.lit("same"))).alias("state"), F.sha2("text", 256).alias("digest"))


@query("sx24_rebuild_documents", "SELECT 'part:' || p_partkey AS id, 'part' AS doc_type, p_name AS text FROM part UNION ALL SELECT 'segment:' || c_mktsegment, 'segment', c_mktsegment FROM (SELECT DISTINCT c_mktsegment FROM customer) UNION ALL SELECT 'nation:' || n_nationkey, 'nation', n_name FROM nation")
def _(t):
    d = lambda df, key, ty, text: df.select(F.concat(F.lit(f"{ty}:"), F.col(key).cast("string")).alias("id"), F.lit(ty).alias("doc_type"), F.col(text).alias("text"))
    return d(t.part, "p_partkey", "part", "p_name").unionByName(d(t.customer.select("c_mktsegment").distinct(), "c_mktsegment", "segment", "c_mktsegment")).unionByName(d(t.nation, "n_nationkey", "nation", "n_name"))


@query("sx26_entry_trace", "WITH n AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[0-9]+')) AS x, source || lang || n_chars AS blob FROM documents) SELECT doc_id, len(list_filter(x, lambda v: NOT contains(blob, v)))::BIGINT AS untraced, len(list_filter(x, lambda v: NOT contains(blob, v))) > 3 AS rejected FROM n")
def _(t):
    """Values that no source blob holds; over three reject the entry."""
    blob = F.concat("source", "lang", F.col("n_chars").cast("string"))
    n = t.documents.select("doc_id", F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("x"), blob.alias("blob"))
    lost = F.size(F.filter("x", lambda v: ~F.contains(F.col("blob"), v)))
    return n.select("doc_id", lost.cast("long").alias("untraced"), (lost > 3).alias("rejected"))


@query("sx27_credibility_map", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' ELSE 'medium' END AS credibility FROM orders")
def _(t):
    m = F.create_map(*[F.lit(x) for x in ("1-URGENT", "high", "2-HIGH", "high", "5-LOW", "low")])
    return t.orders.select("o_orderkey", F.coalesce(F.try_element_at(m, F.col("o_orderpriority")), F.lit("medium")).alias("credibility"))


@query("sx29_related_top3", "WITH s AS (SELECT n_nationkey, c_custkey, (c_acctbal > 0)::BIGINT * 2 + (c_mktsegment = 'BUILDING')::BIGINT AS score FROM nation JOIN customer ON n_nationkey = c_nationkey) SELECT n_nationkey, c_custkey, score FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY score DESC, c_custkey) AS k FROM s) WHERE k <= 3")
def _(t):
    score = (F.col("c_acctbal") > 0).cast("long") * 2 + (F.col("c_mktsegment") == "BUILDING").cast("long")
    s = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey")).select("n_nationkey", "c_custkey", score.alias("score"))
    return W.top_per_group(s, ["n_nationkey"], [F.desc("score"), "c_custkey"], 3)


@query("sx30_review_selection", "SELECT name, n, 'frequent' AS why FROM (SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1) WHERE n >= 2 UNION ALL SELECT p_type, count(DISTINCT p_brand), 'collision' FROM part GROUP BY p_type HAVING count(DISTINCT p_brand) > 1")
def _(t):
    a = t.part.groupBy(F.col("p_name").alias("name")).agg(F.count("*").alias("n")).where("n >= 2").withColumn("why", F.lit("frequent"))
    b = t.part.groupBy(F.col("p_type").alias("name")).agg(F.countDistinct("p_brand").alias("n")).where("n > 1").withColumn("why", F.lit("collision"))
    return a.unionByName(b)


@query("sx31_search_terms", "SELECT p_partkey, w AS term, k FROM (SELECT p_partkey, w, row_number() OVER (PARTITION BY p_partkey ORDER BY length(w) DESC, w) AS k FROM (SELECT DISTINCT p_partkey, unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS w FROM part) WHERE length(w) >= 3 AND w NOT IN ('the', 'tin')) WHERE k <= 3")
def _(t):
    """Terms of a card, longest first, without stop words."""
    w = t.part.select("p_partkey", F.explode(F.array_distinct(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " "))).alias("term")).where("length(term) >= 3 and term not in ('the', 'tin')")
    k = F.row_number().over(Window.partitionBy("p_partkey").orderBy(F.desc(F.length("term")), "term"))
    return w.withColumn("k", k.cast("long")).where("k <= 3")


@query("sx33_contained_source_first", "WITH h AS (SELECT item_id, d.doc_id, d.source = 'src0' AS own FROM benchmark b JOIN documents d ON contains(d.text, b.text)) SELECT item_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY own DESC, doc_id) AS k FROM h) WHERE k = 1")
def _(t):
    """Containment in the preferred source, else anywhere."""
    h = held_quotes(t.documents, ["doc_id", "source"], "text", t.benchmark.select("item_id", "text"), "text").select("item_id", "doc_id", (F.col("source") == "src0").alias("own"))
    return J.first_of(h, ["item_id"], [F.desc("own"), "doc_id"]).select("item_id", "doc_id")


@query("sx36_render_evidence", f"SELECT doc_id, string_agg('- ' || left(line, 40), chr(10) ORDER BY line_no) AS rendered FROM ({LINES}) WHERE line_no <= 3 GROUP BY doc_id")
def _(t):
    l = lines(t).where("line_no <= 3").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("a"))
    return l.select("doc_id", F.array_join(F.transform("a", lambda s: F.concat(F.lit("- "), F.substring(s["line"], 1, 40))), "\n").alias("rendered"))


@query("sx38_frozen_sync", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN {'value': 'F', 'prior': o_orderstatus} ELSE {'value': o_orderstatus, 'prior': NULL} END AS frozen FROM orders")
def _(t):
    """A fixed value is synchronised and its prior value kept."""
    big = F.col("o_totalprice") > 200000
    return t.orders.select("o_orderkey", F.struct(F.when(big, "F").otherwise(F.col("o_orderstatus")).alias("value"), F.when(big, F.col("o_orderstatus")).alias("prior")).alias("frozen"))


@query("tx19_rebuild_text", f"SELECT doc_id, string_agg(line, chr(10) ORDER BY contains(line, 'license'), line_no) AS rebuilt FROM ({LINES}) GROUP BY doc_id")
def _(t):
    """Gated lines move to the end, in order."""
    l = lines(t).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.contains("line", F.lit("license")).alias("gated"), "line_no", "line"))).alias("a"))
    return l.select("doc_id", F.array_join(F.transform("a", lambda s: s["line"]), "\n").alias("rebuilt"))


@query("sx1_pack_rows", "SELECT c.conv_id, c.turn, CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'answer' ELSE role END AS doc_type, coalesce(l.quality, -1) AS novelty, CASE WHEN toxic = 1 THEN 'open' ELSE 'none' END AS conflict FROM conversations c LEFT JOIN labels l ON c.conv_id = l.doc_id")
def _(t):
    role = F.when(F.col("role") == "user", "question").when(F.col("role") == "assistant", "answer").otherwise(F.col("role"))
    j = t.conversations.join(t.labels, F.col("conv_id") == F.col("doc_id"), "left")
    return j.select("conv_id", "turn", role.alias("doc_type"), F.coalesce("quality", F.lit(-1)).alias("novelty"), F.when(F.col("toxic") == 1, "open").otherwise("none").alias("conflict"))


@query("sx40_declared_targets", "SELECT user_id, regexp_extract(props, '\"(\\w+)\"', 1) AS target, round(sum(value), 4) AS weight FROM events GROUP BY ALL")
def _(t):
    return t.events.groupBy("user_id", F.regexp_extract("props", r'"(\w+)"', 1).alias("target")).agg(F.round(F.sum("value"), 4).alias("weight"))


@query("sx43_run_manifest", "SELECT 'documents' AS name, count(*) AS n, sum(n_chars)::BIGINT AS size FROM documents UNION ALL SELECT 'pages', count(*), sum(length(html))::BIGINT FROM pages UNION ALL SELECT 'conversations', count(*), sum(length(text))::BIGINT FROM conversations")
def _(t):
    m = lambda name, df, c: df.agg(F.count("*").alias("n"), F.sum(c).cast("long").alias("size")).select(F.lit(name).alias("name"), "n", "size")
    return m("documents", t.documents, F.col("n_chars")).unionByName(m("pages", t.pages, F.length("html"))).unionByName(m("conversations", t.conversations, F.length("text")))
