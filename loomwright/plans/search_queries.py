"""Queries of retrieval, linking, entities and graphs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.operators import joins as J
from loomwright.operators import retrieval as R
from loomwright.operators import windows as W
from loomwright.operators.containment import held_quotes
from loomwright.operators.graph import connected_components
from loomwright.operators.index import Index
from loomwright.operators.nearest import nearest_cosine

from .registry import query

WORDS = "license password stating of the worthless theory"


def _tok(src: str, key: str, c: str) -> str:
    """Rows (key, term) of bigram tokens in DuckDB."""
    return rf"""(SELECT {key}, ch || lead(ch) OVER (PARTITION BY {key} ORDER BY i) AS term, ch, i FROM (SELECT {key}, unnest(cs) AS ch, generate_subscripts(cs, 1) AS i FROM
        (SELECT {key}, regexp_extract_all(regexp_replace({c}, '[ \t\n\x0b\f\r\x{{85}}\x{{a0}}\x{{3000}}]+', '', 'g'), '(?s).') AS cs FROM {src})))"""


def _bm25_sql(where: str = "", queries: str = f"SELECT 0 AS query, '{WORDS}' AS q") -> str:
    """The corpus has no ideographs, so tokens are pairs only here; ``ir1_tokens`` has both kinds."""
    return f"""
    p AS MATERIALIZED (SELECT doc_id AS doc, term FROM {_tok(f'(SELECT * FROM documents {where})', 'doc_id', 'text')} WHERE term IS NOT NULL),
    dls AS (SELECT doc, count(*) AS dl FROM p GROUP BY doc),
    st AS (SELECT (SELECT count(*) FROM documents {where}) AS n, (SELECT count(*) FROM p) / (SELECT count(*) FROM documents {where}) AS avgdl),
    qt AS (SELECT DISTINCT query, term FROM {_tok(f'({queries})', 'query', 'q')} WHERE term IS NOT NULL),
    tf AS (SELECT term, doc, dl, count(*) AS tf FROM p JOIN dls USING (doc) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    scored AS (SELECT query, doc, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM qt JOIN tf USING (term) JOIN df USING (term), st GROUP BY query, doc)"""


def _one(t):
    return t.spark.createDataFrame([(0, WORDS)], "query int, q string")


def _scored(t, docs=None):
    return R.bm25(t.documents if docs is None else docs, _one(t), "doc_id", "text", "query", "q")


@query("ir1_bm25_search", f"WITH {_bm25_sql()} SELECT doc, round(score * CASE WHEN source = 'src0' THEN 1.2 ELSE 1.0 END, 4) AS score FROM scored JOIN documents ON doc = doc_id ORDER BY score DESC, doc LIMIT 10")
def _(t):
    """The ten best documents of one query, source src0 boosted."""
    b = R.boosted(_scored(t), t.documents, "doc_id", F.when(F.col("source") == "src0", 1.2).otherwise(1.0))
    return b.orderBy(F.desc("score"), "doc").limit(10).select("doc", "score")


@query("ir1_tokens", rf"SELECT p_partkey, list(term ORDER BY k, i) AS tokens, count(*) AS n FROM (SELECT p_partkey, term, 0 AS k, i FROM {_tok('(SELECT p_partkey, p_name || chr(24103) || chr(29575) AS x FROM part)', 'p_partkey', 'x')} WHERE term IS NOT NULL UNION ALL SELECT p_partkey, ch, 1, i FROM {_tok('(SELECT p_partkey, p_name || chr(24103) || chr(29575) AS x FROM part)', 'p_partkey', 'x')} WHERE ch BETWEEN chr(19968) AND chr(40959)) GROUP BY p_partkey")
def _(t):
    """Tokens of names with two ideographs added."""
    x = F.concat("p_name", F.lit("帧率"))
    return t.part.select("p_partkey", T.bigrams(x).alias("tokens"), T.n_bigrams(x).cast("long").alias("n"))


@query("ir2_bm25_batch", f"WITH {_bm25_sql(queries='SELECT item_id AS query, text AS q FROM benchmark')} SELECT query, doc, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 4) DESC, doc) AS k FROM scored) WHERE k <= 5")
def _(t):
    """The five best documents for every benchmark item."""
    q = t.benchmark.select("item_id", F.col("text").alias("q"))
    s = R.bm25(t.documents, q, "doc_id", "text", "item_id", "q", best=5).withColumn("score", F.round("score", 4))
    return W.top_per_group(s, ["query"], [F.desc("score"), "doc"], 5)


_KEPT = "WHERE source <> 'src1'"


@query("ir2_stored_index", f"WITH {_bm25_sql(_KEPT, 'SELECT item_id AS query, text AS q FROM benchmark')} SELECT query, doc, round(score, 4) AS score, k::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 4) DESC, doc) AS k FROM scored) WHERE k <= 5")
def _(t):
    """The five best documents for every item, from a stored index: built of English texts, the others appended, one source deleted."""
    built = Index.build(t.documents.where("lang = 'en'"), "doc_id", "text").append(t.documents.where("lang <> 'en'"), "doc_id", "text")
    return built.delete(t.documents.where("source = 'src1'"), "doc_id").search(t.benchmark, "item_id", "text", 5)


@query("ir3_boost_falsy", f"WITH {_bm25_sql()} SELECT doc, round(score * coalesce(nullif(boost, 0), 1), 4) AS score FROM scored JOIN (SELECT doc_id, (doc_id % 3) / 2 AS boost FROM documents) ON doc = doc_id WHERE score > 0")
def _(t):
    """A boost of 0 or null means 1."""
    return R.boosted(_scored(t), t.documents, "doc_id", T.falsy((F.col("doc_id") % 3) / 2, 1.0)).select("doc", "score")


@query("ir4_filter_after", f"WITH {_bm25_sql()} SELECT doc, round(score, 4) AS score FROM scored JOIN documents ON doc = doc_id WHERE lang = 'en' AND source <> 'src0' ORDER BY score DESC, doc LIMIT 20")
def _(t):
    """Filters after scoring: document frequencies are those of all documents."""
    kept = t.documents.where("lang = 'en' and source <> 'src0'").select(F.col("doc_id").alias("doc"))
    return _scored(t).join(kept, "doc", "left_semi").select("doc", F.round("score", 4).alias("score")).orderBy(F.desc("score"), "doc").limit(20)


@query("ir5_filter_before", f"WITH {_bm25_sql(where=chr(87) + 'HERE lang = ' + repr('en'))} SELECT doc, round(score, 4) AS score FROM scored ORDER BY score DESC, doc LIMIT 20")
def _(t):
    """Filters before indexing: other document frequencies."""
    return _scored(t, t.documents.where("lang = 'en'")).select("doc", F.round("score", 4).alias("score")).orderBy(F.desc("score"), "doc").limit(20)


@query("ir6_query_expansion", "WITH a(alias, canonical) AS (VALUES ('MAIL', 'POSTAL'), ('AIR', 'FLIGHT'), ('BUILDING', 'HOUSE')) SELECT c_custkey, coalesce(canonical, c_mktsegment) || ' ' || n_name AS expanded FROM customer LEFT JOIN a ON c_mktsegment = alias JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    """Aliases replaced, entity names appended."""
    a = t.spark.createDataFrame([("MAIL", "POSTAL"), ("AIR", "FLIGHT"), ("BUILDING", "HOUSE")], "alias string, canonical string")
    j = t.customer.join(F.broadcast(a), F.col("c_mktsegment") == F.col("alias"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", F.concat_ws(" ", F.coalesce("canonical", "c_mktsegment"), "n_name").alias("expanded"))


@query(
    "ir7_link_score",
    """WITH w AS (SELECT doc_id, lang, list_distinct(regexp_extract_all(lower(text), '[a-z]{10,}')) AS e, contains(text, 'license')::BIGINT + contains(text, 'password')::BIGINT AS g FROM documents WHERE text IS NOT NULL),
       i AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{10,}')) AS e FROM benchmark),
       c AS (SELECT DISTINCT item_id, doc_id FROM (SELECT item_id, unnest(e) AS x FROM i) JOIN (SELECT doc_id, unnest(e) AS x FROM w) USING (x)),
       s AS (SELECT c.item_id, c.doc_id, 2 * len(list_intersect(i.e, w.e)) / len(list_distinct(list_concat(i.e, w.e))) + 0.5 * (lang = 'en')::INT + 0.3 * least(g, 3) + len(list_intersect(i.e, w.e)) / len(i.e) AS raw FROM c JOIN i USING (item_id) JOIN w USING (doc_id))
       SELECT item_id, doc_id, round(raw, 3) AS score FROM s WHERE raw >= 1.0""",
)
def _(t):
    """Documents and items that share a long word, by the additive link score."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{10,}"), F.lit(0)))
    w = t.documents.select("doc_id", "lang", words("text").alias("e"), (F.contains("text", F.lit("license")).cast("int") + F.contains("text", F.lit("password")).cast("int")).alias("g"))
    i = t.benchmark.select("item_id", words("text").alias("ie"))
    c = J.sharing(i.select("item_id", F.explode("ie").alias("x")), w.select("doc_id", F.explode("e").alias("x")), "item_id", "doc_id", "x").drop("shared")
    s = c.join(i, "item_id").join(w, "doc_id")
    raw = R.link_score(T.word_jaccard(F.col("ie"), F.col("e")), F.col("lang") == "en", F.col("g"), F.size(F.array_intersect("ie", "e")) / F.size("ie"))
    return s.select("item_id", "doc_id", raw.alias("raw")).where("raw >= 1.0").select("item_id", "doc_id", F.round("raw", 3).alias("score"))


@query("ir9_boost_rules", "SELECT doc_id, round(CASE source WHEN 'src0' THEN 1.2 WHEN 'src1' THEN 1.1 ELSE 1.0 END + CASE WHEN regexp_matches(text, '[0-9]') THEN 0.1 ELSE 0 END, 2)::DOUBLE AS boost FROM documents")
def _(t):
    base = F.when(F.col("source") == "src0", 1.2).when(F.col("source") == "src1", 1.1).otherwise(1.0)
    return t.documents.select("doc_id", F.round(base + F.when(F.col("text").rlike("[0-9]"), 0.1).otherwise(0.0), 2).alias("boost"))


@query("ir10_weight_product", "WITH a(k, w) AS (VALUES ('O', 0.8::DOUBLE), ('F', 1.0), ('P', 0.5)), b(p, c) AS (VALUES ('1-URGENT', 1.0::DOUBLE), ('2-HIGH', 0.9)) SELECT o_orderkey, round(coalesce(w, 0.5) * coalesce(c, 0.7) + 0.1, 3) AS weight FROM orders LEFT JOIN a ON o_orderstatus = k LEFT JOIN b ON o_orderpriority = p")
def _(t):
    a = F.broadcast(t.spark.createDataFrame([("O", 0.8), ("F", 1.0), ("P", 0.5)], "k string, w double"))
    b = F.broadcast(t.spark.createDataFrame([("1-URGENT", 1.0), ("2-HIGH", 0.9)], "p string, c double"))
    j = t.orders.join(a, F.col("o_orderstatus") == F.col("k"), "left").join(b, F.col("o_orderpriority") == F.col("p"), "left")
    return j.select("o_orderkey", F.round(F.coalesce("w", F.lit(0.5)) * F.coalesce("c", F.lit(0.7)) + 0.1, 3).alias("weight"))


_NEAR = """WITH m AS (SELECT user_id AS k, event_type AS d, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 3),
   f AS (SELECT d, 1 / ln(1 + count(*)) AS idf FROM m GROUP BY d), tot AS (SELECT k, sum(n) AS s FROM m GROUP BY k HAVING sum(n) >= 15 AND count(*) >= 3),
   v AS (SELECT m.k, m.d, n / s * idf AS w FROM m JOIN tot USING (k) JOIN f USING (d)), nm AS (SELECT k, sqrt(sum(w * w)) AS l FROM v GROUP BY k),
   p AS (SELECT a.k AS k, b.k AS other, sum(a.w * b.w) AS dot FROM v a JOIN v b ON a.d = b.d AND a.k <> b.k GROUP BY ALL),
   c AS (SELECT p.k, p.other, round(dot / (x.l * y.l), 6) AS cosine FROM p JOIN nm x ON p.k = x.k JOIN nm y ON p.other = y.k)
   SELECT k, other, cosine FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY cosine DESC, other) AS r FROM c) WHERE r = 1"""


@query("ir11_nearest_vector", _NEAR)
def _(t):
    """Pseudonymous keys by their IDF-weighted shares: the nearest other key by cosine."""
    m = t.events.groupBy(F.col("user_id").alias("k"), F.col("event_type").alias("d")).agg(F.count("*").alias("n")).where("n >= 3")
    f = m.groupBy("d").agg((1 / F.log(1 + F.count("*"))).alias("idf"))
    tot = m.groupBy("k").agg(F.sum("n").alias("s"), F.count("*").alias("c")).where("s >= 15 and c >= 3").select("k", "s")
    v = m.join(tot, "k").join(f, "d").groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("d", F.col("n") / F.col("s") * F.col("idf")))).alias("m"))
    kinds = sorted(r["d"] for r in f.select("d").limit(1_001).collect())
    if len(kinds) > 1_000:
        raise ValueError("more than 1,000 kinds of events: vectors of that length are not spelled out")
    whole = F.array(*[F.coalesce(F.element_at("m", F.lit(d)), F.lit(0.0)) for d in kinds])
    return nearest_cosine(v.select("k", whole.alias("v")), "k", "v")


@query("ir12_facets", "SELECT lang, source, count(*) AS n FROM documents WHERE contains(lower(text), 'license') GROUP BY ALL")
def _(t):
    return t.documents.where(F.contains(F.lower("text"), F.lit("license"))).groupBy("lang", "source").agg(F.count("*").alias("n"))


_TOP5 = f"{_bm25_sql(queries='SELECT item_id AS query, text AS q FROM benchmark')}, top AS (SELECT query, doc, row_number() OVER (PARTITION BY query ORDER BY round(score, 4) DESC, doc) AS k FROM scored), gold AS (SELECT item_id AS query, doc_id AS doc FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


def _top(t):
    q = t.benchmark.select("item_id", F.col("text").alias("q"))
    s = R.bm25(t.documents, q, "doc_id", "text", "item_id", "q").withColumn("score", F.round("score", 4))
    return s.withColumn("k", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc")))


def _gold(t):
    """Documents that hold a whole item."""
    return held_quotes(t.documents, ["doc_id"], "text", t.benchmark.select(F.col("item_id").alias("query"), "text"), "text").select("query", F.col("doc_id").alias("doc"))


@query("agg16_hit_rate", f"WITH {_TOP5}, h AS (SELECT g.query, min(k) AS best FROM gold g LEFT JOIN top USING (query, doc) GROUP BY g.query) SELECT count(*) AS queries, count(*) FILTER (best <= 1) AS at_1, count(*) FILTER (best <= 5) AS at_5, round(count(*) FILTER (best <= 5) / count(*), 4) AS recall_5 FROM h")
def _(t):
    """Recall of the documents that hold an item."""
    h = _gold(t).join(_top(t).where("k <= 5").select("query", "doc", "k"), ["query", "doc"], "left").groupBy("query").agg(F.min("k").alias("best"))
    return h.agg(F.count("*").alias("queries"), F.count_if(F.col("best") <= 1).alias("at_1"), F.count_if(F.col("best") <= 5).alias("at_5"), F.round(F.count_if(F.col("best") <= 5) / F.count("*"), 4).alias("recall_5"))


@query("ev1_recall_rows", f"WITH {_TOP5} SELECT g.query, coalesce(bool_or(k <= 5), false) AS hit FROM gold g LEFT JOIN top USING (query, doc) GROUP BY g.query")
def _(t):
    return _gold(t).join(_top(t).where("k <= 5").select("query", "doc", "k"), ["query", "doc"], "left").groupBy("query").agg(F.coalesce(F.bool_or(F.col("k") <= 5), F.lit(False)).alias("hit"))


@query("ex2_family_hit", f"WITH {_TOP5}, fam AS (SELECT g.query, d.source FROM gold g JOIN documents d ON g.doc = d.doc_id), res AS (SELECT t.query, d.source FROM top t JOIN documents d ON t.doc = d.doc_id WHERE k <= 6) SELECT DISTINCT f.query, EXISTS (SELECT 1 FROM res r WHERE r.query = f.query AND r.source = f.source) AS family_hit FROM fam f WHERE true QUALIFY row_number() OVER (PARTITION BY f.query ORDER BY f.source) = 1")
def _(t):
    """Whether the six best hold a document of the first gold document's source."""
    src = t.documents.select(F.col("doc_id").alias("doc"), "source")
    fam = _gold(t).join(src, "doc").groupBy("query").agg(F.min("source").alias("source"))
    res = _top(t).where("k <= 6").join(src, "doc").select("query", "source", F.lit(True).alias("h")).distinct()
    return fam.join(res, ["query", "source"], "left").select("query", F.coalesce("h", F.lit(False)).alias("family_hit"))


# --- entities ----------------------------------------------------------------------------------------


@query("en1_alias_index", "SELECT mention, canonical, type, list_sort(list(DISTINCT src)) AS sources, min(ord)::BIGINT AS ord FROM (SELECT lower(c_mktsegment) AS mention, c_mktsegment AS canonical, 'segment' AS type, 'customer' AS src, 0 AS ord FROM customer UNION ALL SELECT lower(n_name), n_name, 'nation', 'nation', 1 FROM nation UNION ALL SELECT lower(p_brand), p_brand, 'brand', 'part', 2 FROM part) GROUP BY mention, canonical, type")
def _(t):
    a = t.customer.select(F.lower("c_mktsegment").alias("mention"), F.col("c_mktsegment").alias("canonical"), F.lit("segment").alias("type"), F.lit("customer").alias("src"), F.lit(0).alias("ord"))
    b = t.nation.select(F.lower("n_name"), "n_name", F.lit("nation"), F.lit("nation"), F.lit(1))
    c = t.part.select(F.lower("p_brand"), "p_brand", F.lit("brand"), F.lit("part"), F.lit(2))
    return a.union(b).union(c).groupBy("mention", "canonical", "type").agg(F.sort_array(F.collect_set("src")).alias("sources"), F.min("ord").cast("long").alias("ord"))


@query("en2_resolve", "SELECT p_name AS mention, arg_min(p_partkey, p_partkey) AS chosen, count(DISTINCT p_brand) > 1 AS ambiguous, CASE WHEN count(DISTINCT p_brand) > 1 THEN list_sort(list(DISTINCT p_brand)) END AS senses FROM part GROUP BY p_name")
def _(t):
    many = F.countDistinct("p_brand") > 1
    return t.part.groupBy(F.col("p_name").alias("mention")).agg(F.min("p_partkey").alias("chosen"), many.alias("ambiguous"), F.when(many, F.sort_array(F.collect_set("p_brand"))).alias("senses"))


@query("en7_glossary_merge", "SELECT term, type, list_sort(list(DISTINCT v)) AS variants FROM (SELECT upper(left(p_name, 3)) AS term, 'part' AS type, p_name AS v FROM part UNION ALL SELECT upper(left(n_name, 3)), 'nation', n_name FROM nation UNION ALL SELECT upper(left(c_mktsegment, 3)), 'segment', c_mktsegment FROM customer UNION ALL SELECT upper(left(r_name, 3)), 'region', r_name FROM region) GROUP BY ALL")
def _(t):
    g = lambda df, c, ty: df.select(F.upper(F.substring(c, 1, 3)).alias("term"), F.lit(ty).alias("type"), F.col(c).alias("v"))
    u = g(t.part, "p_name", "part").union(g(t.nation, "n_name", "nation")).union(g(t.customer, "c_mktsegment", "segment")).union(g(t.region, "r_name", "region"))
    return u.groupBy("term", "type").agg(F.sort_array(F.collect_set("v")).alias("variants"))


@query("en8_canonicalise", "WITH a AS (SELECT p_type AS alias, arg_min(p_brand, p_partkey) AS canonical FROM part WHERE p_size < 10 GROUP BY 1) SELECT p_partkey, coalesce(a.canonical, p_type) AS term FROM part LEFT JOIN a ON p_type = alias")
def _(t):
    """The first alias wins; terms without alias stay."""
    a = t.part.where("p_size < 10").groupBy(F.col("p_type").alias("alias")).agg(F.min_by("p_brand", "p_partkey").alias("canonical"))
    return t.part.join(a, F.col("p_type") == F.col("alias"), "left").select("p_partkey", F.coalesce("canonical", "p_type").alias("term"))


# --- graphs ------------------------------------------------------------------------------------------

_CC = """e0 AS ({edges}), e AS (SELECT a, b FROM e0 UNION SELECT b, a FROM e0), r(node, c) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON r.node = e.a WHERE r.c < e.b), cc AS (SELECT node, min(c) AS component FROM r GROUP BY node)"""
_COPIES = "SELECT a, b FROM (SELECT doc_id AS b, min(doc_id) OVER (PARTITION BY text) AS a FROM documents) WHERE a <> b"


def _copies(t):
    """Links of equal texts to the first of them, by hash."""
    h = t.documents.select("doc_id", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s"))
    first = h.groupBy("s").agg(F.min("doc_id").alias("a"))
    return h.join(first, "s").where("a <> doc_id").select("a", F.col("doc_id").alias("b"))


@query("gr1_union_find", f"WITH RECURSIVE {_CC.format(edges=_COPIES)} SELECT node, component FROM cc")
def _(t):
    return connected_components(_copies(t))


@query(
    "gr3_alias_components",
    f"WITH RECURSIVE {_CC.format(edges='SELECT l_partkey AS a, 1000000 + l_suppkey AS b FROM lineitem WHERE l_quantity >= 50 GROUP BY ALL')} SELECT component, count(*) AS n, min(p_name) AS canonical FROM cc JOIN part ON node = p_partkey GROUP BY component",
)
def _(t):
    """Components of parts linked by suppliers, with one name for each."""
    e = t.lineitem.where("l_quantity >= 50").select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 1000000).alias("b")).distinct()
    cc = connected_components(e)
    return cc.join(t.part.select(F.col("p_partkey").alias("node"), "p_name"), "node").groupBy("component").agg(F.count("*").alias("n"), F.min("p_name").alias("canonical"))


@query("gr5_links_both_ways", "WITH e AS (SELECT l_partkey AS a, l_suppkey AS b, count(*)::DOUBLE AS score FROM lineitem GROUP BY ALL HAVING count(*) >= 2) SELECT a AS node, 'part' AS kind, count(*) AS links, 'linked' AS status FROM e GROUP BY a UNION ALL SELECT b, 'supplier', count(*), 'linked' FROM e GROUP BY b")
def _(t):
    e = t.lineitem.groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).agg(F.count("*").alias("score")).where("score >= 2")
    n = lambda c, kind: e.groupBy(F.col(c).alias("node")).agg(F.count("*").alias("links")).select("node", F.lit(kind).alias("kind"), "links", F.lit("linked").alias("status"))
    return n("a", "part").unionByName(n("b", "supplier"))


@query("gr6_equivalence_class", f"WITH RECURSIVE {_CC.format(edges=_COPIES)} SELECT d.doc_id, coalesce(component, d.doc_id) AS class FROM documents d LEFT JOIN cc ON d.doc_id = node")
def _(t):
    return t.documents.select("doc_id").join(connected_components(_copies(t)), F.col("doc_id") == F.col("node"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("class"))


@query("gr7_drop_cascade", "WITH noise AS (SELECT o_custkey FROM orders GROUP BY 1 HAVING avg(o_totalprice) < 100000) SELECT o_orderkey, o_custkey IN (SELECT o_custkey FROM noise) AS dropped FROM orders")
def _(t):
    """Members of a group that is noise are noise."""
    noise = t.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("m")).where("m < 100000").select("o_custkey", F.lit(True).alias("n"))
    return t.orders.select("o_orderkey", "o_custkey").join(noise, "o_custkey", "left").select("o_orderkey", F.coalesce("n", F.lit(False)).alias("dropped"))
