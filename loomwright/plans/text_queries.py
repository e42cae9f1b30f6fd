"""Queries of text functions, projections, filters and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwright.functions import text as T

from .registry import query

LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents"


def lines(t):
    """(doc_id, line_no from 1, line)."""
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), "line")


@query("tx2_backreference", r"SELECT doc_id, regexp_replace(text, '([a-z]+)ing\b', '\1ed', 'g') AS rewritten FROM documents")
def _(t):
    return t.documents.select("doc_id", F.regexp_replace("text", r"([a-z]+)ing\b", "$1ed").alias("rewritten"))


@query("tx6_unit_normalise", "SELECT p_partkey, CASE WHEN u IN ('STEEL', 'BRASS', 'COPPER', 'NICKEL', 'TIN') THEN 'metal' WHEN u = '' OR u IS NULL THEN NULL ELSE lower(u) END AS unit FROM (SELECT p_partkey, string_split(p_type, ' ')[-1] AS u FROM part)")
def _(t):
    u = F.element_at(F.split("p_type", " "), -1)
    return t.part.select("p_partkey", F.when(u.isin("STEEL", "BRASS", "COPPER", "NICKEL", "TIN"), "metal").when(u == "", None).otherwise(F.lower(u)).alias("unit"))


@query("tx7_strip_punctuation", r"SELECT doc_id, regexp_replace(text, '[ \t\n\x0b\f\r\x{85}\x{a0}\x{3000}]+', '', 'g') AS no_white, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS normal FROM documents")
def _(t):
    return t.documents.select("doc_id", T.strip_white(F.col("text")).alias("no_white"), T.normal(F.col("text")).alias("normal"))


@query(
    "tx8_seconds_to_hms",
    "SELECT event_id, s, CASE WHEN s >= 3600 THEN printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS hms, s AS back FROM (SELECT event_id, (epoch_us(ts) // 1000000) % 86400 AS s FROM events)",
)
def _(t):
    s = t.events.select("event_id", (F.unix_timestamp(F.col("ts").cast("timestamp")) % 86400).alias("s")).withColumn("hms", T.hms(F.col("s")))
    return s.withColumn("back", T.seconds_of(F.col("hms")))


@query(
    "tx9_media_strip",
    r"SELECT page_id, regexp_matches(html, '<img[^>]*>') AS has_media, trim(regexp_replace(html, '<img[^>]*>', '', 'g')) AS rest, regexp_matches(html, '<img[^>]*>') AND length(trim(regexp_replace(regexp_replace(html, '<img[^>]*>', '', 'g'), '<[^>]*>', '', 'g'))) > 0 AS mixed FROM pages",
)
def _(t):
    rest = F.regexp_replace("html", "<img[^>]*>", "")
    has = F.col("html").rlike("<img[^>]*>")
    return t.pages.select("page_id", has.alias("has_media"), F.trim(rest).alias("rest"), (has & (F.length(F.trim(T.html_text(rest))) > 0)).alias("mixed"))


@query("tx10_event_phrases", "SELECT event_id, CASE WHEN starts_with(event_type, 'p') THEN 'prefix' WHEN contains(event_type, 'i') THEN 'inside' END AS phrase FROM events")
def _(t):
    c = F.col("event_type")
    return t.events.select("event_id", F.when(c.startswith("p"), "prefix").when(F.contains(c, F.lit("i")), "inside").alias("phrase"))


@query("tx12_name_split", r"SELECT c_custkey, regexp_extract(c_name, '^([A-Za-z]+)', 1) AS kind, regexp_extract(c_name, '([0-9]+)$', 1) AS number FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.regexp_extract("c_name", "^([A-Za-z]+)", 1).alias("kind"), F.regexp_extract("c_name", "([0-9]+)$", 1).alias("number"))


@query("tx14_edit_distance", "SELECT p_partkey, levenshtein(lower(p_name), lower(p_type))::BIGINT AS distance, round(levenshtein(lower(p_name), lower(p_type)) / length(p_type), 4) AS cer, greatest(0, round(1 - levenshtein(lower(p_name), lower(p_type)) / length(p_type), 4)) AS accuracy FROM part")
def _(t):
    d = F.levenshtein(F.lower("p_name"), F.lower("p_type")).cast("long")
    cer = d / F.length("p_type")
    return t.part.select("p_partkey", d.alias("distance"), F.round(cer, 4).alias("cer"), F.greatest(F.lit(0.0), F.round(1 - cer, 4)).alias("accuracy"))


@query("tx15_tag_strip", "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS visible FROM pages")
def _(t):
    return t.pages.select("page_id", T.html_text(F.col("html")).alias("visible"))


@query("tx16_squeeze", r"SELECT doc_id, CASE WHEN length(s) > 80 THEN left(s, 80) || '…' ELSE s END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r\x{85}\x{a0}\x{3000}]+', ' ', 'g')) AS s FROM documents)")
def _(t):
    return t.documents.select("doc_id", T.squeeze(F.col("text"), 80).alias("short"))


@query(
    "tx17_sections",
    f"""WITH l AS ({LINES}), h AS (SELECT *, CASE WHEN line_no % 3 = 1 THEN left(line, 12) END AS head FROM l)
        SELECT doc_id, line_no, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section, line_no % 3 = 1 AS is_header FROM h""",
)
def _(t):
    """Every line under the last header before it (here every third line stands for a header)."""
    from pyspark.sql import Window

    head = F.when(F.col("line_no") % 3 == 1, F.substring("line", 1, 12))
    w = Window.partitionBy("doc_id").orderBy("line_no")
    return lines(t).select("doc_id", "line_no", F.last(head, ignorenulls=True).over(w).alias("section"), (F.col("line_no") % 3 == 1).alias("is_header"))


@query("tx18_suffix_parse", r"SELECT page_id, regexp_extract(url, '^(\w+)://([^/]+)/(\w*)', 1) AS scheme, regexp_extract(url, '^(\w+)://([^/]+)/(\w*)', 2) AS host, regexp_extract(url, '^(\w+)://([^/]+)/(\w*)', 3) AS head, regexp_extract(url, 'utm_source=([^&#]+)', 1) AS campaign FROM pages")
def _(t):
    p = r"^(\w+)://([^/]+)/(\w*)"
    return t.pages.select("page_id", *[F.regexp_extract("url", p, i).alias(n) for i, n in ((1, "scheme"), (2, "host"), (3, "head"))], F.regexp_extract("url", "utm_source=([^&#]+)", 1).alias("campaign"))


@query("tx21_first_json_object", r"SELECT event_id, regexp_extract('noise ' || props || ' tail', '(?s)\{.*\}') AS object, json_valid(props) AS valid FROM events")
def _(t):
    found = F.regexp_extract(F.concat(F.lit("noise "), "props", F.lit(" tail")), r"(?s)\{.*\}", 0)
    return t.events.select("event_id", found.alias("object"), F.try_parse_json(found).isNotNull().alias("valid"))


@query("tx23_zone_date", "SELECT event_id, (ts + INTERVAL 8 HOUR)::DATE AS day, strftime(ts + INTERVAL 8 HOUR, '%Y-%m') AS month FROM events")
def _(t):
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Shanghai")
    return t.events.select("event_id", F.to_date(local).alias("day"), F.date_format(local, "yyyy-MM").alias("month"))


@query("tx24_content_key", "SELECT doc_id, left(sha1(source || '|' || lang || '|' || text), 12) AS key, sha256(text) AS digest FROM documents")
def _(t):
    return t.documents.select("doc_id", T.short_hash(F.col("source"), F.col("lang"), F.col("text")).alias("key"), F.sha2("text", 256).alias("digest"))


@query("tx25_alias_filter", r"SELECT p_partkey, p_name, length(p_name) BETWEEN 2 AND 40 AND NOT regexp_matches(p_name, '^(File|Category|Template):') AND NOT regexp_matches(p_name, '[\x{3040}-\x{30ff}]') AS usable FROM part")
def _(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", "p_name", (F.length(n).between(2, 40) & ~n.rlike("^(File|Category|Template):") & ~n.rlike(r"[\x{3040}-\x{30ff}]")).alias("usable"))


@query("tx26_stem_parse", r"SELECT page_id, string_split(string_split(url, '/')[3], '.')[-1] AS tld, len(string_split(string_split(url, '/')[3], '.'))::BIGINT AS labels FROM pages")
def _(t):
    host = F.split(F.element_at(F.split("url", "/"), 3), r"\.")
    return t.pages.select("page_id", F.element_at(host, -1).alias("tld"), F.size(host).cast("long").alias("labels"))


@query(
    "tx22_bigram_coverage",
    """WITH d AS (SELECT doc_id, text, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS prev FROM documents),
       b AS (SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS x, list_distinct(string_split(lower(prev), ' ')) AS y FROM d WHERE prev IS NOT NULL)
       SELECT doc_id, round(len(list_intersect(x, y)) / len(x), 4) AS coverage, len(list_intersect(x, y))::BIGINT AS shared FROM b""",
)
def _(t):
    """Share of a text's words that the previous text of its source holds. Rows are numbered without their texts,
    and each then meets the one before it."""
    from loomwright.operators.windows import place_in_order

    placed = place_in_order(t.documents.select("doc_id", "source"), ["doc_id"], "place", ("source",))
    words = F.array_distinct(F.split(F.lower("text"), " "))
    d = t.documents.select("doc_id", words.alias("x")).join(placed, "doc_id")
    before = d.select(F.col("source").alias("s"), (F.col("place") + 1).alias("p"), F.col("x").alias("y")).where("y is not null")
    d = d.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("p")))
    shared = F.size(F.array_intersect("x", "y"))
    return d.select("doc_id", F.round(shared / F.size("x"), 4).alias("coverage"), shared.cast("long").alias("shared"))


KNOWN = ("that", "this", "with", "thesis", "andes")
_KNOWN_SQL = ", ".join(f"('{k}')" for k in KNOWN)


@query(
    "tx27_frequent_ngrams",
    rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\x{{4e00}}-\x{{9fff}}]{{2,4}}|[a-z]{{4,8}}')) AS term FROM documents),
        n AS (SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM w
              WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_KNOWN_SQL}) k(k) WHERE contains(k, term) OR contains(term, k)) GROUP BY term HAVING count(*) >= 8 ORDER BY n DESC, term LIMIT 500)
        SELECT term, n, docs, first_doc, substr(text, greatest(strpos(lower(text), term) - 12, 1), strpos(lower(text), term) - greatest(strpos(lower(text), term) - 12, 1) + length(term) + 12) AS context FROM n JOIN documents ON doc_id = first_doc""",
)
def _(t):
    """Frequent runs of 2 to 4 ideographs or 4 to 8 letters that are not known, nor part of what is known, nor hold it:
    a top-500 report, each with its first document and what surrounds it there."""
    runs = F.regexp_extract_all(F.lower("text"), F.lit(r"[\x{4e00}-\x{9fff}]{2,4}|[a-z]{4,8}"), F.lit(0))
    known = F.array(*map(F.lit, KNOWN))
    w = t.documents.select("doc_id", F.explode(runs).alias("term"))
    n = w.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"), F.min("doc_id").alias("first_doc")).where("n >= 8")
    n = n.where(~F.exists(known, lambda k: F.contains(k, F.col("term")) | F.contains(F.col("term"), k))).orderBy(F.desc("n"), "term").limit(500)
    at = F.instr(F.lower("text"), F.col("term"))
    start = F.greatest(at - 12, F.lit(1))
    context = F.substr("text", start, at - start + F.length("term") + 12)
    return t.documents.select("doc_id", "text").join(F.broadcast(n), F.col("doc_id") == F.col("first_doc")).select("term", "n", "docs", "first_doc", context.alias("context"))


# --- projections ---------------------------------------------------------------------------------


@query("prj1_compact", "SELECT o_orderkey, list({'line': l_linenumber, 'qty': l_quantity} ORDER BY l_linenumber, l_quantity) AS parts FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def _(t):
    j = t.orders.select("o_orderkey").join(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty")))).alias("parts"))


@query("prj2_search_text", "SELECT p_partkey, concat_ws(chr(10), p_name, CASE WHEN p_size > 10 THEN 'size ' || p_size END, CASE WHEN ends_with(p_type, 'TIN') THEN p_type ELSE p_type || ' TIN' END) AS search_text FROM part")
def _(t):
    ty = F.col("p_type")
    return t.part.select("p_partkey", F.concat_ws("\n", "p_name", F.when(F.col("p_size") > 10, F.concat(F.lit("size "), F.col("p_size").cast("string"))), F.when(F.endswith(ty, F.lit("TIN")), ty).otherwise(F.concat(ty, F.lit(" TIN")))).alias("search_text"))


@query("prj3_labelled_text", "SELECT doc_id, concat_ws(chr(10), 'lang: ' || nullif(lang, 'en'), 'source: ' || nullif(source, 'src0'), 'text: ' || text) AS labelled FROM documents")
def _(t):
    part = lambda name, c: F.concat(F.lit(f"{name}: "), c)
    return t.documents.select("doc_id", F.concat_ws("\n", part("lang", F.nullif("lang", F.lit("en"))), part("source", F.nullif("source", F.lit("src0"))), part("text", F.col("text"))).alias("labelled"))


@query(
    "prj4_citation_shape",
    """SELECT doc_id AS id, 'document' AS kind, source AS ref, NULL::BIGINT AS at FROM documents
       UNION ALL SELECT event_id, 'event', event_type, epoch_us(ts) // 1000000 FROM events
       UNION ALL SELECT conv_id, 'turn', role, turn FROM conversations""",
)
def _(t):
    a = t.documents.select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), F.col("source").alias("ref"), F.lit(None).cast("long").alias("at"))
    b = t.events.select(F.col("event_id").alias("id"), F.lit("event").alias("kind"), F.col("event_type").alias("ref"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    c = t.conversations.select(F.col("conv_id").alias("id"), F.lit("turn").alias("kind"), F.col("role").alias("ref"), F.col("turn").alias("at"))
    return a.unionByName(b).unionByName(c)


@query("prj5_first_non_null", "SELECT conv_id, min_by(text, turn) FILTER (text IS NOT NULL) AS first_text, CASE WHEN min(turn) FILTER (turn > 0) IS NOT NULL THEN 'at=' || min(turn) FILTER (turn > 0) END AS link FROM conversations GROUP BY conv_id")
def _(t):
    """The first text that is not null, and a link only for a turn above 0."""
    later = F.min(F.when(F.col("turn") > 0, F.col("turn")))
    first = F.min(F.when(F.col("text").isNotNull(), F.struct("turn", "text")))
    return t.conversations.groupBy("conv_id").agg(first.alias("f"), later.alias("l")).select("conv_id", F.col("f.text").alias("first_text"), F.concat(F.lit("at="), F.col("l").cast("string")).alias("link"))


# --- filters, gates, buckets -----------------------------------------------------------------------


@query("flt1_noise_gate", "SELECT doc_id, CASE WHEN lang NOT IN ('en', 'de') THEN 'category' WHEN n_chars < 200 THEN 'short' WHEN source = 'src1' AND NOT contains(text, 'the') THEN 'no_hint' WHEN length(trim(text)) = 0 THEN 'empty' END AS reason FROM documents")
def _(t):
    return t.documents.select("doc_id", T.first_reason(("category", ~F.col("lang").isin("en", "de")), ("short", F.col("n_chars") < 200), ("no_hint", (F.col("source") == "src1") & ~F.contains("text", F.lit("the"))), ("empty", F.length(F.trim("text")) == 0)).alias("reason"))


@query("flt2_candidates", "SELECT doc_id FROM documents WHERE n_chars BETWEEN 300 AND 3000 AND lang = 'en' AND length(text) = n_chars")
def _(t):
    return t.documents.where(F.col("n_chars").between(300, 3000) & (F.col("lang") == "en") & (F.length("text") == F.col("n_chars"))).select("doc_id")


@query(
    "flt3_drop_reason",
    rf"SELECT doc_id, line_no::BIGINT AS line_no, CASE WHEN length(trim(line)) = 0 THEN 'empty' WHEN contains(line, 'license') THEN 'phrase' WHEN (length(line) - length(regexp_replace(line, '[0-9]', '', 'g'))) / length(line) > 0.5 THEN 'digits' WHEN length(line) <= 2 THEN 'tiny' END AS reason FROM ({LINES})",
)
def _(t):
    n = F.length("line")
    digits = (n - F.length(F.regexp_replace("line", "[0-9]", ""))) / n
    return lines(t).select("doc_id", "line_no", T.first_reason(("empty", F.length(F.trim("line")) == 0), ("phrase", F.contains("line", F.lit("license"))), ("digits", digits > 0.5), ("tiny", n <= 2)).alias("reason"))


@query("flt4_empty_statements", "SELECT conv_id, list_filter(x, lambda v: NOT regexp_matches(v, '^(ok|yes|no|thanks?)[.!]*$') AND length(v) > 10) AS kept, len(list_filter(x, lambda v: NOT regexp_matches(v, '^(ok|yes|no|thanks?)[.!]*$') AND length(v) > 10)) = 0 AS emptied FROM (SELECT conv_id, list(text ORDER BY turn) AS x FROM conversations WHERE text IS NOT NULL GROUP BY conv_id)")
def _(t):
    x = t.conversations.where("text is not null").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("x"))
    kept = F.filter("x", lambda v: ~v.rlike("^(ok|yes|no|thanks?)[.!]*$") & (F.length(v) > 10))
    return x.select("conv_id", kept.alias("kept"), (F.size(kept) == 0).alias("emptied"))


@query("flt5_uncertain_parameters", "SELECT o_orderkey, list_filter(x, lambda v: v < 40) AS certain FROM (SELECT l_orderkey AS o_orderkey, list(l_quantity ORDER BY l_linenumber, l_quantity) AS x FROM lineitem GROUP BY l_orderkey)")
def _(t):
    x = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("x"))
    return x.select("o_orderkey", F.filter(F.transform("x", lambda s: s["l_quantity"]), lambda v: v < 40).alias("certain"))


_GATES = (("no_date", "o_orderdate IS NULL"), ("status", "o_orderstatus = 'P'"), ("cheap", "o_totalprice < 2000"), ("segment", "c_mktsegment = 'MACHINERY' AND o_orderpriority <> '1-URGENT'"), ("debt", "c_acctbal < 0"))
_GATE_FROM = "FROM orders LEFT JOIN customer ON o_custkey = c_custkey"


def _gated(t):
    return t.orders.join(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"), "left")


@query("gate1_first_failure", f"SELECT o_orderkey, CASE {' '.join(f'WHEN {c} THEN {n!r}' for n, c in _GATES)} END AS reject_reason {_GATE_FROM}")
def _(t):
    """Hard gates in order; the first failure is the reason."""
    return _gated(t).select("o_orderkey", T.first_reason(*[(n, F.expr(c)) for n, c in _GATES]).alias("reject_reason"))


@query("gate2_decision", f"SELECT o_orderkey, CASE WHEN {' OR '.join(f'({c})' for _, c in _GATES)} THEN 'reject' ELSE 'accept' END AS decision, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END::BIGINT AS status_rank {_GATE_FROM}")
def _(t):
    rank = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 2).otherwise(1).cast("long")
    reason = T.first_reason(*[(n, F.expr(c)) for n, c in _GATES])
    return _gated(t).select("o_orderkey", F.when(reason.isNull(), "accept").otherwise("reject").alias("decision"), rank.alias("status_rank"))


@query("gate3_all_failures", f"SELECT o_orderkey, list_filter([{', '.join(f'CASE WHEN {c} THEN {n!r} END' for n, c in _GATES)}], lambda x: x IS NOT NULL) AS failures {_GATE_FROM}")
def _(t):
    return _gated(t).select("o_orderkey", T.all_reasons(*[(n, F.expr(c)) for n, c in _GATES]).alias("failures"))


@query("gate4_citations_resolve", "SELECT o_orderkey, coalesce(count(p_partkey) = count(*) FILTER (l_partkey IS NOT NULL), false) AND count(l_partkey) > 0 AS resolved FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 5) ON l_partkey = p_partkey GROUP BY o_orderkey")
def _(t):
    """An order resolves if it has lines and all its parts are known."""
    known = t.part.where("p_size > 5").select("p_partkey")
    j = t.orders.select("o_orderkey").join(t.lineitem.select("l_orderkey", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left").join(known, F.col("l_partkey") == F.col("p_partkey"), "left")
    return j.groupBy("o_orderkey").agg(((F.count("p_partkey") == F.count("l_partkey")) & (F.count("l_partkey") > 0)).alias("resolved"))


_FLAGS = {"long": "n_chars > 3000", "digits": "regexp_like(text, '[0-9]{4,}')", "mail": "text LIKE '%@%'", "url": "text LIKE '%http%'", "lines": "text LIKE '%\n%'"}


@query("gate5_flags", "SELECT doc_id, list_filter([" + ", ".join(f"CASE WHEN {c.replace('regexp_like', 'regexp_matches')} THEN '{n}' END" for n, c in _FLAGS.items()) + "], lambda x: x IS NOT NULL) AS flags FROM documents")
def _(t):
    c = F.col("text")
    return t.documents.select("doc_id", T.all_reasons(("long", F.col("n_chars") > 3000), ("digits", c.rlike("[0-9]{4,}")), ("mail", F.contains(c, F.lit("@"))), ("url", F.contains(c, F.lit("http"))), ("lines", F.contains(c, F.lit("\n")))).alias("flags"))


@query("gate6_provenance", "SELECT l_orderkey AS o_orderkey, bool_and(s_nationkey < 5) AS only_registry, CASE WHEN bool_and(s_nationkey < 5) THEN 'drop' WHEN bool_or(s_nationkey < 5) THEN 'context' ELSE 'keep' END AS action FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey")
def _(t):
    """Orders whose suppliers all lie within a registry are dropped; those with some are context."""
    inside = F.col("s_nationkey") < 5
    j = t.lineitem.select("l_orderkey", "l_suppkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    g = j.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_and(inside).alias("only_registry"), F.bool_or(inside).alias("some"))
    return g.select("o_orderkey", "only_registry", F.when(F.col("only_registry"), "drop").when(F.col("some"), "context").otherwise("keep").alias("action"))


@query("gate7_consensus", "SELECT c_nationkey, count(DISTINCT c_mktsegment) <= 5 AND count(DISTINCT c_custkey) >= 2 AND NOT bool_or(c_acctbal < -900) AS consensus, count(DISTINCT coalesce(c_mktsegment, '')) AS segments FROM customer GROUP BY c_nationkey")
def _(t):
    n = F.countDistinct(F.coalesce("c_mktsegment", F.lit("")))
    return t.customer.groupBy("c_nationkey").agg(((n <= 5) & (F.countDistinct("c_custkey") >= 2) & ~F.bool_or(F.col("c_acctbal") < -900)).alias("consensus"), n.alias("segments"))


@query("gate8_mode", "SELECT doc_id, CASE WHEN n_chars < 100 THEN 'archive' WHEN lang <> 'en' THEN 'pending' WHEN contains(text, 'test') THEN 'experiment' ELSE 'mechanism' END AS mode FROM documents")
def _(t):
    return t.documents.select("doc_id", F.when(F.col("n_chars") < 100, "archive").when(F.col("lang") != "en", "pending").when(F.contains("text", F.lit("test")), "experiment").otherwise("mechanism").alias("mode"))


@query("gate9_group_class", r"SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]+') AND regexp_matches(text, '\n') THEN 'A' WHEN regexp_matches(text, '[0-9]+') THEN 'B' WHEN regexp_matches(text, '\n') THEN 'C' ELSE 'D' END AS class FROM documents")
def _(t):
    d, n = F.col("text").rlike("[0-9]+"), F.col("text").rlike(r"\n")
    return t.documents.select("doc_id", F.when(d & n, "A").when(d, "B").when(n, "C").otherwise("D").alias("class"))


@query("gate10_stage_bucket", "SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'blocked' WHEN l.quality = 1 THEN 'ready' WHEN l.doc_id IS NOT NULL THEN 'reviewed' ELSE 'open' END AS stage FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    j = t.documents.select("doc_id").join(t.labels.withColumn("known", F.lit(True)), "doc_id", "left")
    return j.select("doc_id", F.when(F.col("toxic") == 1, "blocked").when(F.col("quality") == 1, "ready").when(F.col("known"), "reviewed").otherwise("open").alias("stage"))


@query("gate11_instance", r"SELECT doc_id, source = 'src3' OR (contains(text, 'the') AND regexp_matches(text, '[0-9]{1,2}:[0-9]{2}')) AS is_instance FROM documents")
def _(t):
    return t.documents.select("doc_id", ((F.col("source") == "src3") | (F.contains("text", F.lit("the")) & F.col("text").rlike("[0-9]{1,2}:[0-9]{2}"))).alias("is_instance"))


@query("gate12_mojibake", r"SELECT doc_id, regexp_matches(text, 'Ã.|â€|\x{fffd}') AS broken FROM documents")
def _(t):
    return t.documents.select("doc_id", F.col("text").rlike(r"Ã.|â€|\x{fffd}").alias("broken"))


@query("bkt1_keyword_bucket", "SELECT doc_id, CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'copyright') THEN 'legal' WHEN contains(lower(text), 'password') OR contains(lower(text), '@') THEN 'private' WHEN contains(lower(text), 'the ') THEN 'english' ELSE 'other' END AS bucket FROM documents")
def _(t):
    return t.documents.select("doc_id", T.first_match(F.lower("text"), [("legal", ["license", "copyright"]), ("private", ["password", "@"]), ("english", ["the "])], "other").alias("bucket"))


@query("bkt2_kind_route", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'sale' WHEN value IS NULL THEN 'unknown' WHEN value > 50 THEN 'high' ELSE 'low' END AS kind FROM events")
def _(t):
    return t.events.select("event_id", F.when(F.col("event_type") == "purchase", "sale").when(F.col("value").isNull(), "unknown").when(F.col("value") > 50, "high").otherwise("low").alias("kind"))


@query("bkt3_prefix_map", "SELECT p_partkey, coalesce(topic, 'other') AS topic FROM part LEFT JOIN (VALUES ('STANDARD', 'basic'), ('PROMO', 'offer'), ('ECONOMY', 'basic'), ('LARGE', 'size')) AS m(prefix, topic) ON starts_with(p_type, prefix)")
def _(t):
    """Topic by the first prefix that fits, as a CASE over the prefix table."""
    c = F.col("p_type")
    return t.part.select("p_partkey", F.when(c.startswith("STANDARD"), "basic").when(c.startswith("PROMO"), "offer").when(c.startswith("ECONOMY"), "basic").when(c.startswith("LARGE"), "size").otherwise("other").alias("topic"))


@query("bkt4_tiers", "SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 OR o_totalprice / (SELECT max(o_totalprice) FROM orders) >= 0.75 THEN 'high' WHEN o_totalprice >= 50000 THEN 'mid' ELSE 'low' END AS tier FROM orders")
def _(t):
    most = t.orders.agg(F.max("o_totalprice").alias("most"))
    j = t.orders.select("o_orderkey", "o_totalprice").crossJoin(F.broadcast(most))  # one row
    return j.select("o_orderkey", F.when((F.col("o_totalprice") >= 200000) | (F.col("o_totalprice") / F.col("most") >= 0.75), "high").when(F.col("o_totalprice") >= 50000, "mid").otherwise("low").alias("tier"))


# --- validators ------------------------------------------------------------------------------------


@query("val1_schema_errors", "SELECT o_orderkey, list_filter([CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'enum:status' END, CASE WHEN o_totalprice <= 1000 THEN 'range:price' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-3]-') THEN 'vocab:priority' END], lambda x: x IS NOT NULL) AS errors FROM orders")
def _(t):
    return t.orders.select("o_orderkey", T.all_reasons(("enum:status", ~F.col("o_orderstatus").isin("O", "F")), ("range:price", F.col("o_totalprice") <= 1000), ("vocab:priority", ~F.col("o_orderpriority").rlike("^[1-3]-"))).alias("errors"))


@query(
    "val2_mode_validators",
    """SELECT 'merge' AS mode, count(*) AS violations FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
       UNION ALL SELECT 'novelty', count(*) FROM labels WHERE quality NOT IN (0, 1)
       UNION ALL SELECT 'glossary', count(*) FROM part WHERE length(p_name) < 2
       UNION ALL SELECT 'split', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING max(l_linenumber) <> count(*))
       UNION ALL SELECT 'alias', count(*) FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1)""",
)
def _(t):
    n = lambda mode, df: df.agg(F.count("*").alias("violations")).select(F.lit(mode).alias("mode"), "violations")
    parts = [
        n("merge", t.documents.groupBy("text").count().where("count > 1")), n("novelty", t.labels.where(~F.col("quality").isin(0, 1))), n("glossary", t.part.where(F.length("p_name") < 2)),
        n("split", t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("m"), F.count("*").alias("c")).where("m <> c")), n("alias", t.part.groupBy("p_name").agg(F.countDistinct("p_brand").alias("b")).where("b > 1")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "val3_release_checks",
    """SELECT 'missing_text' AS check_name, count(*) AS violations FROM documents WHERE text IS NULL OR text = ''
       UNION ALL SELECT 'duplicate_id', count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)
       UNION ALL SELECT 'unresolved_label', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
       UNION ALL SELECT 'length_mismatch', count(*) FROM documents WHERE length(text) <> n_chars""",
)
def _(t):
    n = lambda name, df: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")
    return (
        n("missing_text", t.documents.where("text is null or text = ''"))
        .unionByName(n("duplicate_id", t.documents.groupBy("doc_id").count().where("count > 1")))
        .unionByName(n("unresolved_label", t.labels.join(t.documents.select("doc_id"), "doc_id", "left_anti")))
        .unionByName(n("length_mismatch", t.documents.where(F.length("text") != F.col("n_chars"))))
    )


@query("val4_unsourced_numbers", "WITH n AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '[0-9]+'))) AS num FROM documents), d AS (SELECT DISTINCT unnest(regexp_extract_all(url, '[0-9]+')) AS num FROM pages) SELECT doc_id, num FROM n WHERE num NOT IN (SELECT num FROM d)")
def _(t):
    """Digit runs of documents that no page's URL holds."""
    nums = lambda df, c, *k: df.select(*k, F.explode(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0))).alias("num")).distinct()
    return nums(t.documents, "text", "doc_id").join(nums(t.pages, "url"), "num", "left_anti").select("doc_id", "num")


@query("val6_batch_merge", "SELECT coalesce(d.doc_id, l.doc_id) AS id, CASE WHEN l.doc_id IS NULL THEN 'unanswered' WHEN d.doc_id IS NULL THEN 'unknown' WHEN n > 1 THEN 'duplicate' ELSE 'ok' END AS state FROM documents d FULL JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id")
def _(t):
    answers = t.labels.groupBy("doc_id").agg(F.count("*").alias("n")).withColumnRenamed("doc_id", "a")
    j = t.documents.select("doc_id").join(answers, F.col("doc_id") == F.col("a"), "full")
    return j.select(F.coalesce("doc_id", "a").alias("id"), F.when(F.col("a").isNull(), "unanswered").when(F.col("doc_id").isNull(), "unknown").when(F.col("n") > 1, "duplicate").otherwise("ok").alias("state"))


@query("val7_term_merge", "SELECT p_name AS term, p_brand AS correction, p_partkey AS first_seen FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY CASE WHEN p_size > 30 THEN 0 WHEN p_size > 10 THEN 1 ELSE 2 END, p_partkey) AS k FROM part) WHERE k = 1")
def _(t):
    """Candidates ranked by confidence; the first seen of equal ones stays."""
    from pyspark.sql import Window

    rank = F.when(F.col("p_size") > 30, 0).when(F.col("p_size") > 10, 1).otherwise(2)
    k = F.row_number().over(Window.partitionBy("p_name", "p_brand").orderBy(rank, "p_partkey"))
    return t.part.withColumn("k", k).where("k = 1").select(F.col("p_name").alias("term"), F.col("p_brand").alias("correction"), F.col("p_partkey").alias("first_seen"))
