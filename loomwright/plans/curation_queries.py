"""Queries of evidence, curation, privacy, sampling and model-step bookkeeping."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.operators import joins as J
from loomwright.operators import windows as W
from loomwright.operators.containment import held_quotes
from loomwright.session import tasks_of

from .registry import query
from .text_queries import LINES, lines
from .window_queries import EVENTS, events

NORM = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', '', 'g')"


def _normal(df, key: str):
    return df.select(key, T.normal(F.col("text")).alias("x"))


@query("ev2_quote_check", f"SELECT item_id, count(*) AS found_in FROM benchmark b JOIN documents d ON contains({NORM.format('d.text')}, {NORM.format('b.text')}) GROUP BY item_id")
def _(t):
    """Normalised containment of whole quotes in documents."""
    return held_quotes(_normal(t.documents, "doc_id"), ["doc_id"], "x", _normal(t.benchmark, "item_id"), "x").groupBy("item_id").agg(F.count("*").alias("found_in"))


#: What recognition heard, by what editors made of it: (edited, heard).
HEARD = (("tion", "sion"), ("ent", "ant"))
_EDITED = "CASE item_id % 5 WHEN 1 THEN replace(text, ' ', ' - ') WHEN 2 THEN replace(text, 'ant', 'ent') WHEN 3 THEN left(text, (0.6 * length(text))::INT) || ' and what nobody said' WHEN 4 THEN left(text, 32) || ' and what nobody said of it' ELSE text END"
_V = "length(x) >= 12 AND contains(y, left(x, 16))"


@query(
    "ev3_graded_trace",
    f"""WITH b AS (SELECT item_id, text, {NORM.format('text')} AS x FROM (SELECT item_id, {_EDITED} AS text FROM benchmark)), d AS (SELECT text, {NORM.format('d.text')} AS y FROM documents d),
        g AS (SELECT item_id, CASE WHEN contains(d.text, b.text) THEN 1 WHEN contains(y, x) THEN 2
              WHEN contains(y, replace(x, 'tion', 'sion')) OR contains(y, replace(x, 'ent', 'ant')) OR contains(y, replace(replace(x, 'tion', 'sion'), 'ent', 'ant')) OR contains(y, left(x, greatest(12, length(x) // 2)::INT)) THEN 3
              WHEN {_V} THEN 4 END AS g FROM b, d WHERE x <> '')
        SELECT b.item_id, CASE min(g) WHEN 1 THEN 'verbatim' WHEN 2 THEN 'joined' WHEN 3 THEN 'normalised' WHEN 4 THEN 'paraphrase' ELSE 'missing' END AS grade FROM benchmark b LEFT JOIN g ON b.item_id = g.item_id GROUP BY b.item_id""",
)
def _(t):
    """The best grade at which a quote is found anywhere: verbatim; joined, over lines and punctuation; normalised, with
    known edits undone, or its first half; paraphrase, its first 16 characters. Four in five quotes are edited."""
    edited = F.when(F.col("item_id") % 5 == 1, F.replace("text", F.lit(" "), F.lit(" - "))).when(F.col("item_id") % 5 == 2, F.replace("text", F.lit("ant"), F.lit("ent")))
    edited = edited.when(F.col("item_id") % 5 == 3, F.concat(F.left("text", F.round(0.6 * F.length("text")).cast("int")), F.lit(" and what nobody said")))
    edited = edited.when(F.col("item_id") % 5 == 4, F.concat(F.left("text", F.lit(32)), F.lit(" and what nobody said of it"))).otherwise(F.col("text"))
    quotes = t.benchmark.select("item_id", edited.alias("text"))
    q = _normal(quotes, "item_id").where("x <> ''")
    undone = [F.col("x")]
    for made, heard in HEARD:
        undone += [F.replace(v, F.lit(made), F.lit(heard)) for v in undone]
    half = F.left("x", F.greatest(F.lit(12), F.floor(F.length("x") / 2).cast("int")))
    probes = q.select("item_id", F.lit(2).alias("g"), "x").unionByName(q.select("item_id", F.lit(3).alias("g"), F.explode(F.array_distinct(F.array(*undone[1:], half))).alias("x")))
    probes = probes.unionByName(q.where(F.length("x") >= 12).select("item_id", F.lit(4).alias("g"), F.left("x", F.lit(16)).alias("x")))
    exact = held_quotes(t.documents, [], "text", quotes.select("item_id", F.lit(1).alias("g"), "text"), "text")
    best = exact.unionByName(held_quotes(_normal(t.documents, "doc_id"), [], "x", probes, "x")).groupBy("item_id").agg(F.min("g").alias("g"))
    name = F.when(F.col("g") == 1, "verbatim").when(F.col("g") == 2, "joined").when(F.col("g") == 3, "normalised").when(F.col("g") == 4, "paraphrase").otherwise("missing")
    return t.benchmark.select("item_id").join(best, "item_id", "left").select("item_id", name.alias("grade"))


#: A quote of each document: its middle line, edited in one of seven ways, with the time that it claims (5 seconds a line).
_SECOND = "line_no * 5 + CASE doc_id % 7 WHEN 6 THEN 1000 ELSE doc_id % 40 END"
_QUOTE = """CASE doc_id % 7 WHEN 1 THEN replace(line, ' ', ' - ') WHEN 2 THEN replace(line, 'ant', 'ent') WHEN 3 THEN left(line, CAST(floor(0.6 * length(line)) AS INT)) || ' and what nobody said'
    WHEN 4 THEN left(line, 32) || ' and what nobody said of it' WHEN 0 THEN line ELSE reversed END"""
_UNITS = "[a-zà-ÿ]{3,}"


@query(
    "ev3_claimed_trace",
    f"""WITH l AS ({LINES}), lines_of AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_lines, array_to_string(list_reverse(string_split(line, ' ')), ' ') AS reversed FROM l), q AS (SELECT *, {NORM.format('quote')} AS x FROM (SELECT doc_id, {_SECOND} AS second, {_QUOTE} AS quote FROM lines_of WHERE line_no = (n_lines + 1) // 2)),
        o AS (SELECT q.doc_id, max(len(list_intersect(u, list_distinct(regexp_extract_all(lower(l.line), '{_UNITS}')))) / len(u)) AS overlap FROM (SELECT doc_id, second, list_distinct(regexp_extract_all(lower(quote), '{_UNITS}')) AS u FROM q) q JOIN l ON q.doc_id = l.doc_id AND abs(l.line_no * 5 - second) <= 120 WHERE len(u) > 0 GROUP BY q.doc_id),
        d AS (SELECT doc_id, text, {NORM.format('text')} AS y FROM documents)
        SELECT doc_id, CASE WHEN contains(text, quote) THEN 'verbatim' WHEN x = '' THEN 'missing' WHEN contains(y, x) THEN 'joined' WHEN contains(y, replace(x, 'tion', 'sion')) OR contains(y, replace(x, 'ent', 'ant')) OR contains(y, replace(replace(x, 'tion', 'sion'), 'ent', 'ant')) OR contains(y, left(x, greatest(12, length(x) // 2)::INT)) THEN 'normalised'
               WHEN (length(x) >= 12 AND contains(y, left(x, 16))) OR coalesce(overlap, 0) >= 0.9 THEN 'paraphrase' ELSE 'missing' END AS grade, round(coalesce(overlap, 0), 4) AS overlap FROM q JOIN d USING (doc_id) LEFT JOIN o USING (doc_id)""",
)
def _(t):
    """The grade of a quote in the source that it claims: verbatim; joined; normalised; paraphrase, by its first characters or by nine in
    ten of its words in one line within two minutes of its time; missing."""
    every = lines(t).select("doc_id", "line_no", "line", (F.col("line_no") * 5).alias("second"), F.regexp_extract_all(F.lower("line"), F.lit(_UNITS), F.lit(0)).alias("units"))
    n = every.groupBy("doc_id").agg(F.count("*").alias("n_lines"))
    middle = every.drop("second", "units").join(n, "doc_id").where(F.col("line_no") == F.floor((F.col("n_lines") + 1) / 2)).withColumn("reversed", F.array_join(F.reverse(F.split("line", " ")), " "))
    q = middle.select("doc_id", F.expr(_SECOND).alias("second"), F.expr(_QUOTE).alias("quote")).withColumn("x", T.normal(F.col("quote"))).withColumn("units", F.regexp_extract_all(F.lower("quote"), F.lit(_UNITS), F.lit(0)))
    near = J.overlap_near(q, every, "doc_id", "doc_id", "second", "units", 120)
    s = q.join(t.documents.select("doc_id", "text", T.normal(F.col("text")).alias("y")), "doc_id").join(near, "doc_id", "left")
    undone = [F.col("x")]
    for made, heard in HEARD:
        undone += [F.replace(v, F.lit(made), F.lit(heard)) for v in undone]
    held = lambda v: F.contains("y", v)
    half = F.left("x", F.greatest(F.lit(12), F.floor(F.length("x") / 2).cast("int")))
    heard_so = F.exists(F.array(*undone[1:], half), held)
    like = ((F.length("x") >= 12) & held(F.left("x", F.lit(16)))) | (F.coalesce("overlap", F.lit(0.0)) >= 0.9)
    grade = F.when(F.contains("text", F.col("quote")), "verbatim").when(F.col("x") == "", "missing").when(held(F.col("x")), "joined").when(heard_so, "normalised").when(like, "paraphrase").otherwise("missing")
    return s.select("doc_id", grade.alias("grade"), F.round(F.coalesce("overlap", F.lit(0.0)), 4).alias("overlap"))


@query("ev4_ellipsis_parts", "SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, left(b.text, (length(b.text) // 2)::INT - 5)) AND contains(d.text, substr(b.text, (length(b.text) // 2)::INT + 6))")
def _(t):
    """Quotes whose middle an ellipsis stands for: every part must occur."""
    half = F.floor(F.length("text") / 2).cast("int")
    parts = F.split(F.concat(F.left("text", half - 5), F.lit("…"), F.substr("text", half + 6)), "…")
    q = t.benchmark.select("item_id", F.posexplode(parts).alias("k", "part"))
    hit = held_quotes(t.documents, ["doc_id"], "text", q, "part")
    return hit.groupBy("item_id", "doc_id").agg(F.countDistinct("k").alias("n")).where("n = 2").select("item_id", "doc_id")


def _quoted_lines(t):
    """(item_id, doc_id, line_no) of the lines that hold a whole quote."""
    return held_quotes(lines(t), ["doc_id", "line_no"], "line", t.benchmark.select("item_id", "text"), "text")


@query("ev5_first_line", f"SELECT item_id, doc_id, min(line_no)::BIGINT AS line_no FROM ({LINES}) l JOIN benchmark b ON contains(l.line, b.text) GROUP BY ALL")
def _(t):
    """The first line that holds a quote."""
    return _quoted_lines(t).groupBy("item_id", "doc_id").agg(F.min("line_no").alias("line_no"))


@query("ev6_offset_audit", f"WITH l AS (SELECT item_id, doc_id, line_no FROM ({LINES}) l JOIN benchmark b ON contains(l.line, b.text)) SELECT item_id, doc_id, min(abs(line_no - 2))::BIGINT AS off, min(abs(line_no - 2)) > 3 AS flagged FROM l GROUP BY ALL")
def _(t):
    """Distance of the nearest occurrence from the claimed place (line 2)."""
    d = F.min(F.abs(F.col("line_no") - 2))
    return _quoted_lines(t).groupBy("item_id", "doc_id").agg(d.alias("off"), (d > 3).alias("flagged"))


@query("ev8_references", "SELECT doc_id, list_sort(list_distinct(list_concat(regexp_extract_all(text, '[0-9]{4,}'), [doc_id::VARCHAR, source]))) AS refs FROM documents")
def _(t):
    """All references of a document: in its text, its own id, its source."""
    own = F.array(F.col("doc_id").cast("string"), "source")
    return t.documents.select("doc_id", F.array_sort(F.array_distinct(F.concat(F.regexp_extract_all("text", F.lit("[0-9]{4,}"), F.lit(0)), own))).alias("refs"))


@query("cu1_overlay", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status, o_orderkey % 10 = 0 AND o_orderstatus <> 'O' AS mismatch FROM orders WHERE o_orderkey % 11 <> 0")
def _(t):
    """Dropped by verdict; an overlay applies only where its ``from`` value holds, else it is a mismatch."""
    hit = F.col("o_orderkey") % 10 == 0
    return t.orders.where("o_orderkey % 11 <> 0").select("o_orderkey", F.when(hit & (F.col("o_orderstatus") == "O"), "F").otherwise(F.col("o_orderstatus")).alias("status"), (hit & (F.col("o_orderstatus") != "O")).alias("mismatch"))


@query("cu2_keep_demote_reject", "SELECT d.doc_id, CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 0 THEN 'demote' ELSE 'keep' END AS verdict, CASE WHEN quality = 0 AND toxic = 0 THEN '[unsure] ' || text ELSE text END AS claim FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    j = t.documents.select("doc_id", F.col("text").alias("c")).join(t.labels, "doc_id", "left")
    low = (F.col("quality") == 0) & (F.col("toxic") == 0)
    return j.select("doc_id", F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 0, "demote").otherwise("keep").alias("verdict"), F.when(low, F.concat(F.lit("[unsure] "), "c")).otherwise(F.col("c")).alias("claim"))


@query("cu3_idempotent_repair", "SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'Brand#one' ELSE p_brand END AS once, CASE p_brand WHEN 'Brand#1' THEN 'Brand#one' ELSE p_brand END AS twice FROM part")
def _(t):
    """A repair that was applied already changes nothing."""
    from loomwright.operators.curation import repair

    once = repair(F.col("p_brand"), "Brand#1", "Brand#one")
    return t.part.select("p_partkey", once.alias("once"), repair(once, "Brand#1", "Brand#one").alias("twice"))


@query("cu4_approved_gate", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    """Rows of batches that are approved; others are inert."""
    ok = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(ok, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("cu5_reverify", "SELECT d.doc_id, list_filter([CASE WHEN l.doc_id IS NULL THEN 'no_audit' END, CASE WHEN length(text) <> n_chars THEN 'drift' END, CASE WHEN sha256(text) LIKE '0%' THEN 'hash' END], lambda x: x IS NOT NULL) AS errors FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    j = t.documents.join(t.labels.select(F.col("doc_id").alias("a")), F.col("doc_id") == F.col("a"), "left")
    return j.select("doc_id", T.all_reasons(("no_audit", F.col("a").isNull()), ("drift", F.length("text") != F.col("n_chars")), ("hash", F.sha2("text", 256).startswith("0"))).alias("errors"))


@query("cu6_work_orders", "SELECT source, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last, sum(('0x' || sha256(doc_id::VARCHAR || ':' || sha256(text))[1:15])::BIGINT)::VARCHAR AS digest FROM documents GROUP BY source")
def _(t):
    """Work orders: a group's members, with a digest of their frozen texts that does not gather them."""
    h = F.conv(F.left(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.sha2("text", 256)), 256), F.lit(15)), 16, 10).cast("decimal(38,0)")
    g = t.documents.groupBy("source")
    return g.agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum(h).cast("string").alias("digest"))


@query("cu7_fix_plan", "SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 50 = 0 THEN 'manual' END, CASE WHEN quality = 0 THEN 'extracted' END, 'none') AS plan FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(toxic, 0) = 0")
def _(t):
    """Manual overrides beat extracted ones; removal beats all."""
    gone = t.labels.where("toxic = 1").select("doc_id")
    j = t.documents.select("doc_id").join(gone, "doc_id", "left_anti").join(t.labels, "doc_id", "left")
    return j.select("doc_id", F.coalesce(F.when(F.col("doc_id") % 50 == 0, "manual"), F.when(F.col("quality") == 0, "extracted"), F.lit("none")).alias("plan"))


@query("cu8_idempotent_append", "SELECT doc_id, source FROM documents WHERE NOT starts_with(source, 'src1') UNION ALL SELECT doc_id, source FROM documents WHERE starts_with(source, 'src1') AND n_chars > 500")
def _(t):
    """Rows of the batch's prefix are stripped, then the batch is added."""
    d = t.documents.select("doc_id", "source", "n_chars")
    return d.where("not startswith(source, 'src1')").unionByName(d.where("startswith(source, 'src1') and n_chars > 500")).select("doc_id", "source")


@query("cu9_cluster_documents", "SELECT o_custkey, count(*) AS members, count(DISTINCT o_orderstatus) > 1 AS conflict, list(o_orderkey ORDER BY o_orderkey)[1:8] AS first_members FROM orders GROUP BY o_custkey")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("members"), (F.countDistinct("o_orderstatus") > 1).alias("conflict"), F.slice(F.sort_array(F.collect_list("o_orderkey")), 1, 8).alias("first_members"))


@query("cu10_layers_to_track", "SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) AS layers, CASE WHEN list_sort(list(DISTINCT o_orderstatus)) = ['F'] THEN 'done' WHEN list_sort(list(DISTINCT o_orderstatus)) = ['F', 'O'] THEN 'both' ELSE 'other' END AS track FROM orders GROUP BY o_custkey")
def _(t):
    g = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderstatus")).alias("layers"))
    return g.withColumn("track", F.when(F.col("layers") == F.array(F.lit("F")), "done").when(F.col("layers") == F.array(F.lit("F"), F.lit("O")), "both").otherwise("other"))


@query("pr1_redact_known", r"WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+|[^0-9]+')) AS x, generate_subscripts(regexp_extract_all(text, '[0-9]+|[^0-9]+'), 1) AS i FROM documents), k AS (SELECT DISTINCT (c_custkey % 90 + 10)::VARCHAR AS id FROM customer) SELECT doc_id, string_agg(CASE WHEN id IS NOT NULL THEN '<id>' ELSE x END, '' ORDER BY i) AS redacted FROM w LEFT JOIN k ON x = id GROUP BY doc_id")
def _(t):
    """Known ids are masked where a whole digit run equals one: runs are rows, so ids are an equi-join."""
    from loomwright.operators.privacy import redact_known

    ids = t.customer.select((F.col("c_custkey") % 90 + 10).cast("string").alias("id")).distinct()
    return redact_known(t.documents, ids, "doc_id", "text", "id")


@query("pr2_shape_scrub")
def _(t):
    """Mail addresses, long digit runs and key=value secrets masked by shape (lookbehind: no SQL)."""
    from loomwright.operators.privacy import scrub_shapes

    return t.documents.select("doc_id", scrub_shapes(F.col("text")).alias("scrubbed"))


@query("pr3_leak_scan", r"SELECT doc_id, kind, hit, count(*) AS n FROM (SELECT doc_id, 'mail' AS kind, unnest(regexp_extract_all(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+')) AS hit FROM documents UNION ALL SELECT doc_id, 'secret', unnest(regexp_extract_all(text, '(?:password|token|key)=[0-9a-f]{8,}')) FROM documents UNION ALL SELECT doc_id, 'phone', unnest(regexp_extract_all(text, '\+[0-9]{2}[ -][0-9 -]{6,}')) FROM documents) WHERE NOT ends_with(hit, 'example.invalid') GROUP BY ALL")
def _(t):
    from loomwright.operators.privacy import leaks

    return leaks(t.documents, "doc_id", "text").where("not endswith(hit, 'example.invalid')").groupBy("doc_id", "kind", "hit").agg(F.count("*").alias("n"))


@query("pr4_path_leaks", "SELECT event_id, path, value FROM (SELECT event_id, unnest(json_keys(props)) AS path, unnest(list_transform(json_keys(props), lambda k: json_extract_string(props, '$.' || k))) AS value FROM events) WHERE regexp_matches(value, '[0-9]')")
def _(t):
    """Fields of a JSON value that hold digits, with their paths."""
    m = F.from_json("props", F.lit("map<string,string>"))
    return t.events.select("event_id", F.explode(m).alias("path", "value")).where(F.col("value").rlike("[0-9]"))


@query("pr5_pseudonym", "SELECT event_id, left(sha1(coalesce(nullif(user_id::VARCHAR, ''), nullif(event_type, ''), event_id::VARCHAR)), 8) AS speaker FROM events")
def _(t):
    key = F.coalesce(F.nullif(F.col("user_id").cast("string"), F.lit("")), F.nullif("event_type", F.lit("")), F.col("event_id").cast("string"))
    return t.events.select("event_id", F.substring(F.sha1(key), 1, 8).alias("speaker"))


@query("pr6_private_hits", "SELECT doc_id, n FROM (SELECT doc_id, (contains(text, '@'))::BIGINT + contains(text, 'password')::BIGINT + contains(text, '+49')::BIGINT AS n FROM documents) WHERE n > 0")
def _(t):
    n = sum(F.contains("text", F.lit(x)).cast("long") for x in ("@", "password", "+49"))
    return t.documents.select("doc_id", n.alias("n")).where("n > 0")


# --- sampling (a row's place in a sample is the order of a hash of its id and a seed) -------------------


def _md5(c: str, seed: str = "7"):
    return F.md5(F.concat(F.col(c).cast("string"), F.lit(f":{seed}")))


@query("sm1_seeded_sample", "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR || ':7'), doc_id LIMIT 50")
def _(t):
    return t.documents.select("doc_id").orderBy(_md5("doc_id"), "doc_id").limit(50)


@query("sm2_stratified", "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || ':7'), doc_id) AS k FROM documents WHERE n_chars > 100) WHERE k <= 10")
def _(t):
    return W.top_per_group(t.documents.where("n_chars > 100").select("lang", "doc_id"), ["lang"], [_md5("doc_id"), "doc_id"], 10)


@query("sm3_round_robin", "WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR || ':7'), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT doc_id, lang FROM r ORDER BY k, n DESC, lang LIMIT 40")
def _(t):
    w = Window.partitionBy("lang")
    r = t.documents.select("lang", "doc_id", F.row_number().over(w.orderBy(_md5("doc_id"), "doc_id")).alias("k"), F.count("*").over(w).alias("n"))
    return r.where("k <= 40").orderBy("k", F.desc("n"), "lang").limit(40).select("doc_id", "lang")


@query("sm4_fixed_plus_fill", "WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR || ':7'), doc_id) AS k, md5(doc_id::VARCHAR || ':7') AS h FROM documents) SELECT doc_id, source FROM r ORDER BY k > 2, h, doc_id LIMIT 60")
def _(t):
    """Two of each source, then others up to 60."""
    k = F.row_number().over(Window.partitionBy("source").orderBy(_md5("doc_id"), "doc_id"))
    r = t.documents.select("source", "doc_id", k.alias("k"), _md5("doc_id").alias("h"))
    return r.orderBy(F.col("k") > 2, "h", "doc_id").limit(60).select("doc_id", "source")


@query("sm5_group_shortfall", "SELECT source, count(*) AS have, greatest(0, 45 - count(*)) AS short FROM documents WHERE lang = 'en' GROUP BY source")
def _(t):
    return t.documents.where("lang = 'en'").groupBy("source").agg(F.count("*").alias("have"), F.greatest(F.lit(0).cast("long"), 45 - F.count("*")).alias("short"))


@query("sm7_quota_sample", "SELECT doc_id, quality FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::VARCHAR || ':7'), doc_id) AS k FROM labels) WHERE k <= CASE quality WHEN 1 THEN 12 ELSE 8 END")
def _(t):
    k = F.row_number().over(Window.partitionBy("quality").orderBy(_md5("doc_id"), "doc_id"))
    return t.labels.select("doc_id", "quality", k.alias("k")).where(F.col("k") <= F.when(F.col("quality") == 1, 12).otherwise(8)).drop("k")


# --- model steps: request cache and answer validation ---------------------------------------------------


@query("lm3_request_cache", "SELECT doc_id, sha256(lang || chr(0) || text) AS request FROM documents WHERE sha256(lang || chr(0) || text) NOT IN (SELECT sha256(lang || chr(0) || text) FROM documents WHERE doc_id % 2 = 0)")
def _(t):
    """Requests that no cached answer has: keyed by a fingerprint of their content."""
    r = t.documents.select("doc_id", F.sha2(F.concat("lang", F.lit("\0"), "text"), 256).alias("request"))
    return r.join(r.where("doc_id % 2 = 0").select("request"), "request", "left_anti").select("doc_id", "request")


@query("lm4_answer_ids", "WITH a AS (SELECT o_custkey AS bucket, o_orderkey AS issue, l_partkey AS member, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM orders JOIN lineitem ON o_orderkey = l_orderkey) SELECT member, bucket, issue FROM (SELECT *, row_number() OVER (PARTITION BY member ORDER BY bucket, issue, pos) AS k FROM a WHERE member IN (SELECT p_partkey FROM part WHERE p_size > 3)) WHERE k = 1")
def _(t):
    """Members that answers name: unknown ids go, the first issue that names one keeps it."""
    pos = F.row_number().over(Window.partitionBy("o_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    n = tasks_of(t.lineitem)
    orders = t.orders.select("o_custkey", "o_orderkey").repartition(n, "o_orderkey")
    lines_ = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(n, "l_orderkey")
    a = orders.join(lines_, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("bucket"), F.col("o_orderkey").alias("issue"), F.col("l_partkey").alias("member"), pos.alias("pos"))
    known = t.part.where("p_size > 3").select(F.col("p_partkey").alias("member")).repartition(n, "member")
    return J.first_of(a.repartition(n, "member").join(known, "member", "left_semi"), ["member"], ["bucket", "issue", "pos"]).select("member", "bucket", "issue")


@query("ex1_variant_matrix", "SELECT v, lang, count(*) AS n, sha256(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS signature FROM documents, (VALUES ('off', 0), ('short', 500), ('long', 2000)) x(v, floor) WHERE n_chars >= floor GROUP BY ALL")
def _(t):
    """The same selection under several variants, with a signature of what each gives."""
    x = F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.lit(f).alias("floor")) for v, f in (("off", 0), ("short", 500), ("long", 2000))]))
    d = t.documents.select("doc_id", "lang", "n_chars", x.alias("x")).where("n_chars >= x.floor")
    return d.groupBy(F.col("x.v").alias("v"), "lang").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("doc_id")), lambda i: i.cast("string")), ","), 256).alias("signature"))


@query("ex4_before_after", f"WITH r AS (SELECT user_id, event_type, sum(value) AS v FROM ({EVENTS}) WHERE event_id % 2 = 0 GROUP BY ALL), s AS (SELECT user_id, event_type, sum(value) AS v FROM ({EVENTS}) WHERE event_id % 2 = 1 GROUP BY ALL) SELECT coalesce(r.user_id, s.user_id) AS user_id, coalesce(r.event_type, s.event_type) AS event_type, round(coalesce(s.v, 0) - coalesce(r.v, 0), 4) AS change FROM r FULL JOIN s ON r.user_id = s.user_id AND r.event_type = s.event_type")
def _(t):
    part = lambda k: events(t).where(F.col("event_id") % 2 == k).groupBy("user_id", "event_type").agg(F.sum("value").alias(f"v{k}"))
    j = part(0).join(part(1), ["user_id", "event_type"], "full")
    return j.select("user_id", "event_type", F.round(F.coalesce("v1", F.lit(0.0)) - F.coalesce("v0", F.lit(0.0)), 4).alias("change"))


# --- smaller variants -----------------------------------------------------------------------------------


@query("sx2_span_fallback", "SELECT d.doc_id, coalesce(nullif(trim(text), ''), source) AS span, l.doc_id IS NOT NULL AS own FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    j = t.documents.join(t.labels.select(F.col("doc_id").alias("l")), F.col("doc_id") == F.col("l"), "left")
    return j.select("doc_id", F.coalesce(F.nullif(F.trim("text"), F.lit("")), "source").alias("span"), F.col("l").isNotNull().alias("own"))


@query("sx3_worklist", f"SELECT d.doc_id, count(*) AS context_lines FROM ({LINES}) d WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND line_no <= 4 GROUP BY d.doc_id")
def _(t):
    """Documents without a verdict, with their first lines."""
    return lines(t).where("line_no <= 4").join(t.labels, "doc_id", "left_anti").groupBy("doc_id").agg(F.count("*").alias("context_lines"))


@query("sx4_contiguous_block", "WITH b AS (SELECT conv_id, min(turn) AS lo, max(turn) AS hi FROM conversations WHERE role = 'assistant' GROUP BY conv_id) SELECT c.conv_id, c.turn, row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS seq, role = 'assistant' AS cited FROM conversations c JOIN b ON c.conv_id = b.conv_id AND turn BETWEEN lo AND hi")
def _(t):
    """From the first to the last cited turn, numbered anew."""
    w = Window.partitionBy("conv_id")
    own = F.when(F.col("role") == "assistant", F.col("turn"))
    c = t.conversations.withColumn("lo", F.min(own).over(w)).withColumn("hi", F.max(own).over(w)).where("turn between lo and hi")
    return c.select("conv_id", "turn", F.row_number().over(w.orderBy("turn")).cast("long").alias("seq"), (F.col("role") == "assistant").alias("cited"))


@query("sx5_unique_mapping", "SELECT p_type || p_size AS name, min(p_brand) AS brand FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) = 1")
def _(t):
    """Names that mean exactly one thing."""
    return t.part.groupBy(F.concat("p_type", F.col("p_size").cast("string")).alias("name")).agg(F.min("p_brand").alias("brand"), F.countDistinct("p_brand").alias("n")).where("n = 1").drop("n")


@query("sx7_drift_check", "SELECT source, count(*) AS n, count(DISTINCT doc_id) = count(*) AS unique_ids, max(n_chars) <= 50000 AS capped FROM documents GROUP BY source")
def _(t):
    return t.documents.groupBy("source").agg(F.count("*").alias("n"), (F.countDistinct("doc_id") == F.count("*")).alias("unique_ids"), (F.max("n_chars") <= 50000).alias("capped"))


@query("sx8_render_diff", "WITH a AS (SELECT conv_id, turn, text AS x FROM conversations), b AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN text || '!' ELSE text END AS y FROM conversations WHERE role <> 'system' UNION ALL SELECT conv_id, max(turn) + 1, 'end' FROM conversations GROUP BY conv_id) SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn, CASE WHEN y IS NULL THEN 'removed' WHEN x IS NULL THEN 'added' WHEN x = y THEN 'same' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn")
def _(t):
    """An old rendering and a new one (without system turns, even turns edited, an end added), whole texts compared."""
    a = t.conversations.select("conv_id", "turn", F.col("text").alias("x"))
    b = t.conversations.where("role <> 'system'").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("y"))
    b = b.unionByName(t.conversations.groupBy("conv_id").agg((F.max("turn") + 1).alias("turn")).withColumn("y", F.lit("end")))
    return a.join(b, ["conv_id", "turn"], "full").select("conv_id", "turn", F.when(F.col("y").isNull(), "removed").when(F.col("x").isNull(), "added").when(F.col("x") == F.col("y"), "same").otherwise("changed").alias("change"))


@query("sx11_correction_state", "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)license') THEN 'applied' WHEN regexp_matches(text, '(?i)stat') THEN 'not_needed' ELSE 'pending' END AS state FROM documents")
def _(t):
    return t.documents.select("doc_id", F.when(F.col("text").rlike("(?i)license"), "applied").when(F.col("text").rlike("(?i)stat"), "not_needed").otherwise("pending").alias("state"))


@query("sx12_patch_log", "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'huge' ELSE p_brand END AS brand, list_filter([CASE WHEN p_size > 40 THEN 'brand:' || p_brand || '->huge' END], lambda x: x IS NOT NULL) AS changes FROM part")
def _(t):
    big = F.col("p_size") > 40
    return t.part.select("p_partkey", F.when(big, "huge").otherwise(F.col("p_brand")).alias("brand"), F.array_compact(F.array(F.when(big, F.concat(F.lit("brand:"), "p_brand", F.lit("->huge"))))).alias("changes"))


@query("sx13_structural_flags", "SELECT l_orderkey, list_bool_or(list_transform(q, lambda x: x > 45)) AS any_high, list_bool_and(list_transform(q, lambda x: x > 5)) AS all_over_5 FROM (SELECT l_orderkey, list(l_quantity) AS q FROM lineitem GROUP BY 1)")
def _(t):
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("q"))
    return g.select("l_orderkey", F.exists("q", lambda x: x > 45).alias("any_high"), F.forall("q", lambda x: x > 5).alias("all_over_5"))


@query("sx16_traceability", "SELECT l_orderkey, CASE WHEN bool_and(p_size > 10) THEN 'full' WHEN bool_or(p_size > 10) THEN 'part' ELSE 'none' END AS traced FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey")
def _(t):
    ok = F.col("p_size") > 10
    j = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("l_orderkey").agg(F.when(F.bool_and(ok), "full").when(F.bool_or(ok), "part").otherwise("none").alias("traced"))


@query("sx18_quote_near_time", f"SELECT a.event_id, min(abs(a.s - b.s)) AS off FROM ({EVENTS}) a JOIN ({EVENTS}) b ON a.user_id = b.user_id AND a.event_id <> b.event_id AND left(a.event_type, 4) = left(b.event_type, 4) AND b.s BETWEEN a.s - 7200 AND a.s + 7200 GROUP BY a.event_id")
def _(t):
    """The nearest event of equal beginning within two hours."""
    e = events(t).withColumn("h", F.substring("event_type", 1, 4)).select("event_id", "user_id", "s", "h")
    r = e.select("event_id", "user_id", "h", F.col("s").alias("c"), (F.col("s") - 7200).alias("lo"), (F.col("s") + 7200).alias("hi"))
    p = J.in_range(e.withColumnRenamed("event_id", "other"), r, ["user_id", "h"], "s", "lo", "hi", 7200).where("other <> event_id")
    return p.groupBy("event_id").agg(F.min(F.abs(F.col("s") - F.col("c"))).alias("off"))


@query("sx20_quarantine", "SELECT d.doc_id, CASE WHEN quality = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS weight FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(toxic, 0) <> 1")
def _(t):
    """Dropped, downweighted or kept."""
    kept = t.documents.select("doc_id").join(t.labels.where("toxic = 1"), "doc_id", "left_anti")
    return kept.join(t.labels, "doc_id", "left").select("doc_id", F.when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


@query("sx23_next_ids", "SELECT p_name, (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY p_name) AS new_id FROM (SELECT DISTINCT upper(p_name) AS p_name FROM part)")
def _(t):
    """New entries continue the sequence after the largest id."""
    top = t.part.agg(F.max("p_partkey").alias("m"))  # one row
    n = W.place_in_order(t.part.select(F.upper("p_name").alias("p_name")).distinct(), ["p_name"], "place")
    return n.crossJoin(F.broadcast(top)).select("p_name", (F.col("m") + F.col("place")).alias("new_id"))


@query("sx25_label_coverage", "SELECT 'missing' AS kind, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'extra', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'bad', count(*) FROM labels WHERE toxic NOT IN (0, 1)")
def _(t):
    n = lambda kind, df: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    d = t.documents.select("doc_id")
    return n("missing", d.join(t.labels, "doc_id", "left_anti")).unionByName(n("extra", t.labels.join(d, "doc_id", "left_anti"))).unionByName(n("bad", t.labels.where(~F.col("toxic").isin(0, 1))))


@query("sx32_cascade_delete", "SELECT o_orderkey, list_filter(list(l_suppkey ORDER BY l_linenumber, l_suppkey), lambda x: x % 7 <> 0) AS suppliers FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey % 13 <> 0 GROUP BY o_orderkey")
def _(t):
    """A sender's rows go, and its ids go from arrays; repeats stay."""
    j = t.orders.where("o_custkey % 13 <> 0").select("o_orderkey").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    a = j.groupBy("o_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("a"))
    return a.select("o_orderkey", F.filter(F.transform("a", lambda s: s["l_suppkey"]), lambda x: x % 7 != 0).alias("suppliers"))


@query("sx34_clue_score", "SELECT doc_id, contains(text, 'the')::BIGINT + contains(text, 'license')::BIGINT + CASE WHEN regexp_matches(text, '[0-9]') THEN 2 ELSE 0 END AS score FROM documents")
def _(t):
    return t.documents.select("doc_id", (F.contains("text", F.lit("the")).cast("long") + F.contains("text", F.lit("license")).cast("long") + F.when(F.col("text").rlike("[0-9]"), 2).otherwise(0)).alias("score"))


@query("sx39_ledger_join", "SELECT coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic, count(*) AS n, count(DISTINCT d.doc_id) AS ids FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL")
def _(t):
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "full")
    return j.groupBy(F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))
