"""Queries of sources and sinks: a table is written to the shared folder in the source's format and read back; and of
functions over one record's text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.functions import answers as A
from loomwright.functions import records as X
from loomwright.functions import text as T
from loomwright.functions.sequential import numeral_rewriter
from loomwright.operators import external
from loomwright.session import new_folder, spread, written
from loomwright.sources import sinks
from loomwright.sources import transcripts as S

from .registry import query
from .window_queries import EVENTS


def _lines_file(df, what: str) -> str:
    """A text column written as lines to a new folder."""
    path = new_folder(df.sparkSession, what)
    df.write.text(path)
    return path


@query("src1_jsonl", "SELECT doc_id, lang, n_chars, text FROM documents")
def _(t):
    """JSON Lines with blank lines between the rows."""
    rows = t.documents.select(F.explode(F.array(F.to_json(F.struct("doc_id", "lang", "n_chars", "text")), F.lit(""), F.lit("  "))).alias("value"))
    return S.read_jsonl(t.spark, _lines_file(rows, "jsonl"), "doc_id long, lang string, n_chars long, text string")


@query("src2_nested", "SELECT r_regionkey, r_name, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) - 1 AS pos, n_nationkey, n_name FROM region JOIN nation ON r_regionkey = n_regionkey")
def _(t):
    """Whole JSON files, one for each region, with an array of nations."""
    inner = F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("nations")
    whole = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_regionkey", "r_name").agg(inner)
    path = new_folder(t.spark, "nested")
    whole.select(F.replace(F.to_json(F.struct("*")), F.lit(","), F.lit(",\n")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    nested = S.read_nested(t.spark, path, "r_regionkey int, r_name string, nations array<struct<n_nationkey int, n_name string>>", "nations")
    return nested.withColumn("pos", F.col("pos").cast("long"))


def _chat_csv(t) -> str:
    """Events as a chat export: a byte order mark, Chinese heads, quoted line feeds; a file for each kind, in order of
    the ids, of which every tenth is empty."""
    e = t.events.select(
        F.when(F.col("event_id") % 10 != 0, F.col("event_id")).cast("string").alias("﻿消息ID"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("发送时间"), F.col("user_id").alias("发送者"),
        F.concat(F.lit('sagt "'), "props", F.lit('",\nsagt er')).alias("内容"), "event_type", "event_id",
    )
    path = new_folder(t.spark, "chat")
    e.repartition("event_type").sortWithinPartitions("event_type", "event_id").drop("event_id").write.partitionBy("event_type").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return f"{path}/event_type=*"


COLUMNS = ["msg_id", "sent_at", "sender", "text"]


@query("src3_chat_csv", f"WITH e AS (SELECT event_type, event_id, s, lag(s) OVER (PARTITION BY event_type ORDER BY event_id) AS before FROM (SELECT * FROM ({EVENTS})) x) SELECT event_type AS kind, count(*) AS logical, 2 * count(*) + 1 AS physical, count(*) FILTER (event_id % 10 = 0) AS empty_ids, count(*) FILTER (s < before) AS out_of_order FROM e GROUP BY event_type")
def _(t):
    """Logical and physical lines, empty ids and steps back in time of each exported file."""
    return S.chat_csv_stats(t.spark, _chat_csv(t), COLUMNS).select(F.regexp_extract("file", "event_type=([^/]+)", 1).alias("kind"), "logical", "physical", "empty_ids", "out_of_order")


@query("src4_verbatim_rows", "SELECT CASE WHEN event_id % 10 <> 0 THEN event_id::VARCHAR END AS msg_id, epoch(date_trunc('second', ts))::BIGINT AS ts, 'sagt \"' || props || '\",' || chr(10) || 'sagt er' AS text, event_id % 10 <> 0 AS known FROM events")
def _(t):
    """Ids, times and verbatim texts, and whether the id is in the export's set of identities."""
    rows = S.read_chat_csv(t.spark, _chat_csv(t), COLUMNS).select("msg_id", "ts", "text")
    identities = rows.where("msg_id is not null").select(F.col("msg_id").alias("id")).distinct().withColumn("known", F.lit(True))
    return rows.join(identities, F.col("msg_id") == F.col("id"), "left").select("msg_id", "ts", "text", F.coalesce("known", F.lit(False)).alias("known"))


@query("src7_json_values", "SELECT n_regionkey AS region, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS pos, n_nationkey::BIGINT AS k, n_name || chr(10) || 'x' AS name FROM nation")
def _(t):
    """JSON values one after the other in a file, with line feeds in strings."""
    value = F.concat(F.lit('{"k": '), "n_nationkey", F.lit(', "r": '), "n_regionkey", F.lit(', "name": "'), "n_name", F.lit('\nx"}'))
    files = t.nation.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", value.alias("v")))).alias("a"))
    path = new_folder(t.spark, "values")
    files.select(F.array_join(F.transform("a", lambda x: x["v"]), " \n").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    field = lambda k: F.get_json_object("value", f"$.{k}")
    return S.read_json_values(t.spark, path).select(field("r").cast("int").alias("region"), F.col("pos").cast("long").alias("pos"), field("k").cast("long").alias("k"), field("name").alias("name"))


@query("src8_many_files", "SELECT doc_id, source AS stem FROM documents WHERE source <> 'src0'")
def _(t):
    """Files of many stems, one stem left out by its name."""
    path = new_folder(t.spark, "stems")
    t.documents.select("doc_id", "source").write.partitionBy("source").json(path)
    return S.read_many(t.spark, f"{path}/source=*", "doc_id long", exclude="^src0$", stem="source=([^/]+)/")


_AFTER = "count(*) FILTER (known) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@query("src10_stop_after_known", f"WITH e AS (SELECT user_id, event_id, event_type = 'view' AS known FROM events), r AS (SELECT *, {_AFTER} = 3 AS full_run FROM e), s AS (SELECT *, coalesce(bool_or(full_run) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM r) SELECT user_id, event_id FROM s WHERE NOT stopped AND NOT known")
def _(t):
    """New rows of a listing, which is read until three known ones in a row have come."""
    e = t.events.select("user_id", "event_id", (F.col("event_type") == "view").alias("known"))
    return S.new_until_known(e, ["user_id"], ["event_id"], "known", 3).select("user_id", "event_id")


@query("src11_page_links", "SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS link FROM pages")
def _(t):
    """Links of a crawled page."""
    return t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("link"))


@query("snk1_jsonl_drop", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(t):
    """JSON Lines without a key; what is read back has the keys of the file."""
    path = new_folder(t.spark, "sink")
    sinks.write_jsonl(t.documents, path, drop=("text",))
    return t.spark.read.json(path).select("*")


@query("snk2_replace", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def _(t):
    """A table replaced by a newer version; readers follow the returned path."""
    path = new_folder(t.spark, "replaced")
    sinks.replace_table(t.orders.select("o_orderkey", "o_totalprice"), path, "1")
    return t.spark.read.parquet(sinks.replace_table(t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice"), path, "2"))


@query("snk3_append_log", "SELECT event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type")
def _(t):
    """An event log that two writers append to."""
    path = new_folder(t.spark, "log")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        sinks.append_events(t.events.where(part), path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@query("val5_json_sweep", "SELECT source, count(*) AS bad_lines FROM documents WHERE doc_id % 10 = 0 GROUP BY source")
def _(t):
    """Lines that are no JSON, by file; every tenth row is cut short."""
    row = F.to_json(F.struct("doc_id", "text"))
    path = new_folder(t.spark, "sweep")
    t.documents.select("source", F.when(F.col("doc_id") % 10 == 0, F.left(row, F.length(row) - 1)).otherwise(row).alias("value")).write.partitionBy("source").text(path)
    found = S.malformed(t.spark, f"{path}/source=*")
    return found.groupBy(F.regexp_extract("file", "source=([^/]+)/", 1).alias("source")).agg(F.sum("bad_lines").alias("bad_lines"))


@query("sx10_batches", "SELECT (doc_id % 5)::BIGINT AS batch, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    """Batches found by the pattern of their files."""
    path = new_folder(t.spark, "batches")
    sinks.write_batches(t.documents.select("doc_id", (F.col("doc_id") % 5).alias("batch")), path, "batch")
    found = S.read_many(t.spark, f"{path}/batch=*", "doc_id long", stem="batch=([0-9]+)/")
    return found.groupBy(F.col("stem").cast("long").alias("batch")).agg(F.count("*").alias("n"))


@query("ex5_build_twice", "WITH b AS (SELECT l_partkey, l_returnflag, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY ALL) SELECT side, 0::BIGINT AS n, (SELECT count(*) FROM b) AS built FROM (VALUES ('first'), ('second')) s(side)")
def _(t):
    """Two builds of a table, the second from other partitions in another order, each stored: rows that only one of them has, of how
    many."""
    build = lambda df, what: written(df.groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n")), what)
    a, b = build(t.lineitem, "first"), build(t.lineitem.repartition(13, "l_suppkey").sortWithinPartitions(F.desc("l_extendedprice")), "second")
    n = lambda x, y, side: x.exceptAll(y).agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n", F.lit(x.count()).alias("built"))
    return n(a, b, "first").unionByName(n(b, a, "second"))


@query("src12_stream_deltas", "SELECT conv_id, turn, coalesce(text, '') AS text, 'u' || length(text) AS usage FROM conversations")
def _(t):
    """Texts put together again from a service's event stream."""
    half = F.floor(F.length("text") / 2).cast("int")
    event = lambda c: F.to_json(F.struct(F.array(F.struct(F.struct(c.alias("content")).alias("delta"))).alias("choices")))
    last = F.to_json(F.struct(F.array(F.struct(F.struct(F.substr("text", half + 1).alias("content")).alias("message"))).alias("choices"), F.concat(F.lit("u"), F.length("text")).alias("usage")))
    stream = F.concat_ws("\n", F.lit(": note"), F.concat(F.lit("data: "), event(F.left("text", half))), F.lit("data: {broken"), F.lit("event: x"), F.concat(F.lit("data:"), last), F.lit("data: [DONE]"), F.lit('data: {"usage": 1}'))
    return t.conversations.select("conv_id", "turn", T.stream_answer(stream).alias("a")).select("conv_id", "turn", "a.*")


@query("snk7_markdown", "WITH g AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT 1 AS place, '| lang | n |' AS line UNION ALL SELECT 2, '| --- | --- |' UNION ALL SELECT 2 + row_number() OVER (ORDER BY lang), '| ' || lang || ' | ' || n || ' |' FROM g")
def _(t):
    """A report's table as lines."""
    return sinks.markdown(t.documents.groupBy("lang").agg(F.count("*").alias("n")), ["lang"]).select(F.col("place").cast("long").alias("place"), "line")


@query("sx41_template_fill", "SELECT n_nationkey, 'N <!--v:name-->' || n_name || '<!--/v-->: <!--v:customers-->' || count(c_custkey) || '<!--/v--> of <!--v:total-->?<!--/v-->' AS filled, ['total'] AS unknown, n_name <> 'FRANCE' OR count(c_custkey) <> 0 AS drift FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name")
def _(t):
    """Figures in a document filled in; unknown marks stay and are told; drift from what stood there."""
    n = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey"), "left").groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("n"))
    stored = F.lit("N <!--v:name-->FRANCE<!--/v-->: <!--v:customers-->0<!--/v--> of <!--v:total-->?<!--/v-->")
    filled, unknown = T.fill_marks(stored, {"name": F.col("n_name"), "customers": F.col("n")})
    return n.select("n_nationkey", filled.alias("filled"), unknown.alias("unknown"), (filled != stored).alias("drift"))


@query("sx42_retry_clips", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS position, CASE event_type WHEN 'view' THEN 'wav' ELSE 'm4a' END AS format, event_id % 3 + 1 AS attempt FROM events WHERE event_type <> 'purchase'")
def _(t):
    """Failed clips with their place in their file, the format they are tried in again, and the attempt."""
    failed = t.events.where("event_type <> 'purchase'")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return failed.select("user_id", "event_id", place.cast("long").alias("position"), F.when(F.col("event_type") == "view", "wav").otherwise("m4a").alias("format"), (F.col("event_id") % 3 + 1).alias("attempt"))


# --- one record's text -------------------------------------------------------------------------------


@query("tx3_literal_variants", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN [p_brand || 'x', p_brand || 'y', p_type] WHEN p_partkey % 3 = 1 THEN [p_brand || 'aA', p_brand || 'aB', p_brand || 'bA', p_brand || 'bB'] ELSE []::VARCHAR[] END AS variants FROM part")
def _(t):
    """Alternatives and classes of patterns as literals; other patterns have none."""
    brand = F.col("p_brand")
    pattern = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("(?<!x)"), brand, F.lit("[xy]|"), "p_type")).when(F.col("p_partkey") % 3 == 1, F.concat(brand, F.lit("[ab][AB]"))).otherwise(F.concat(brand, F.lit("[a-z]+")))
    return t.part.select("p_partkey", X.variants(pattern).alias("variants"))


@query("tx4_numeral_values", "SELECT o_orderkey, floor(o_totalprice)::BIGINT * 97 % 100000000 AS value FROM orders")
def _(t):
    """Numbers of up to eight places written as numerals, and read again."""
    n = F.floor("o_totalprice") * 97 % 100_000_000
    return t.orders.select("o_orderkey", A.written_numeral(n).alias("numeral")).select("o_orderkey", A.numeral_value(F.col("numeral")).alias("value"))


@query("tx4_two_grammars", "SELECT o_orderkey, CASE WHEN n < 100 OR n % 100 = 0 OR n % 100 >= 10 THEN n::VARCHAR END AS plain, CASE WHEN n = 0 OR n >= 100 OR (n > 30 AND n % 10 > 0) THEN NULL ELSE n::VARCHAR || '.' || right(n::VARCHAR, 1) END AS spoken FROM (SELECT o_orderkey, floor(o_totalprice)::BIGINT % 1000 AS n FROM orders)")
def _(t):
    """Numerals of up to three places in the plain grammar, and with a decimal in the spoken one."""
    n = F.floor("o_totalprice") % 1000
    x = t.orders.select("o_orderkey", "o_totalprice", A.written_numeral(n).alias("numeral"), A.written_numeral(n % 10).alias("last"))
    spoken = A.spoken_numeral(F.concat("numeral", F.lit("点"), "last"))
    return x.select("o_orderkey", A.plain_numeral(F.col("numeral")).alias("plain"), F.when(n > 0, spoken).alias("spoken"))


@query("tx5_numeral_rewrite", "SELECT o_orderkey, '第' || floor(o_totalprice)::BIGINT || '章，一起看' || o_orderpriority || '、' || o_orderkey % 900 || '次，千万别忘' AS rewritten FROM orders")
def _(t):
    """Numerals in running text as digits; words that hold a numeral's characters are protected."""
    text = F.concat(F.lit("第"), A.written_numeral(F.floor("o_totalprice")), F.lit("章，一起看"), "o_orderpriority", F.lit("、"), A.written_numeral(F.col("o_orderkey") % 900), F.lit("次，千万别忘"))
    return t.orders.select("o_orderkey", numeral_rewriter(("一起", "千万"))(text).alias("rewritten"))


@query("pr7_report_names", "SELECT c_custkey, '参与者: @sp' || n_nationkey || '、某人' || chr(10) || '🏆 群友称号' || chr(10) || '• @sp' || n_nationkey || ' - ' || c_mktsegment || chr(10) || '💬 群圣经' || chr(10) || '1. \"' || n_name || '\" —— 某人' || chr(10) || n_name || ' —— ' || c_name || chr(10) || '📊 ' || n_name || chr(10) || '• ' || n_name || ' - x' AS redacted FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    """Names in a report's slots; the same names in prose and in other sections stay."""
    n, nl = F.col("n_name"), F.lit("\n")
    report = F.concat(F.lit("参与者: "), n, F.lit("、"), "c_name", nl, F.lit("🏆 群友称号\n• "), n, F.lit(" - "), "c_mktsegment", nl, F.lit('💬 群圣经\n1. "'), n, F.lit('" —— '), "c_name", nl, n, F.lit(" —— "), "c_name", nl, F.lit("📊 "), n, nl, F.lit("• "), n, F.lit(" - x"))
    speakers = {r["n_name"]: f"sp{r['n_nationkey']}" for r in t.nation.collect()}  # a stated table of 25 rows
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", X.report_redactor(speakers)(report).alias("redacted"))


#: Answers of several shapes, made of a part's columns: what stands for the title, the rules and the other fields.
_ANSWER = """CASE WHEN p_partkey % 11 = 0 THEN '[' || p_size || ']' WHEN p_partkey % 13 = 0 THEN '{"title": ' || p_name ELSE
    '{"title": "' || CASE WHEN p_size % 9 = 0 THEN '' ELSE p_name END || '", "rules": ' ||
    CASE p_size % 5 WHEN 0 THEN '[]' WHEN 1 THEN '"' || p_type || '"' WHEN 2 THEN '["' || p_type || '", " ", "' || p_brand || ' "]'
        WHEN 3 THEN '[{"text": " ' || p_type || '", "scope": "' || CASE WHEN p_partkey % 2 = 0 THEN 'example' ELSE 'instance' END || '"}, {"text": ""}, 7, "' || p_brand || '"]' ELSE 'null' END ||
    CASE WHEN p_partkey % 3 = 0 THEN ', "scope": "' || CASE WHEN p_size % 2 = 0 THEN 'instance' ELSE 'other' END || '"' ELSE '' END ||
    CASE WHEN p_partkey % 7 = 0 THEN ', "kind": "' || CASE WHEN p_size % 2 = 0 THEN 'pending' ELSE 'x' END || '"' ELSE '' END ||
    CASE WHEN p_partkey % 4 = 0 THEN ', "confidence": "high"' WHEN p_partkey % 4 = 1 THEN ', "confidence": 3' ELSE '' END || '}' END"""


@query(
    "sx35_normal_answers",
    f"""WITH a AS (SELECT p_partkey, {_ANSWER} AS s FROM part), j AS (SELECT p_partkey, s, CASE WHEN json_valid(s) THEN s::JSON END AS j FROM a),
        r AS (SELECT p_partkey, i, json_type(x) AS ty, trim(CASE json_type(x) WHEN 'VARCHAR' THEN x->>'$' WHEN 'OBJECT' THEN x->>'$.text' END) AS tx, CASE WHEN json_type(x) = 'OBJECT' THEN x->>'$.scope' END AS sc
              FROM (SELECT p_partkey, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM (SELECT p_partkey, json_extract(j, '$.rules[*]') AS x FROM j WHERE json_type(j, '$.rules') = 'ARRAY'))),
        g AS (SELECT p_partkey, list(tx ORDER BY i) AS rules, list(sc) AS scs FROM r WHERE tx <> '' GROUP BY p_partkey),
        f AS (SELECT j.p_partkey, j->>'$.title' AS title, CASE WHEN json_type(j, '$.scope') = 'VARCHAR' THEN j->>'$.scope' END AS st, j->>'$.kind' AS kd, CASE WHEN json_type(j, '$.confidence') = 'VARCHAR' THEN j->>'$.confidence' END AS cf, coalesce(rules, []) AS rules, coalesce(scs, []) AS scs,
              CASE WHEN j IS NULL THEN 'not json' WHEN json_type(j) <> 'OBJECT' THEN 'not an object' WHEN coalesce(j->>'$.title', '') = '' THEN 'no title' WHEN json_type(j, '$.rules') NOT IN ('ARRAY', 'NULL') THEN 'rules are no list' END AS error FROM j LEFT JOIN g USING (p_partkey))
        SELECT p_partkey, CASE WHEN error IS NULL THEN title END AS title, CASE WHEN error IS NULL THEN CASE WHEN kd IN ('mechanism', 'experiment', 'reject', 'pending') THEN kd WHEN len(rules) = 0 THEN 'reject' WHEN st = 'instance' THEN 'experiment' ELSE 'mechanism' END END AS kind,
               CASE WHEN error IS NULL THEN CASE WHEN cf IN ('high', 'mid', 'low') THEN cf ELSE 'low' END END AS confidence,
               CASE WHEN error IS NULL THEN CASE WHEN st = 'instance' THEN st WHEN list_contains(scs, 'example') THEN 'example' WHEN list_contains(scs, 'instance') THEN 'instance' ELSE 'universal' END END AS scope,
               CASE WHEN error IS NULL THEN rules END AS rules, error FROM f""",
)
def _(t):
    """Model answers in one shape."""
    return spread(t.part).select("p_partkey", A.answer(F.expr(_ANSWER)).alias("a")).select("p_partkey", "a.*")


#: Suggestions of one and more clauses, made of a part's columns.
_SUGGESTION = """CASE p_size % 8 WHEN 0 THEN 'claim 改为「' || p_name || '「' || p_type || '」' || p_partkey || '」' WHEN 1 THEN 'subject 写作「' || p_name || '」，condition 改成「' || p_type || ' ' || p_size || '」' WHEN 2 THEN 'claim 末尾补「' || p_type || ' ' || p_partkey || '.5」'
    WHEN 3 THEN '无需改，' || p_name || p_name WHEN 4 THEN p_name || ' ' || p_type || ' ' || p_partkey WHEN 5 THEN '末句改为「' || p_type || '」' WHEN 6 THEN 'condition 改成「' || p_name ELSE 'claim 改为「' || p_name || '」；claim 改为「' || p_type || p_size || '。」。scope 写作「' || p_brand || '」' END"""
_CLAUSE = A.CLAUSE.replace("'", "''")


@query(
    "sx37_fix_plans",
    f"""WITH s AS (SELECT *, {_SUGGESTION} AS s, p_name || '；' || p_size AS old FROM part), c AS (SELECT p_partkey, unnest(regexp_extract_all(s, '{_CLAUSE}', 1)) AS about, unnest(regexp_extract_all(s, '{_CLAUSE}', 2)) AS wording, unnest(regexp_extract_all(s, '{_CLAUSE}', 3)) AS value, unnest(range(1, 9)) AS pos FROM s),
        d AS (SELECT p_partkey, pos, value, CASE WHEN contains(about, '末句') OR contains(about, 'claim') THEN 'claim' WHEN contains(about, 'subject') THEN 'subject' WHEN contains(about, 'condition') THEN 'condition' WHEN contains(about, 'scope') THEN 'scope' END AS field, CASE WHEN contains(about, '末句') THEN 'last' WHEN wording = '补' THEN 'append' ELSE 'replace' END AS action FROM c WHERE value <> ''),
        e AS (SELECT p_partkey, {", ".join(f"arg_max(value, pos) FILTER (field = '{f}') AS {f}_" for f in A.FIELDS)}, arg_max(action, pos) FILTER (field = 'claim') AS action FROM d GROUP BY p_partkey),
        w AS (SELECT s.*, e.*, e.p_partkey IS NULL AND length(trim(s)) >= 10 AND NOT contains(s, '无需改') AS whole FROM s LEFT JOIN e USING (p_partkey)),
        n AS (SELECT *, CASE action WHEN 'append' THEN old || claim_ WHEN 'last' THEN regexp_extract(old, '^[^。？！；]*') || '。' || claim_ || '。' WHEN 'replace' THEN claim_ ELSE CASE WHEN whole THEN trim(s) END END AS claim FROM w)
        SELECT p_partkey, claim, subject_ AS subject, condition_ AS condition, scope_ AS scope, CASE WHEN action IS NOT NULL THEN action WHEN whole THEN 'whole' WHEN coalesce(subject_, condition_, scope_) IS NOT NULL THEN 'fields' ELSE 'none' END AS mode,
               list_filter(list_sort(list_distinct(regexp_extract_all(concat_ws(' ', claim, subject_, condition_, scope_), '{A.NUMBER}'))), lambda x: NOT contains(concat_ws(' ', old, p_brand, p_type), x)) AS new_numbers FROM n""",
)
def _(t):
    """Suggested changes as new values by field."""
    old = {"claim": F.concat("p_name", F.lit("；"), "p_size"), "subject": F.col("p_brand"), "condition": F.col("p_type")}
    return spread(t.part).select("p_partkey", A.suggested(F.expr(_SUGGESTION), old).alias("f")).select("p_partkey", "f.*")


@query("lm1_external_calls", "SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE CASE p_partkey % 4 WHEN 2 THEN 'second' ELSE 'first' END || ':' || p_name END AS answer, CASE WHEN p_partkey % 4 >= 2 THEN 'second' ELSE 'first' END AS model, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 2 END AS tries, CASE p_partkey % 4 WHEN 3 THEN 400 ELSE 200 END AS status FROM part")
def _(t):
    """Calls over an injected client that answers at once, after a 429, with the second model only, or never."""

    def client():
        seen: dict[str, int] = {}

        def call(model: str, prompt: str) -> tuple[int, str]:
            kind, text = prompt.split(":", 1)
            seen[prompt] = seen.get(prompt, 0) + 1
            if kind == "3":
                return 400, ""
            if kind == "1" and seen[prompt] == 1:
                return 429, ""
            return 200, "" if kind == "2" and model == "first" else f"{model}:{text.split('#')[0]}"

        return call

    prompts = t.part.select("p_partkey", F.concat((F.col("p_partkey") % 4).cast("string"), F.lit(":"), "p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("prompt"))
    return external.ask_all(prompts, "p_partkey", "prompt", client, ("first", "second"))
