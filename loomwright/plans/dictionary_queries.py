"""Queries that link texts with a table of terms, or rewrite them by a table of rules. Both tables come from the texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.operators import dictionary as D
from loomwright.operators import rewriting as W
from loomwright.operators.windows import top_per_group
from loomwright.session import written

from .registry import query
from .text_queries import lines

#: A term is a word of six letters or more that two documents hold: a canonical name for its beginning, a type for its length.
_TERMS = "terms AS (SELECT w AS term, upper(left(w, 5)) AS canonical, length(w) % 4 AS type FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS w FROM documents) GROUP BY w HAVING count(*) >= 2)"
#: Terms are letters only, so they occur in runs of letters: where a term begins in a distinct run, and the documents of each run.
_RUNS = """runs AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS run FROM documents), kinds AS (SELECT DISTINCT run FROM runs WHERE length(run) >= 6),
    parts AS (SELECT run, i, substr(run, i, l) AS term FROM (SELECT run, i, unnest(range(6, length(run) - i + 2)) AS l FROM (SELECT run, unnest(range(1, length(run) - 4)) AS i FROM kinds))),
    found AS (SELECT run, i, term FROM parts JOIN (SELECT DISTINCT term FROM terms) USING (term)), held AS (SELECT DISTINCT doc_id, term FROM runs JOIN found USING (run))"""


def _words(t, least: int):
    return F.regexp_extract_all(F.lower("text"), F.lit(f"[a-z]{{{least},}}"), F.lit(0))


def terms_of(t):
    """(term, canonical, type). Two documents hold a word where their ids differ, so no (document, word) rows are shuffled."""
    words = t.documents.select("doc_id", F.explode(_words(t, 6)).alias("term")).groupBy("term")
    ids = words.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.max(F.col("doc_id").isNull()).alias("none"))
    held = written(ids.where("a <> b OR (none AND a IS NOT NULL)").select("term"), "terms")
    return held.select("term", F.upper(F.substring("term", 1, 5)).alias("canonical"), (F.length("term") % 4).alias("type"))


def _low(t, *columns: str):
    return t.documents.select("doc_id", *columns, F.lower("text").alias("low"))


@query("tx11_vocabulary_hits", f"WITH {_TERMS}, {_RUNS}, h AS (SELECT doc_id, list(term ORDER BY length(term) DESC, term) AS hits FROM held GROUP BY doc_id) SELECT doc_id, coalesce(hits, []) AS hits FROM documents LEFT JOIN h USING (doc_id)")
def _(t):
    """Terms of a vocabulary that a text holds, whatever the case, the longest first, then as the vocabulary has them."""
    held = D.held_terms(_low(t), ["doc_id"], "low", terms_of(t).select("term"), "term", repeated=True).select("doc_id", "term")
    ordered = F.transform(F.sort_array(F.collect_set(F.struct((-F.length("term")).alias("n"), "term"))), lambda x: x["term"])
    hits = held.groupBy("doc_id").agg(ordered.alias("hits"))
    return t.documents.select("doc_id").join(hits, "doc_id", "left").select("doc_id", F.coalesce("hits", F.array().cast("array<string>")).alias("hits"))


@query("ir8_glossary_documents", f"WITH {_TERMS}, {_RUNS} SELECT term, doc_id FROM (SELECT term, doc_id, row_number() OVER (PARTITION BY term ORDER BY n_chars DESC, doc_id) AS k FROM held JOIN documents USING (doc_id)) WHERE k <= 30")
def _(t):
    """Documents that hold a glossary term, the 30 longest of each: their runs of letters meet all terms at once."""
    held = D.held_terms(_low(t, "n_chars"), ["doc_id", "n_chars"], "low", terms_of(t).select("term"), "term")
    return top_per_group(held, ["term"], [F.desc("n_chars"), "doc_id"], 30).select("term", "doc_id")


@query(
    "en3_back_scan",
    f"""WITH {_TERMS}, {_RUNS}, b AS (SELECT doc_id, canonical, min((-length(term), term)) AS m FROM held JOIN terms USING (term) JOIN documents USING (doc_id) WHERE lang <> 'en' GROUP BY ALL)
        SELECT doc_id, canonical, m[2] AS term, k AS place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY m, canonical) AS k FROM b) WHERE k <= 15""",
)
def _(t):
    """Names that documents without links (here those of other languages) hold, by their longest mention, 15 of each document."""
    held = D.held_terms(_low(t, "lang").where("lang <> 'en'"), ["doc_id"], "low", terms_of(t), "term", repeated=True)
    return D.first_longest(held, ["doc_id"], "term", "canonical", 15)


#: Two categories, of which the later one wins where they share a term.
_BOTH = "every AS (SELECT term, canonical, 1 AS category FROM terms UNION ALL SELECT term, upper(right(term, 4)), 2 FROM terms WHERE length(term) >= 9), idx AS (SELECT term, arg_max(canonical, category) AS canonical, max(category) AS category FROM every GROUP BY term)"


@query("en4_dictionary_link", f"WITH {_TERMS}, {_RUNS}, {_BOTH} SELECT doc_id, canonical, max((-length(term), category, term))[3] AS mention FROM held JOIN idx USING (term) GROUP BY ALL")
def _(t):
    """Every term that a text holds; of a canonical name's terms the shortest, of equally long ones the last added."""
    g = terms_of(t)
    every = g.select("term", "canonical", F.lit(1).alias("category")).unionByName(g.where(F.length("term") >= 9).select("term", F.upper(F.right("term", F.lit(4))).alias("canonical"), F.lit(2).alias("category")))
    held = D.held_terms(_low(t), ["doc_id"], "low", D.index_terms(every, "term", ["category"]), "term", repeated=True)
    return D.one_mention(held, ["doc_id"], "term", "canonical", "category").withColumnRenamed("term", "mention")


@query(
    "en5_typed_terms",
    f"""WITH {_TERMS}, {_RUNS}, best AS (SELECT canonical, min(type) AS type FROM terms GROUP BY canonical), h AS (SELECT DISTINCT doc_id, canonical FROM held JOIN terms USING (term)), n AS (SELECT canonical, count(*) AS g FROM h GROUP BY 1)
        SELECT doc_id, list(canonical ORDER BY k) AS names FROM (SELECT doc_id, canonical, row_number() OVER (PARTITION BY doc_id ORDER BY g DESC, canonical) AS k FROM h JOIN n USING (canonical) JOIN best USING (canonical) WHERE type <> 3) WHERE k <= 8 GROUP BY doc_id""",
)
def _(t):
    """Names of a text, without untyped ones (type 3), by how many texts hold them, eight at most."""
    kinds = D.typed(terms_of(t), "term", "canonical", "type")
    held = D.held_terms(_low(t), ["doc_id"], "low", kinds, "term", repeated=True)
    top = D.most_frequent(held, ["doc_id"], "canonical", 8, F.col("type") != 3)
    return top.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "canonical"))), lambda s: s["canonical"]).alias("names"))


@query(
    "en6_alternation",
    f"""WITH RECURSIVE {_TERMS}, {_RUNS}, two AS (SELECT run, i, max(length(term)) AS l, length(term) < 7 AS risky FROM found GROUP BY run, i, length(term) < 7),
        nx AS (SELECT a.run, a.risky, a.i, a.l, min(b.i) AS nxt FROM two a LEFT JOIN two b ON a.run = b.run AND a.risky = b.risky AND b.i >= a.i + a.l GROUP BY ALL),
        chain AS (SELECT run, risky, min(i) AS i FROM two GROUP BY ALL UNION ALL SELECT c.run, c.risky, nxt FROM chain c JOIN nx USING (run, risky, i) WHERE nxt IS NOT NULL),
        hits AS (SELECT run, risky, substr(run, i, l) AS mention FROM chain JOIN nx USING (run, risky, i)),
        about AS (SELECT doc_id, contains(lower(text), 'license') OR contains(lower(text), 'password') AS open FROM documents)
        SELECT doc_id, mention, count(*) AS n FROM runs JOIN hits USING (run) JOIN about USING (doc_id) WHERE open OR NOT risky GROUP BY ALL""",
)
def _(t):
    """Occurrences by longest-first alternations without overlap; terms of six letters count only in texts that hold a word of their
    context."""
    terms = terms_of(t).select("term", (F.length("term") < 7).alias("risky"))
    found = D.gated_occurrences(_low(t), ["doc_id"], "low", terms, "term", "risky", ["license", "password"])
    return found.groupBy("doc_id", F.col("term").alias("mention")).agg(F.count("*").alias("n"))


# --- rules -------------------------------------------------------------------------------------------


def _ranked_words(t):
    """(block, prefix, ord, w) of the items' words, the most frequent first, 500 of them without a block: a rules table has so many rows,
    whatever the corpus."""
    n = t.benchmark.select(F.explode(_words(t, 4)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    top = n.orderBy(F.desc("n"), "w").limit(640)
    ord_ = F.row_number().over(Window.orderBy(F.desc("n"), "w"))
    block = F.when(F.col("ord") > 500, F.col("ord") % 24)
    return top.withColumn("ord", ord_).select(block.alias("block"), F.concat(F.lit("src"), block.cast("string")).alias("prefix"), "ord", "w")


def rules_of(t):
    """500 global rules, 60 and more of which look around, and 24 blocks by the beginning of a file's name (``src1`` fits ``src10`` too)."""
    w = _ranked_words(t)
    plain = F.concat(F.lit(r"(?a)\b"), "w", F.lit(r"\b"))
    around = F.concat(F.lit("(?<=[a-z] )"), "w", F.lit("(?=[ ,.])(?!, )"))
    several = F.concat(F.lit("("), "w", F.lit("|"), F.initcap("w"), F.lit(r")(?= (\w+))"))
    pattern = F.when(F.col("ord") % 8 == 0, around).when(F.col("ord") % 50 == 7, several).otherwise(plain)
    new = F.when(F.col("ord") % 8 == 0, F.upper("w")).when(F.col("ord") % 50 == 7, F.lit(r"\2 \1")).otherwise(F.concat(F.substring("w", 3, 40), F.substring("w", 1, 2)))
    return w.select("block", "prefix", "ord", pattern.alias("pattern"), new.alias("replacement"))


def file_of():
    return F.concat_ws("/", "source", "lang", "doc_id")


@query("tx1_ordered_rules")
def _(t):
    """Ordered rewrite rules with lookaround and blocks by file; later rules see earlier output."""
    return t.documents.select("doc_id", W.rewriter(rules_of(t))(F.col("text"), file_of()).alias("rewritten"))


@query(
    "tx1_literal_blocks",
    """WITH w AS (SELECT w, row_number() OVER (ORDER BY count(*) DESC, w) AS ord FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS w FROM benchmark) GROUP BY w QUALIFY ord <= 640),
       r AS (SELECT ord, CASE WHEN ord > 500 THEN ord % 24 END AS block, w || '|' || substr(w, 3) || left(w, 2) AS pair FROM w),
       g AS (SELECT list(pair ORDER BY ord) AS pairs FROM r WHERE block IS NULL), b AS (SELECT block, list(pair ORDER BY ord) AS pairs FROM r WHERE block IS NOT NULL GROUP BY block),
       own AS (SELECT doc_id, min(block) AS block FROM documents JOIN b ON starts_with(source, 'src' || block) GROUP BY doc_id),
       one AS (SELECT doc_id, list_reduce(list_prepend(text, pairs), lambda t, p: replace(t, split_part(p, '|', 1), split_part(p, '|', 2))) AS s FROM documents, g)
       SELECT doc_id, CASE WHEN b.pairs IS NULL THEN s ELSE list_reduce(list_prepend(s, b.pairs), lambda t, p: replace(t, split_part(p, '|', 1), split_part(p, '|', 2))) END AS rewritten FROM one LEFT JOIN own USING (doc_id) LEFT JOIN b USING (block)""",
)
def _(t):
    """The part that SQL has: literal rules, everywhere and then of the first block that fits."""
    rules = _ranked_words(t).withColumnRenamed("w", "pattern").withColumn("replacement", F.concat(F.substring("pattern", 3, 40), F.substring("pattern", 1, 2)))
    return t.documents.select("doc_id", W.rewriter(rules)(F.col("text"), F.col("source")).alias("rewritten"))


@query("tx1_rewrite_merge_rewrite")
def _(t):
    """Lines as cues of a second for each 20 characters: rewritten, joined over short pauses, rewritten again."""
    cues = lines(t).where("length(line) > 0").withColumn("start", F.col("line_no") * 2.0).withColumn("end", F.col("line_no") * 2.0 + F.length("line") / 20)
    return W.clean_and_merge(cues, "doc_id", "start", "end", "line", F.concat(F.lit("src"), (F.col("doc_id") % 30).cast("string")), rules_of(t))


@query("ev7_rewritten_evidence")
def _(t):
    """The rules on every element of a document's evidence."""
    clips = lines(t).join(t.documents.select("doc_id", file_of().alias("file")), "doc_id").select("doc_id", "line_no", W.rewriter(rules_of(t))(F.col("line"), F.col("file")).alias("clip"))
    return clips.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "clip"))), lambda s: s["clip"]).alias("clips"))
