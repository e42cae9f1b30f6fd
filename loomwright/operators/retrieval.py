"""Bigram BM25 over a table of documents, with boosts, filters and quotas.

A set of queries is answered at once. For a few queries, the corpus becomes one stored posting table (term, doc, tf) of
their terms in one pass over the texts, which meets the queries in an equi-join. Of more queries such a table would
outgrow the texts: up to ``DENSE_QUERIES`` of ``DENSE_TERMS`` distinct terms are broadcast; one pass over the texts counts
documents by term, a second one scores batches of documents against all queries as a matrix product, and only
scores leave it. Beyond that it is the posting table again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from loomwright.session import ship_package, written

K1, B = 1.5, 0.75
#: Distinct terms of the queries that are broadcast at most, 8 bytes each; beyond that all postings are made.
MAX_TERMS = 1_000_000
#: Queries and their distinct terms that are scored as a matrix; cells of a batch's matrix.
FEW_QUERIES, DENSE_QUERIES, DENSE_TERMS, CELLS = 8, 2_000, 50_000, 2_000_000
_SINGLE = 1 << 42


def term_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Search tokens of all texts as numbers (two code points, or one ideograph), the text each is of, and how
    many each text has. They are those of ``functions.text.bigrams``."""
    plain = ["".join((s or "").split()) for s in texts]
    code = np.frombuffer((chr(0x10FFFF) + chr(0x10FFFF).join(plain) + chr(0x10FFFF)).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    ends = np.cumsum([0, *(len(p) + 1 for p in plain)])
    edge = np.zeros(len(code), bool)
    edge[ends] = True
    owner = np.cumsum(edge) - 1
    pair = np.flatnonzero(~edge[:-1] & ~edge[1:])
    single = np.flatnonzero((code >= 0x4E00) & (code <= 0x9FFF) & ~edge)
    who = np.concatenate([owner[pair], owner[single]])
    return np.concatenate([code[pair] << 21 | code[pair + 1], code[single] | _SINGLE]), who, np.bincount(who, minlength=len(texts))[: len(texts)]


def _query_terms(queries: DataFrame, query_id: str, query_text: str) -> DataFrame:
    rows = queries.select(F.col(query_id).alias("query"), F.col(query_text).alias("text"))
    schema = StructType([rows.schema["query"], StructField("term", LongType())])

    def run(batches):
        for batch in batches:
            codes, who, _ = term_codes(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who)), pa.array(codes)], ["query", "term"])

    return rows.mapInArrow(run, schema).distinct()


def postings(docs: DataFrame, doc_id: str, doc_text: str, wanted=None) -> DataFrame:
    """(doc, dl, term, tf); a document also has one row of term -1. ``wanted``: a broadcast array of the only terms."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text"))
    fields = [StructField(x, LongType()) for x in ("dl", "term", "tf")]

    def run(batches):
        terms = None if wanted is None else wanted.value
        maybe = None if terms is None else _mask(terms)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                codes, who, dl = term_codes(batch.column(1).to_pylist())
                if terms is not None:
                    keep = maybe[_bits(codes)]
                    codes, who = codes[keep], who[keep]
                    keep = np.isin(codes, terms)
                    codes, who = codes[keep], who[keep]
                by = np.lexsort((codes, who))
                codes, who = codes[by], who[by]
                first = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (who[1:] != who[:-1])])[: len(codes)])
                tf = np.diff(np.concatenate([first, [len(codes)]]))
                each = np.arange(batch.num_rows)
                owner = np.concatenate([each, who[first]])
                term, n = np.concatenate([np.full(len(each), -1), codes[first]]), np.concatenate([np.zeros(len(each), np.int64), tf])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(dl[owner]), pa.array(term), pa.array(n)], ["doc", "dl", "term", "tf"])

    return rows.mapInArrow(run, StructType([rows.schema["doc"], *fields]))


def _counted(texts: list[str | None], terms: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each text has each of the sorted ``terms``, and the texts' numbers of tokens."""
    codes, who, dl = term_codes(texts)
    keep = maybe[_bits(codes)]
    codes, who = codes[keep], who[keep]
    at = np.minimum(np.searchsorted(terms, codes), len(terms) - 1)
    hit = terms[at] == codes
    return np.bincount(who[hit] * len(terms) + at[hit], minlength=len(texts) * len(terms)).reshape(len(texts), len(terms)), dl


def _bits(codes: np.ndarray) -> np.ndarray:
    return codes * 0x9E3779B1 >> 7 & 0xFFFFF


def _mask(terms: np.ndarray) -> np.ndarray:
    """Most tokens are told apart from ``terms`` by some bits of their codes."""
    maybe = np.zeros(1 << 20, bool)
    maybe[_bits(terms)] = True
    return maybe


def _scored_dense(docs: DataFrame, doc_id: str, doc_text: str, query: StructField, pairs: list, best: int | None) -> DataFrame:
    """(query, doc, score) for queries given as (query, term) rows, which are few; ``query``: their ids' type."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(doc_text).alias("text"))
    names = sorted({r["query"] for r in pairs}, key=lambda q: (q is None, q))
    terms = np.unique(np.array([r["term"] for r in pairs], np.int64))
    place = {q: i for i, q in enumerate(names)}
    asked = np.zeros((len(terms), len(names)))
    asked[np.searchsorted(terms, [r["term"] for r in pairs]), [place[r["query"]] for r in pairs]] = 1.0
    step = max(1, min(256, CELLS // max(1, len(terms))))
    shared = spark.sparkContext.broadcast(terms)

    def count(batches):
        terms = shared.value
        maybe, df, n, total = _mask(terms), np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                tf, dl = _counted(batch.column(0).slice(at, step).to_pylist(), terms, maybe)
                df += (tf > 0).sum(axis=0)
                n, total = n + len(dl), total + int(dl.sum())
        # Places -2 and -1: documents and their tokens.
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(terms))), pa.array(np.concatenate([[n, total], df]))], ["place", "n"])

    held = rows.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(len(terms) + 2, np.int64)
    for r in held:
        found[r["place"] + 2] = r["n"]
    n, total, df = int(found[0]), int(found[1]), found[2:]
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    known = spark.sparkContext.broadcast((terms, idf, total / max(1, n), asked, pa.array(names, to_arrow_type(query.dataType))))
    schema = StructType([query, rows.schema["doc"], StructField("score", DoubleType())])

    def score(batches):
        terms, idf, avgdl, asked, labels = known.value
        maybe, floor = _mask(terms), np.zeros(len(labels))
        for big in batches:
            for at in range(0, big.num_rows, step):
                batch = big.slice(at, step)
                tf, dl = _counted(batch.column(1).to_pylist(), terms, maybe)
                with np.errstate(divide="ignore", invalid="ignore"):
                    w = np.where(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl[:, None] / avgdl)), 0.0)
                s = w @ asked
                if best is not None and len(s) >= best:
                    # What is just below the best so far stays, as scores are rounded later.
                    floor = np.maximum(floor, np.partition(s, len(s) - best, axis=0)[len(s) - best] - 1e-3)
                d, q = np.nonzero((s != 0) & (s >= floor))
                yield pa.RecordBatch.from_arrays([labels.take(pa.array(q)), batch.column(0).take(pa.array(d)), pa.array(s[d, q])], ["query", "doc", "score"])

    return rows.mapInArrow(score, schema)


def bm25(docs: DataFrame, queries: DataFrame, doc_id: str, doc_text: str, query_id: str, query_text: str, best: int | None = None) -> DataFrame:
    """(query, doc, score) of all pairs that share a term. A term counts once in a query. Document
    frequencies and the mean length are those of all of ``docs``; null texts count as empty. With ``best``, pairs may be left out
    that are not among the ``best`` highest scores of their query, rounded to 3 places or more."""
    spark = docs.sparkSession
    ship_package(spark)
    terms = written(_query_terms(queries, query_id, query_text), "terms")
    size = terms.agg(F.countDistinct("query").alias("q"), F.countDistinct("term").alias("t")).first()
    if 0 < size["t"] <= DENSE_TERMS and FEW_QUERIES < size["q"] <= DENSE_QUERIES:
        return _scored_dense(docs, doc_id, doc_text, terms.schema["query"], terms.collect(), best)
    wanted = None
    if size["t"] <= MAX_TERMS:
        wanted = spark.sparkContext.broadcast(np.sort(np.array([r["term"] for r in terms.select("term").distinct().collect()], np.int64)))
    held = written(postings(docs, doc_id, doc_text, wanted), "postings")
    size = held.where("term = -1").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    tf = held.where("term <> -1")
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    # A term's weight in a document is made once, whatever the number of queries; size is one row.
    weighed = tf.join(df, "term").crossJoin(F.broadcast(size)).select("term", "doc", weight.alias("w"))
    return terms.join(weighed, "term").groupBy("query", "doc").agg(F.sum("w").alias("score"))


def boosted(scored: DataFrame, docs: DataFrame, doc_id: str, boost: Column, places: int = 4) -> DataFrame:
    """Positive scores times the documents' boosts, rounded."""
    factors = docs.select(F.col(doc_id).alias("doc"), boost.alias("boost"))
    return scored.where("score > 0").join(factors, "doc").withColumn("score", F.round(F.col("score") * F.col("boost"), places)).drop("boost")


def link_score(jaccard: Column, bucket: Column, glossary: Column, bigram: Column) -> Column:
    """2 J + 0.5 same bucket + 0.3 of at most 3 glossary hits + bigram similarity."""
    return 2 * jaccard + 0.5 * bucket.cast("int") + 0.3 * F.least(glossary, F.lit(3)) + bigram
