"""Linking texts with a table of terms, which may be as many as the texts' own words.

Terms without separators lie within runs of a text's letters and digits, so each distinct run is decided once, in joins. Where some term
has a separator, and in texts with very long runs, terms are dealt into blocks of a bounded size (see ``containment``), each of which is
one automaton and one more pass. Here are also the choices among terms: leftmost-longest occurrences that don't overlap, one
mention for each canonical name, and so many of a text by a count over all texts.

Null texts hold nothing; null or empty terms are left out. Case is the caller's. Rows of equal terms are linked each, except where
an operator says which of them counts. Repeated rows of texts are linked each (their keys tell them apart, or not). Texts
of any length are read as they are. Without terms or texts the result is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from loomwright.session import forget, ship_package, written

from .containment import automaton_of, held_quotes, quote_blocks


def index_terms(terms: DataFrame, term: str, order: list) -> DataFrame:
    """One row for each term of two characters or more: of several categories' the last added (by ``order``) wins."""
    w = Window.partitionBy(term).orderBy(*order)
    known = terms.where(F.length(term) >= 2)
    return known.withColumn("_k", F.row_number().over(w)).withColumn("_n", F.count("*").over(Window.partitionBy(term))).where("_k = _n").drop("_k", "_n")


def held_terms(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str, repeated: bool = False) -> DataFrame:
    """(``keys``, all columns of ``terms``) for each text and each term that it holds. ``repeated``: a term may come again for a text, once for
    each distinct run that holds it, which saves a shuffle where the next step makes them one anyway."""
    known = written(terms.where(F.length(term) > 0), "terms")
    by_blocks = lambda few: held_quotes(few, keys, text, known.withColumn("_term", F.col(term)), "_term")
    if not known.where(F.col(term).rlike(f"[{SEPARATORS}]")).isEmpty():
        return by_blocks(texts)
    by_runs = _held_by_runs(texts, keys, text, known, term, repeated)
    few = _with_long_runs(texts, keys, text)
    return by_runs if few.isEmpty() else by_runs.unionByName(by_blocks(few))


def _held_by_runs(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str, repeated: bool) -> DataFrame:
    """Distinct runs' parts meet the terms in an equi-join, and each text's distinct runs their run's terms by a hash."""
    sizes = _sizes(terms, term)
    ship_package(texts.sparkSession)
    own = [*keys, "_row"]
    rows = _runs(texts.withColumn("_row", F.monotonically_increasing_id()), own, text, sizes[0] if sizes else 1, True).select(*own, "_run")
    kinds = rows.select("_run").distinct().select("_run", F.xxhash64("_run").alias("_r"))
    # Rows of equal terms stay apart by a number, and a term that is twice in a run is one.
    each = terms.select(F.col(term).alias("_t"), F.struct(F.monotonically_increasing_id().alias("_n"), *terms.columns).alias("_x"))
    held = _parts(kinds, sizes).select("_r", F.col("t").alias("_t")).join(each, "_t").groupBy("_r").agg(F.collect_set("_x").alias("_x"))
    found = rows.select(*keys, "_row", F.xxhash64("_run").alias("_r")).join(written(held, "held"), "_r").select(*keys, "_row", F.explode("_x").alias("_x")).select(*keys, "_row", "_x.*")
    return (found if repeated else found.distinct()).select(*keys, *terms.columns)


def _with_long_runs(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(``keys``, ``text``) of the texts that ``_runs`` passes over. A run is read from its start only."""
    source = texts.select(*keys, text).where(F.length(text) >= LONG_RUN)
    least, n = LONG_RUN, len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(f"(?:^|[{SEPARATORS}])[^{SEPARATORS}]{{{least}}}")
        for batch in batches:
            yield batch.filter(pa.array([bool(found.search(s)) for s in batch.column(n).to_pylist()], pa.bool_()))

    return source.mapInArrow(run, source.schema)


def _sizes(terms: DataFrame, term: str) -> list[int]:
    return sorted(r["n"] for r in terms.select(F.length(term).alias("n")).distinct().collect())


def _parts(kinds: DataFrame, sizes: list[int]) -> DataFrame:
    """(_r, _i, _n, t): the parts of runs (_run, _r) that are as long as some term, from place ``_i`` on."""
    starts = kinds.select("_run", "_r", F.explode(F.sequence(F.lit(1), F.length("_run") - F.lit(sizes[0] if sizes else 1) + 1)).alias("_i"))
    fitting = F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda n: n <= F.length("_run") - F.col("_i") + 1)
    return starts.select("_run", "_r", "_i", F.explode(fitting).alias("_n")).select("_r", "_i", "_n", F.expr("substring(_run, _i, _n)").alias("t"))


def one_mention(held: DataFrame, keys: list[str], term: str, canonical: str, order: str) -> DataFrame:
    """(``keys``, ``canonical``, ``term``): of a canonical name's terms in a text the shortest, of equally long ones the later."""
    first = F.struct((-F.length(term)).alias("n"), F.col(order).alias("o"), F.col(term).alias("t"))
    return held.groupBy(*keys, canonical).agg(F.max(first).alias("m")).select(*keys, canonical, F.col("m.t").alias(term))


def typed(terms: DataFrame, term: str, canonical: str, priority: str) -> DataFrame:
    """One row (term, canonical, priority) for each term: a canonical name has its best priority (the least), and a term
    belongs to the canonical name of best priority (of equal ones the first by name)."""
    terms = written(terms, "terms")
    best = terms.groupBy(canonical).agg(F.min(priority).alias("_p"))
    every = terms.select(term, canonical).unionByName(terms.select(F.col(canonical).alias(term), canonical)).where(F.length(term) >= 2).distinct()
    chosen = every.join(best, canonical).groupBy(term).agg(F.min(F.struct("_p", canonical)).alias("m"))
    return chosen.select(term, F.col(f"m.{canonical}").alias(canonical), F.col("m._p").alias(priority))


def most_frequent(held: DataFrame, keys: list[str], canonical: str, cap: int, allowed: Column) -> DataFrame:
    """(``keys``, names, place): of each text the ``cap`` names that most texts hold (ties: by name), among the ``allowed`` ones."""
    pairs = written(held.select(*keys, canonical, allowed.alias("_ok")).distinct(), "pairs")
    counts = pairs.groupBy(canonical).agg(F.count("*").alias("n_texts"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n_texts"), canonical))
    return pairs.where("_ok").join(counts, canonical).withColumn("place", place).where(F.col("place") <= cap).select(*keys, canonical, "n_texts", "place")


def first_longest(held: DataFrame, keys: list[str], term: str, canonical: str, cap: int) -> DataFrame:
    """(``keys``, ``canonical``, ``term``, place): names in the order of their longest term (ties: by term), ``cap`` of a text at most."""
    best = held.groupBy(*keys, canonical).agg(F.min(F.struct((-F.length(term)).alias("n"), F.col(term).alias("t"))).alias("m"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("m", canonical))
    return best.withColumn("place", place).where(F.col("place") <= cap).select(*keys, canonical, F.col("m.t").alias(term), "place")


RESULT = StructField("start", LongType()), StructField("_q", LongType())
CARRIED = StructField("_text", StringType()), StructField("_best", BinaryType())


def _at_each_start(found, text: str, best: dict[int, tuple[int, int]]) -> None:
    for end, (size, h) in found.iter(text):
        start = end - size + 1
        if best.get(start, (0, 0))[0] < size:
            best[start] = size, h


def _without_overlap(best: dict[int, tuple[int, int]]) -> Iterator[tuple[int, int]]:
    upto = 0
    for start in sorted(best):
        if start >= upto:
            upto = start + best[start][0]
            yield start, best[start][1]


#: What ends a run of a text's characters: ASCII without digits and letters. A text with a run of so many characters is read by blocks.
SEPARATORS, LONG_RUN = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F", 10_000


def longest_occurrences(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str) -> DataFrame:
    """(``keys``, start, ``term``) of the occurrences that an alternation of all terms, longest first, finds from left to right:
    at each place the longest term, then on behind it. Terms without separators lie within runs, so each distinct run is decided once
    (``_by_runs``); where some term has a separator, and in texts with very long runs, texts are read by blocks of terms (``_by_blocks``)."""
    terms = written(terms.where(F.length(term) > 0).select(term).distinct(), "terms")
    if not terms.where(F.col(term).rlike(f"[{SEPARATORS}]")).isEmpty():
        return _by_blocks(texts, keys, text, terms, term)
    by_runs = _by_runs(texts, keys, text, terms, term)
    few = _with_long_runs(texts, keys, text)
    return by_runs if few.isEmpty() else by_runs.unionByName(_by_blocks(few, keys, text, terms, term))


def _runs(texts: DataFrame, keys: list[str], text: str, least: int, once: bool = False) -> DataFrame:
    """(``keys``, _at, _run): runs of each text, of ``least`` characters or more, with their places; repeated ones each, or ``once`` (the last).
    Texts with a run of ``LONG_RUN`` are passed over."""
    source = texts.select(*keys, F.col(text).alias("_text")).where("_text is not null")
    n, most = len(keys), LONG_RUN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(f"[^{SEPARATORS}]{{{least},}}")

        def of(s: str) -> list[tuple[int, str]]:
            held = [(m.start(), m.group()) for m in found.finditer(s)]
            if len(s) >= most and any(len(r) >= most for _, r in held):
                return []
            return [(a, r) for r, a in {r: a for a, r in held}.items()] if once else held

        for big in batches:
            for k in range(0, big.num_rows, 500):
                batch = big.slice(k, 500)
                held = [(i, a, r) for i, s in enumerate(batch.column(n).to_pylist()) for a, r in of(s)]
                at, starts, runs = zip(*held) if held else ((), (), ())
                places = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(places) for c in range(n)), pa.array(starts, pa.int64()), pa.array(runs, pa.string())], [*keys, "_at", "_run"])

    return source.mapInArrow(run, StructType([*(source.schema[k] for k in keys), StructField("_at", LongType()), StructField("_run", StringType())]))


def _by_runs(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str) -> DataFrame:
    """No automaton and nothing broadcast: distinct runs' parts meet the terms in an equi-join, the choice is made in each run, and runs of
    texts meet their run's choice by a hash."""
    ship_package(texts.sparkSession)
    known = terms.select(F.col(term).alias("t"))
    sizes = _sizes(known, "t")
    rows = _runs(texts, keys, text, sizes[0] if sizes else 1)
    kinds = rows.select("_run").distinct().select("_run", F.xxhash64("_run").alias("_r"))
    met = _parts(kinds, sizes).join(known, "t")
    # At a start the longest comes first; what begins before the end of the last one taken is passed over.
    held = met.groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("_i", (-F.col("_n")).alias("m"), "t"))).alias("h"))
    taken = "aggregate(h, struct(0 AS upto, cast(array() AS array<struct<_i: int, t: string>>) AS kept), (s, x) -> if(x._i >= s.upto, struct(x._i - x.m AS upto, concat(s.kept, array(struct(x._i AS _i, x.t AS t))) AS kept), s)).kept"
    chosen = written(held.select("_r", F.expr(taken).alias("kept")), "chosen")
    found = rows.select(*keys, "_at", F.xxhash64("_run").alias("_r")).join(chosen, "_r").select(*keys, "_at", F.explode("kept").alias("x"))
    return found.select(*keys, (F.col("_at") + F.col("x._i") - 1).alias("start"), F.col("x.t").alias(term))


def _by_blocks(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str) -> DataFrame:
    """One pass over the texts for each block of terms. A text's longest match at each place goes along from
    block to block, by a stored table, so that a worker holds one block's automaton at a time. No shuffle but for the terms' own names."""
    spark = texts.sparkSession
    ship_package(spark)
    distinct = written(terms.where(F.length(term) > 0).select(F.xxhash64(term).alias("_q"), F.col(term).alias("_quote")).distinct(), "terms")
    out = texts.select(*keys, F.col(text).alias("_text")).where("_text is not null")
    fields = [out.schema[k] for k in keys]
    n, blocks = len(keys), quote_blocks(distinct)

    def scan(block, first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = automaton_of(block)
            for batch in batches:
                carried = [None] * batch.num_rows if first else batch.column(n + 1).to_pylist()
                at, starts, names, kept = [], [], [], []
                for i, (s, old) in enumerate(zip(batch.column(n).to_pylist(), carried)):
                    best = {a: (b, c) for a, b, c in np.frombuffer(old, np.int64).reshape(-1, 3).tolist()} if old else {}
                    if len(found):
                        _at_each_start(found, s, best)
                    if last:
                        for start, h in _without_overlap(best):
                            at.append(i)
                            starts.append(start)
                            names.append(h)
                    else:
                        kept.append(np.array([(a, *x) for a, x in best.items()], np.int64).tobytes())
                if last:
                    places = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(places) for k in range(n)), pa.array(starts, pa.int64()), pa.array(names, pa.int64())], [*keys, "start", "_q"])
                else:
                    yield pa.RecordBatch.from_arrays([*batch.columns[: n + 1], pa.array(kept, pa.binary())], [*keys, "_text", "_best"])

        return run

    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        schema = StructType([*fields, *(RESULT if last else CARRIED)])
        before, out = out, out.mapInArrow(scan(block, k == 0, last), schema)
        if not last:
            out = written(out, "carried")
            forget(before)
    return out.join(distinct, "_q").select(*keys, "start", F.col("_quote").alias(term))


def gated_occurrences(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, term: str, risky: str, context: list[str]) -> DataFrame:
    """(``keys``, ``term``) for each occurrence: safe terms are found by one alternation in every text, risky ones (short or ambiguous) by
    another, and only in texts that hold a word of ``context``. A term with safe and risky rows is found by both."""
    safe = longest_occurrences(texts, keys, text, terms.where(~F.col(risky)), term)
    about = texts.where(F.exists(F.array(*[F.lit(c) for c in context]), lambda c: F.contains(F.col(text), c))) if context else texts.limit(0)
    return safe.unionByName(longest_occurrences(about, keys, text, terms.where(F.col(risky)), term)).drop("start")
