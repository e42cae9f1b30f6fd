"""Packing documents into sequences of fixed length by shortest-pack-first over a length histogram.

Documents are tokenized once and cut every ``length`` ids; what is left of a document is a piece
too. Full pieces are sequences of their own. The histogram of the other lengths (at most ``length`` - 1
rows, whatever the corpus) goes to the driver, which places lengths longest first: each goes onto the
pattern with the least content so far that still has room (the shortest pack), and pattern counts are
split as lengths run out. Lengths that fit nowhere open new patterns.

The patterns become ranges of ranks: the r-th piece of a length belongs to a known sequence and offset.
Pieces are stored with a number each and ranked within their length in buckets by a hash of it, so that neither a hot length nor
any number of equal rows is ranked by one task; they find their range by binary search in a table of bounded size.

A null or empty text is the end id alone; a very long one is cut into as many pieces as it takes. Repeated rows are packed each. Null ids stay null. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import from_texts, salted_rank, ship_package, steps, written

LENGTH = 2048


def histogram_patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and how often each is used, by shortest-pack-first."""
    by_content: dict[int, Counter] = {}  # content so far -> patterns and their counts
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for content in sorted(c for c in by_content if c + size <= length):
            if not left:
                break
            # one piece of this size on each; the grown patterns may take another one later
            for pattern, n in list(by_content[content].items()):
                use = min(n, left)
                if not use:
                    break
                by_content[content][pattern] -= use
                if not by_content[content][pattern]:
                    del by_content[content][pattern]
                by_content.setdefault(content + size, Counter())[(*pattern, size)] += use
                left -= use
        # Patterns that this size has just grown may have room for it again, the shortest first.
        while left:
            grown = sorted(c for c in by_content if c + size <= length and by_content[c])
            if not grown:
                break
            pattern, n = next(iter(by_content[grown[0]].items()))
            use = min(n, left)
            by_content[grown[0]][pattern] -= use
            if not by_content[grown[0]][pattern]:
                del by_content[grown[0]][pattern]
            by_content.setdefault(grown[0] + size, Counter())[(*pattern, size)] += use
            left -= use
        if left:
            each = length // size
            if left >= each:
                by_content.setdefault(each * size, Counter())[(size,) * each] += left // each
            if left % each:
                by_content.setdefault(left % each * size, Counter())[(size,) * (left % each)] += 1
        by_content = {c: p for c, p in by_content.items() if p}
    return [(p, n) for c in sorted(by_content, reverse=True) for p, n in sorted(by_content[c].items(), reverse=True)]


def pieces(df: DataFrame, path: str, end_id: int = 1, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenize and cut: one row for each piece, without its ids."""

    def run(batches):
        tokenizer = bpe.loaded(path)
        for batch in steps(batches):
            ids, n = tokenizer.ids(batch.column(1).to_pylist())
            ids = np.insert(ids, np.cumsum(n), end_id)
            n = n + 1
            k = -(-n // length)
            first = np.cumsum(n) - n
            doc = np.repeat(np.arange(len(n)), k)
            start = (np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)) * length
            size = np.minimum(length, n[doc] - start)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = 4 * (first[doc] + start)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * size).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()).take(pa.array(doc)), pa.array(start), pa.array(size.astype(np.int32)), pa.array(crc, pa.int64()), pa.array(n[doc])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return from_texts(df, run, "doc_id long, start long, length int, ids_crc32 long, doc_tokens long", id_column, text_column)


def place(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Give every piece (a stored table with a number for each ``row``) its ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    ship_package(spark)
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(histogram.values())
    patterns = histogram_patterns(histogram, length)
    # For each length: from which rank on a range begins, its first sequence, and the offset there.
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for size in pattern:
            ranges.setdefault(size, []).append((used[size], sequence, offset))
            used[size] += n
            offset += size
        sequence += n
    tables = {s: tuple(np.array(x, np.int64) for x in zip(*r)) for s, r in ranges.items()}
    shared = spark.sparkContext.broadcast(tables)

    def run(batches):
        tables = shared.value
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            seq, off = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                begin, first, offset = tables[int(size)]
                k = np.searchsorted(begin, ranks[at], side="right") - 1
                seq[at], off[at] = first[k] + ranks[at] - begin[k], offset[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(2).cast(pa.int64()), *batch.columns[3:5], pa.array(seq), pa.array(off)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranked = salted_rank(cut, ["length"], ["row"], total)  # equal rows too are dealt to many buckets
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(df: DataFrame, path: str, end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """Cut and place all documents; one row for each piece."""
    return place(written(pieces(df, path, end_id, length).withColumn("row", F.monotonically_increasing_id()), "pieces"), length)
