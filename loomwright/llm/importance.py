"""Resampling towards a target distribution by hashed n-gram features and Gumbel keys.

Features of a text are its runs of 1 to 3 consecutive words, joined by one blank. Within a portion of texts words have ids of
an integer dictionary, a run is a tuple of ids (a pair is one integer, a triple a pair's place and an id), the bytes of
each distinct tuple are hashed once (its last word's checksum goes onto that of the words before), and counts come
back by the tuples' places. A bucket's gain is a log ratio of its share in the target and in the documents;
a document's weight adds up its features' gains; the highest of weight plus a Gumbel number drawn from a hash of
the id are drawn, which is sampling without replacement.

Two passes over the texts: counts (partial sums of ``BUCKETS`` numbers for each task), then weights. The table of gains has
``BUCKETS`` rows whatever the corpus, so it is collected and broadcast. Ranks are counted in ranges of the order, so no
task sorts all documents. A long text is handled in portions of some ``PORTION`` bytes that overlap by two words.

Null or empty texts have no features: their weight is 0. A null id is drawn with the hash of an empty id; ties go to the
smaller id (a null one first), then to any row. Repeated rows are documents of their own. An empty table gives an
empty result; an empty target has no features, and gains follow from the formula all the same. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.windows import place_in_order

from .common import ship_package, steps, word_arrays, written

BUCKETS = 10_000
#: Bytes of texts that are handled together, and of a word that one table moves a checksum by.
PORTION, LONGEST = 4_000_000, 64
#: A-Z as a-z, and a blank for each byte that is no ASCII letter or digit and no part of a character beyond.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20


def _moves() -> np.ndarray:
    """For lengths up to ``LONGEST`` bytes: where each byte of a checksum goes when so many bytes follow. A checksum of joined bytes
    is that of the first part, moved on by the second's length, plus (in bits) that of the second."""
    zero = np.array([zlib.crc32(b"\0", k ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for k in range(256)], np.uint32)
    out = np.zeros((LONGEST + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(LONGEST):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ zero[out[n] & np.uint32(255)]
    return out


class Features:
    """Buckets of the features of many texts, whose words lie in one array of bytes."""

    def __init__(self) -> None:
        self.moves = _moves()

    def _moved(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        while True:
            step = np.minimum(size, LONGEST)
            crc = self.moves[step, 0, crc & 255] ^ self.moves[step, 1, crc >> 8 & 255] ^ self.moves[step, 2, crc >> 16 & 255] ^ self.moves[step, 3, crc >> 24]
            size = size - step
            if not size.any():
                return crc

    def buckets(self, words: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, place of the run's first word) of all runs of 1 to 3 words, each with a blank before it in ``words``;
        ``first`` marks each text's first word."""
        coded = words.dictionary_encode()
        ids, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        n, kinds = len(ids), len(known)
        size = pc.binary_length(coded.dictionary).to_numpy().astype(np.int64)
        added = np.fromiter(map(zlib.crc32, known), np.uint32, kinds)
        crc = added ^ self._moved(np.full(kinds, zlib.crc32(b" "), np.uint32), size - 1)  # without the blank
        found, at = [crc[ids]], [np.arange(n)]
        begins, run = np.arange(n), ids  # the run that begins at each place of ``begins``, among the distinct ones
        for length in (2, 3):
            ok = begins + length - 1 < n
            begins, run = begins[ok], run[ok]
            ok = ~first[begins + length - 1]
            begins, run = begins[ok], run[ok]
            tuples, run = np.unique(run * kinds + ids[begins + length - 1], return_inverse=True)
            before, last = np.divmod(tuples, kinds)
            crc = self._moved(crc[before], size[last]) ^ added[last]
            found.append(crc[run])
            at.append(begins)
        return np.concatenate(found).astype(np.int64) % BUCKETS, np.concatenate(at)


def _found(known: Features, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of all features of some texts, in portions."""
    for w in word_arrays(texts, TABLE, 2, PORTION):
        bucket, begins = known.buckets(w.array(), np.diff(w.row, prepend=-1) != 0)
        if w.more:  # the last two words come again
            own = begins < len(w.row) - 2
            bucket, begins = bucket[own], begins[own]
        yield bucket, w.row[begins]


def bucket_counts(df: DataFrame, text_column: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left out."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Features(), np.zeros(BUCKETS, np.int64)
        for batch in steps(batches):
            for bucket, _ in _found(known, batch.column(0).to_pylist()):
                total += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    return df.select(F.col(text_column).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame) -> list[int]:
    """The gain of each bucket."""
    side = lambda df, c: bucket_counts(df).select("bucket", F.col("n").alias(c))
    rows = side(documents, "s").unionByName(side(target, "t"), allowMissingColumns=True).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    s, t = ({r["bucket"]: r[c] or 0 for r in rows} for c in ("s", "t"))
    all_s, all_t = float(sum(s.values())), float(sum(t.values()))
    return [math.floor(1000 * math.log(((t.get(b, 0) + 1.0) * (all_s + BUCKETS)) / ((s.get(b, 0) + 1.0) * (all_t + BUCKETS)))) for b in range(BUCKETS)]


def weights(documents: DataFrame, gain: list[int], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document; no shuffle."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = Features(), np.array(gain, np.int64)
        for batch in steps(batches):
            n = batch.num_rows
            n_words, n_features, weight = (np.zeros(n, np.int64) for _ in range(3))
            texts = batch.column(1).to_pylist()
            for bucket, row in _found(known, texts):
                n_features += np.bincount(row, minlength=n)
                np.add.at(weight, row, table[bucket])
            # m words make m + (m - 1) + (m - 2) runs.
            n_words = np.where(n_features < 3, (n_features + 1) // 2, n_features // 3 + 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight))], ["doc_id", "n_words", "n_features", "weight"])

    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(documents: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank (null: not drawn); ``percent`` of those with
    ``LEAST_WORDS`` words are drawn."""
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.ln(-F.ln((draw + 0.5) / 4294967296.0)))
    scored = weights(documents, gains(documents, target)).withColumn("score", (F.col("weight") + gumbel).cast("long"))
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= LEAST_WORDS)
    drawn = able.count() * percent // 100
    ranked = place_in_order(able.select((-F.col("score")).alias("_low"), "doc_id", "row"), ["_low", "doc_id", "row"], "rank").where(F.col("rank") <= drawn)
    return scored.join(ranked.select("row", "rank"), "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
