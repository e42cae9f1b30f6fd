"""Repeated word runs across documents, by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words of a document. A word goes if a window over it also starts in a document with a
smaller id; windows are judged on the input. Words are runs of other bytes than ASCII blanks, unchanged.

Only windows that can be repeated are suffixes of a tree. The least hash of a window's runs of ``GRAM`` words (its
anchor) is the same wherever the window stands, so equal windows meet under equal anchors. Consecutive windows of one
anchor travel as one stretch of text, and a stretch is known by the 128-bit digest of its words:

1. One pass over the texts stores each document's stretches (anchor, digest, place; no text). Of equal texts the one with
   the smallest id goes on, as a later copy loses every word.
2. Anchors of a single document are left out. Of equal stretches the one with the smallest id stands for all; in the others
   every window is repeated.
3. Where an anchor has several different stretches, their texts are fetched, and anchors are the prefixes that split suffixes into
   groups. Groups are put together up to ``GROUP_BYTES`` in a task, and each task builds the suffix tree of its windows, cut
   at ``WINDOW`` words, level by level with doubling depth (a node is named by the nodes of its halves). Internal nodes at the
   last level hold the repeats; the smallest id below a node tells which of its suffixes are repeats of an earlier one.
4. A group over ``GROUP`` stretches (a passage that a large part of all documents hold, with what surrounds it) is split by the longest
   prefix there is, the window itself, by its digest: such a group is one node, and its smallest id is a partial aggregate.
5. Windows found are put together as word ranges for each document; only documents with such ranges are read again.

No group is collected beyond its bound, no pairs are made, and nothing is broadcast. Hot anchors, stretches and copies are partial
aggregates and joins of stored tables that can be split.

Null and empty texts have no words. A document with a null id is never removed from, nor a reason to remove. Rows with one id
are no reason to remove from each other; equal rows get equal results. Long texts are handled in portions of ``PORTION``
bytes that overlap by a window less a word. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, forget, release, ship_package, steps, word_arrays, written

WINDOW, GRAM = 50, 8
#: Windows of a stretch, at most.
STRETCH = 64
#: Stretches of a group that may meet in one tree, and bytes of groups that one tree takes.
GROUP, GROUP_BYTES = 4_000, 6_000_000
#: Bytes of text that are split into words at a time.
PORTION = 4_000_000
TABLE = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
_SUPER = pa.struct([("h", pa.int64()), ("c", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each place the anchor of the window that begins there, and whether one does."""
    n = len(w.row)
    if n < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    coded = w.array().dictionary_encode()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    g = known[coded.indices.to_numpy()]
    width = 1
    while width < GRAM:
        g = _mixed(g[:-width], g[width:])
        width *= 2
    span, width = WINDOW - GRAM + 1, 1
    while width * 2 <= span:
        g = np.minimum(g[:-width], g[width:])
        width *= 2
    if width < span:
        g = np.minimum(g[: len(g) - span + width], g[span - width :])
    return g, w.row[: n - WINDOW + 1] == w.row[WINDOW - 1 :]


def stretches(w: Words) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(row, anchor, place of the first window, of the last one, the words' digest)."""
    g, ok = anchors(w)
    if not ok.any():
        return
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (g[1:] != g[:-1])
    at = np.flatnonzero(ok)
    run_start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    first = at[(at - run_start[at]) % STRETCH == 0]
    # A stretch ends before the next one begins, or where windows do.
    stop = np.append(np.flatnonzero(ok[:-1] & ~ok[1:]), at[-1])
    last = np.minimum(np.append(first[1:] - 1, at[-1]), stop[np.searchsorted(stop, first)])
    data = memoryview(w.data)
    key = g[first].view(np.int64)
    for f, l, h, r, a, b in zip(first.tolist(), last.tolist(), key.tolist(), w.row[first].tolist(), w.offsets[first].tolist(), w.offsets[last + WINDOW].tolist()):
        place = int(w.place[f])
        yield r, h, place, place + l - f, hashlib.blake2b(data[a:b], digest_size=16).digest()


def _scanned(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest, n_words, whole, stretches), stored: ``whole`` is the hash of all words, joined by a blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in steps(batches):
            n = batch.num_rows
            found: list[list[dict]] = [[] for _ in range(n)]
            n_words, whole = np.zeros(n, np.int64), [hashlib.sha256() for _ in range(n)]
            for w in word_arrays(batch.column(2).to_pylist(), TABLE, WINDOW - 1, PORTION):
                for r, h, lo, hi, c in stretches(w):
                    found[r].append({"h": h, "c": c, "lo": lo, "hi": hi})
                data = memoryview(w.data)
                begin = np.flatnonzero(np.diff(w.row, prepend=-1))
                for b, e in zip(begin.tolist(), [*begin[1:].tolist(), len(w.row)]):
                    r = int(w.row[b])
                    own = b + int(n_words[r] - w.place[b])  # words that came before are hashed already
                    whole[r].update(data[w.offsets[own] + (n_words[r] == 0) : w.offsets[e]])
                    n_words[r] += e - own
            rows = [pa.array(np.arange(at, at + n)), *batch.columns[:2], pa.array(n_words), pa.array([x.hexdigest() for x in whole]), pa.array(found, pa.list_(_SUPER))]
            at += n
            yield pa.RecordBatch.from_arrays(rows, ["row", "doc_id", "digest", "n_words", "whole", "stretches"])

    schema = "row long, doc_id long, digest binary, n_words long, whole string, stretches array<struct<h:long,c:binary,lo:int,hi:int>>"
    return written(docs.mapInArrow(run, schema), "scanned")


def _fetched(docs: DataFrame, wanted: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` over (text, what is wanted of it, doc_id, digest); ``wanted``: (digest, doc_id, want), one row for each. Equal rows of the
    table are one."""
    texts = docs.dropDuplicates(["digest", "doc_id"])
    return wanted.join(texts, ["digest", "doc_id"]).select("text", "want", "doc_id", "digest").mapInArrow(fn, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int, dict]]:
    """(words of each wanted stretch, with a blank before each; rows: doc_id and the stretch)."""
    for batch in steps(batches, size=PORTION):
        for text, want, doc, _ in zip(*(c.to_pylist() for c in batch.columns)):
            w = text.encode("utf-8", "replace").translate(TABLE).split()
            for x in want:
                yield doc, x, w[x["lo"] : x["hi"] + WINDOW]


def _texts_of_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    size = 0
    for doc, x, w in _pieces(batches):
        out.append((x["h"], x["c"], doc, b" ".join(w)))
        size += len(out[-1][3])
        if size > PORTION:
            yield _batch(out)
            out, size = [], 0
    yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([],) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.binary()))], ["h", "c", "doc_id", "t"])


def _windows_of_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window by its digest."""
    out: list[tuple] = []
    for doc, x, w in _pieces(batches):
        for i in range(len(w) - WINDOW + 1):
            out.append((i, x["c"], doc, hashlib.blake2b(b" ".join(w[i : i + WINDOW]), digest_size=16).digest()))
        if len(out) > 50_000:
            yield _batch(out)
            out = []
    yield _batch(out)


def nodes(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows begin in sequences of word ids (``row``: which sequence), and each one's node at depth ``WINDOW`` of their suffix
    tree. Nodes of a level are numbered in the order of their words."""
    name, depth = ids.astype(np.int64), 1
    while depth * 2 <= WINDOW:
        name = np.unique(name[:-depth] * (name.max(initial=0) + 1) + name[depth:], return_inverse=True)[1]
        depth *= 2
    rest = WINDOW - depth
    begin = np.flatnonzero(row[: len(row) - WINDOW + 1] == row[WINDOW - 1 :])
    pair = name[begin] * (name.max(initial=0) + 1) + name[begin + rest]
    return begin, np.unique(pair, return_inverse=True)[1]


def repeats(texts: list[bytes], ids: np.ndarray) -> list[tuple[int, list[dict[str, int]]]]:
    """For texts with the ids of their documents: which windows (as ranges of places) also begin in one with a smaller id."""
    out = []
    for w in word_arrays(texts, TABLE, WINDOW - 1, 1 << 31):
        if len(w.row) < WINDOW:
            continue
        begin, node = nodes(w.array().dictionary_encode().indices.to_numpy(), w.row)
        if not len(begin):
            continue
        of = ids[w.row[begin]]
        least = np.full(node.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, of)
        hit = begin[of > least[node]]
        row, place = w.row[hit], w.place[hit]
        new = np.flatnonzero(np.append(True, (np.diff(place) != 1) | (np.diff(row) != 0))) if len(hit) else np.zeros(0, int)
        end = np.append(new[1:] - 1, len(hit) - 1)
        by: dict[int, list] = {}
        for r, a, b in zip(row[new].tolist(), place[new].tolist(), place[end].tolist() if len(hit) else []):
            by.setdefault(r, []).append({"a": a, "b": b})
        out += by.items()
    return out


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, ranges) of stretches; batches come in the order of anchors, and those of an anchor stay together."""
    held: list[tuple] = []
    size, now = 0, None

    def solved() -> pa.RecordBatch:
        found = repeats([t for _, _, t in held], np.array([d for _, d, _ in held], np.int64))
        return pa.RecordBatch.from_arrays([pa.array([held[r][0] for r, _ in found], pa.binary()), pa.array([x for _, x in found], _RANGES)], ["c", "ranges"])

    for batch in batches:
        for h, c, doc, t in zip(*(x.to_pylist() for x in batch.columns)):
            if h != now and size > GROUP_BYTES:
                yield solved()
                held.clear()
                size = 0
                release()
            now = h
            held.append((c, doc, t))
            size += len(t)
    yield solved()


def repeated_ranges(scanned: DataFrame, docs: DataFrame) -> DataFrame:
    """(digest, doc_id, want): for each text with repeated windows, but later copies of a text, the word ranges [a, b) that go."""
    lead = scanned.where(f"doc_id is not null and n_words >= {WINDOW}").groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("m")).select("m.row")
    every = scanned.join(lead, "row").select("row", "doc_id", F.explode("stretches").alias("s")).select("row", "doc_id", "s.*")
    shared = every.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("h")
    every = written(every.join(shared, "h"), "stretches")
    kinds = written(every.groupBy("c").agg(F.min("h").alias("h"), F.min(F.struct("doc_id", "row", "lo", "hi")).alias("rep"), F.max("doc_id").alias("last")), "kinds")
    groups = kinds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    mixed = written(kinds.join(groups, "h").select("h", "n", "c", "rep.*"), "mixed")
    ids = scanned.select("row", "digest", "doc_id")

    def wanted(part: DataFrame) -> DataFrame:
        return part.groupBy("row").agg(F.collect_list(F.struct("h", "c", "lo", "hi")).alias("want")).join(ids, "row").select("digest", "doc_id", "want")

    texts = _fetched(docs, wanted(mixed.where(F.col("n") <= GROUP)), _texts_of_stretches, "h long, c binary, doc_id long, t binary")
    found = texts.repartition("h").sortWithinPartitions("h").mapInArrow(_trees, "c binary, ranges array<struct<a:int,b:int>>")
    if mixed.where(F.col("n") > GROUP).limit(1).count():
        windows = _fetched(docs, wanted(mixed.where(F.col("n") > GROUP)), _windows_of_stretches, "h long, c binary, doc_id long, t binary")
        windows = written(windows.select(F.col("h").cast("int").alias("a"), "c", "doc_id", "t"), "windows")
        least = windows.groupBy("t").agg(F.min("doc_id").alias("least"))
        hit = windows.join(least, "t").where("doc_id > least").groupBy("c").agg(F.collect_list(F.struct("a", F.col("a").alias("b"))).alias("ranges"))
        found = found.unionByName(hit)
    found = written(found, "found")
    plan = kinds.select("c", F.col("rep.doc_id").alias("first"), "last").join(found, "c", "left").where("first < last or ranges is not null")
    all_of = F.array(F.struct(F.lit(0).alias("a"), (F.col("hi") - F.col("lo")).alias("b")))
    own = F.when(F.col("doc_id") > F.col("first"), all_of).otherwise(F.col("ranges"))
    at = every.join(plan, "c").select("row", "lo", own.alias("own")).where("own is not null")
    cut = F.transform("own", lambda x: F.struct((x["a"] + F.col("lo")).alias("a"), (x["b"] + F.col("lo") + WINDOW).alias("b")))
    want = at.select("row", cut.alias("cut")).groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("cut"))).alias("want"))
    out = written(want.join(ids, "row").select("digest", "doc_id", "want"), "ranges")
    forget(every, kinds, mixed, found)
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, size=PORTION):
        kept, removed = [], []
        for text, want, _, _ in zip(*(c.to_pylist() for c in batch.columns)):
            w = text.encode("utf-8", "replace").translate(TABLE).split()
            out, at = [], 0
            for x in want:
                out += w[at : x["a"]]
                at = max(at, x["b"])
            out += w[at:]
            kept.append(b" ".join(out).decode("utf-8", "replace"))
            removed.append(len(w) - len(out))
        yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(2), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["digest", "doc_id", "n_removed", "kept"])


def keep_first(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, the hash of what is kept (``kept_sha256``), and the kept words joined by
    one blank where some but not all words go (``kept``; else null)."""
    ship_package(df.sparkSession)
    docs = df.select(F.col(id_column).cast("long").alias("doc_id"), F.unhex(F.sha2(F.col(text_column), 256)).alias("digest"), F.col(text_column).alias("text"))
    scanned = _scanned(docs)
    part = _fetched(docs, repeated_ranges(scanned, docs), _cut, "digest binary, doc_id long, n_removed long, kept string")
    # Only compact columns of all documents: copies know their text's smallest id.
    least = scanned.where(f"n_words >= {WINDOW}").groupBy("digest").agg(F.min("doc_id").alias("least"))
    rows = scanned.select("doc_id", "digest", "n_words", "whole").join(least, "digest", "left").join(part, ["digest", "doc_id"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    kept = F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(F.col("kept").isNotNull(), F.sha2("kept", 256)).otherwise(F.col("whole"))
    return rows.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"), kept.alias("kept_sha256"), "kept")
