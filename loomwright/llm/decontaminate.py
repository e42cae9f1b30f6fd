"""Benchmark decontamination by one Aho-Corasick automaton over normalized items.

Normal form: A-Z lower-cased, words are runs of ASCII digits, ASCII letters and all characters from
U+0080 on, joined by one blank. A window is 10 consecutive words of an item; an item of 1 to 9 words is one
window; an item without words has none. The automaton holds every window with a blank on either side, so
one pass over a document's normal form finds all windows at word bounds; offsets in the normal form map
back to words, and for documents that were hit to characters of the original text.

The items are a stated query set. They are cut into pieces of ``PIECE`` words that overlap by a window less a word, and
equal pieces of one item count once. The pieces' size is measured first: up to ``BLOCK_BYTES`` they are one
automaton; beyond that they are dealt by a hash into blocks, each of which is collected, broadcast and scanned in turn.

Null or empty documents and items have no words. Repeated items count once by item_id; repeated documents
are judged each. An item without an id hits words like any other, but there is no id to count or to list. An empty
benchmark hits nothing; an empty table of documents gives an empty result. A very long document is one string of words in one task;
each block of items is one more pass over the texts (a benchmark of 1 GB takes 500). Columns beside id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, steps, written

WINDOW = 10
#: Bytes of item text in one automaton, which takes about 100 times as much memory at most.
BLOCK_BYTES = 2_000_000
#: Words of an item that stay together.
PIECE = 5_000
_WORD_BYTES = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if (b + 32 if 65 <= b <= 90 else b) in _WORD_BYTES else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def automaton(items: list[tuple[str | None, str | None]]):
    """The automaton over all windows: each match gives (number of words, places of the item ids)."""
    import ahocorasick

    of: dict[str, tuple[int, set[int]]] = {}
    for k, (_, text) in enumerate(items):
        w = words(text)
        size = min(WINDOW, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            key = f" {b' '.join(w[i : i + size]).decode('latin-1')} "
            of.setdefault(key, (size, set()))[1].add(k)
    found = ahocorasick.Automaton()
    for key, (size, who) in of.items():
        found.add_word(key, (size, tuple(who)))
    if len(found):
        found.make_automaton()
    return found


_BUILT: dict[tuple, tuple[object, list[str | None]]] = {}


def _built(key: tuple, items: list[tuple[str | None, str | None]]):
    if key not in _BUILT:
        _BUILT.clear()  # one block at a time
        _BUILT[key] = automaton(items), [i for i, _ in items]
    return _BUILT[key]


def scan(found, text: str | None) -> tuple[int, np.ndarray, set[int]]:
    """Words of a text, which of them are hit (empty: none), and the items that occur."""
    w = words(text)
    if not w or not len(found):
        return len(w), np.zeros(0, bool), set()
    normal = f" {b' '.join(w).decode('latin-1')} "
    matches = list(found.iter(normal))
    if not matches:
        return len(w), np.zeros(0, bool), set()
    blanks = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
    stop = np.searchsorted(blanks, [e for e, _ in matches])  # words before the match's last blank
    edge = np.zeros(len(w) + 1, np.int64)
    np.add.at(edge, stop - np.array([n for _, (n, _) in matches]), 1)
    np.add.at(edge, stop, -1)
    return len(w), np.cumsum(edge[:-1]) > 0, {k for _, (_, who) in matches for k in who}


def spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Character ranges of the original text whose words are hit, joined where consecutive."""
    at = [m.span() for m in _WORD.finditer(text)]
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


RESULT = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


def find_items(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document: words, words hit, ids of occurring items in string order, hit spans."""
    ship_package(df.sparkSession)
    out = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    first = True
    for key, known, last in blocks_of(benchmark, item_column, item_text):
        out = _one_block(out, known, key, first, last)
        first = False
    return out


def _one_block(df: DataFrame, known, key: tuple, first: bool, last: bool) -> DataFrame:
    """Scan one block; what blocks before have found comes in as a mask and item ids."""

    def run(batches):
        found, names = _built(key, known.value)
        for batch in steps(batches):
            texts = batch.column(1).to_pylist()
            masks = [None] * len(texts) if first else batch.column(2).to_pylist()
            before = [()] * len(texts) if first else batch.column(3).to_pylist()
            n_words, n_hit, items, places, kept = [], [], [], [], []
            for text, mask, seen in zip(texts, masks, before):
                n, hit, who = scan(found, text)
                if mask:
                    old = np.frombuffer(mask, bool)
                    hit = hit | old if len(hit) else old
                names_hit = sorted({*seen, *(names[k] for k in who if names[k] is not None)})
                items.append(names_hit)
                if last:
                    n_words.append(n)
                    n_hit.append(int(hit.sum()))
                    places.append(spans(text, hit) if len(hit) and hit.any() else [])
                else:
                    kept.append(hit.tobytes())
            items = pa.array(items, pa.list_(pa.string()))
            if last:
                where = pa.array(places, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), items, where], ["doc_id", "n_words", "n_hit", "items", "spans"])
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(kept, pa.binary()), items], ["doc_id", "text", "mask", "items"])

    return df.mapInArrow(run, RESULT if last else "doc_id long, text string, mask binary, items array<string>")


def digest(found: DataFrame) -> DataFrame:
    """The result of ``find_items`` with the items as a count and a hash, and of the hit spans (offsets in the original
    text) the number, the first start and the last end."""
    first, last = (F.try_element_at("spans", F.lit(k)) for k in (1, -1))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("spans").cast("long").alias("n_spans"), first["start"].cast("long").alias("first_start"), last["end"].cast("long").alias("last_end"),
    )


def _pieces(benchmark: DataFrame, item_column: str, item_text: str) -> DataFrame:
    """(i, t): items' normal forms, cut so that no window is lost."""

    def run(batches):
        for batch in steps(batches):
            ids, texts = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                for at in range(0, max(len(w) - WINDOW + 1, 1), PIECE - WINDOW + 1) if w else ():
                    ids.append(i)
                    texts.append(b" ".join(w[at : at + PIECE]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["i", "t"])

    ship_package(benchmark.sparkSession)
    return benchmark.select(F.col(item_column).cast("string").alias("i"), F.col(item_text).alias("t")).mapInArrow(run, "i string, t string").distinct()


def blocks_of(benchmark: DataFrame, item_column: str = "item_id", item_text: str = "text"):
    """Broadcast blocks of the items, one after the other, with a key for each."""
    spark = benchmark.sparkSession
    items = written(_pieces(benchmark, item_column, item_text), "items")
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        yield (uuid.uuid4().hex, block), spark.sparkContext.broadcast([(r["i"], r["t"]) for r in part.collect()]), block == blocks - 1


def clean(df: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents (all their columns) in which no window of an item occurs; no shuffle. Null and empty texts stay, repeated rows
    are judged each, an empty table stays empty."""
    ship_package(df.sparkSession)
    place = df.columns.index(text_column)

    def without(key, known):
        def run(batches):
            found, _ = _built(key, known.value)
            for batch in steps(batches):
                keep = [not scan(found, t)[1].any() for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    for key, known, _ in blocks_of(benchmark):
        df = df.mapInArrow(without(key, known), df.schema)
    return df


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()

