"""What several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from loomwright.session import forget, new_folder, shared_dir, ship_package, table, written  # noqa: F401  (for the operators)

#: Rows and bytes of text that one step in a Python worker handles at a time.
STEP_ROWS, STEP_BYTES = 2_000, 4_000_000


def release() -> None:
    """Give memory that was freed back to the system: an executor's limit counts what its Python workers hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", rows: int = STEP_ROWS, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``rows`` rows and about ``size`` bytes of one column."""
    for batch in batches:
        at, n = 0, batch.num_rows
        if not n:
            continue
        each = batch.nbytes / n
        step = max(1, min(rows, int(size / max(each, 1))))
        while at < n:
            yield batch.slice(at, step)
            at += step
        release()


class Words(NamedTuple):
    """Words of some texts in one array of bytes, each with a blank before it."""

    data: np.ndarray
    offsets: np.ndarray
    #: For each word the row of its text, and its place in the text.
    row: np.ndarray
    place: np.ndarray
    #: Whether the text (a long one, on its own) goes on; its last words then come again.
    more: bool

    def array(self) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(self.row), [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)])


def word_arrays(texts: list[bytes | str | None], table: bytes, again: int, portion: int) -> Iterator[Words]:
    """The words of texts as arrays, some ``portion`` bytes at a time; ``table`` maps each byte that is in no word to a blank.
    Portions of one text overlap by ``again`` words. Texts without words are passed over."""
    raw: list[bytes] = []
    rows: list[int] = []
    held = 0
    for k, text in enumerate([*texts, None]):
        flush = k == len(texts)
        normal = b"" if not text else (text if isinstance(text, bytes) else text.encode("utf-8", "replace")).translate(table) + b" "
        if len(normal) > portion:
            yield from _split(normal, np.zeros(1, np.int64), np.array([k]), again, portion)
            continue
        if normal:
            raw.append(normal)
            rows.append(k)
            held += len(normal)
        if raw and (flush or held > portion):
            yield from _split(b"".join(raw), np.cumsum([0, *map(len, raw[:-1])]), np.array(rows), again, 0)
            raw, rows, held = [], [], 0


def _split(normal: bytes, starts: np.ndarray, rows: np.ndarray, again: int, portion: int) -> Iterator[Words]:
    at, before, size = 0, 0, 2 * portion or len(normal)
    while at < len(normal):
        end = normal.rfind(b" ", at, at + size) + 1 if at + size < len(normal) else len(normal)
        last = end == len(normal)
        b = np.frombuffer(b" " + normal[at:end], np.uint8)
        held = b != 32
        begins = np.flatnonzero(held[1:] & ~held[:-1])  # each word's blank
        if not last and len(begins) <= again:
            size *= 2  # words of megabytes
            continue
        if len(begins):
            held[begins] = True
            offsets = np.append(np.cumsum(held)[begins] - 1, held.sum()).astype(np.int32)
            text = np.searchsorted(starts, begins + at, "right") - 1
            place = np.arange(len(begins)) - np.searchsorted(text, text) + before
            yield Words(b[held], offsets, rows[text], place, not last)
        if last:
            return
        at, before, size = at + int(begins[-again]), before + len(begins) - again, 2 * portion


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system that executors reach, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def from_texts(df: DataFrame, fn, schema: str, *columns: str) -> DataFrame:
    """``mapInArrow`` over only the columns that ``fn`` takes."""
    ship_package(df.sparkSession)
    return df.select(*columns).mapInArrow(fn, schema)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def salted_rank(df: DataFrame, keys: list[str], order: list[str], n_rows: int, name: str = "rank", per_group: int = 5_000) -> DataFrame:
    """``df`` with a gapless rank from 0 within ``keys``, in plain DataFrame functions.

    A hot key may hold most rows, so no task ranks a key as a whole: the rows of a key are dealt
    into buckets by a hash of ``order``, ranked in each bucket, and moved up by what the buckets before
    hold. Ties in ``order`` are ranked in any order. The table of bucket sizes has one row for each
    key and bucket and is joined back by Spark's own choice of strategy.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    n = min(1_000_000, max(32, -(-n_rows // per_group)))
    # With ``name``: else rows that an earlier rank put side by side would share a bucket again.
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.lit(name)), F.lit(n)).cast("int"))
    sizes = dealt.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"), before.alias("_before"))
    ranked = dealt.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order)) - 1)
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_bucket") == F.col("_b")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return ranked.join(sizes, cond, "left").withColumn(name, F.col("_before") + F.col("_r")).drop("_bucket", "_b", "_before", "_r", *[f"_k{i}" for i in range(len(keys))])


def grouped(batches: Iterator, n: int) -> Iterator[list]:
    while part := list(itertools.islice(batches, n)):
        yield part
