"""Token ids in files of fixed-width bit fields.

A file holds the ids of a run of documents, each id in the fewest bits that hold every id of the
vocabulary. Layout, all integers little-endian:

    magic ``LWTOK2\\n\\0`` | blocks | document ids (int64 each) | document ends, in ids (int64 each) |
    which documents have an id (a bit each, whole bytes) | footer: bits, ids in a block, documents, ids (uint64 each), magic

Every block holds ``BLOCK`` ids (the last one fewer) and ``BLOCK`` is a multiple of 8, so block k begins
at byte ``8 + k * BLOCK * bits / 8``: any range of ids is read by seeking and unpacked by numpy.

Documents are dealt to files by ranges of their id and sorted, so the files in order are the corpus in
order; there are as many files as the session has shuffle partitions, and more where one would hold over ``FILE_BYTES`` of text. A file is first written under a name of its task attempt and then moved, so a lost executor or a
repeated task leaves one whole file. Null text counts as empty; a very long one is encoded by itself and read in portions; a null id sorts first and stays null, whatever ids there are;
repeated ids are kept, ordered by a hash of the text; equal rows may lie in several files. Other columns are ignored. An empty table gives no files and an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import filesystem, new_folder, ship_package, steps

MAGIC = b"LWTOK2\n\0"
BLOCK = 4096
#: Bytes of text that one file holds, or so: its writer holds an id and an end for each document.
FILE_BYTES = 64_000_000


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` as consecutive fields of ``bits`` bits, lowest bit first, filled up to a whole byte."""
    n = len(ids)
    wide = np.zeros(-(-n // 8) * 8, np.uint64)
    wide[:n] = ids
    lanes = wide.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), np.uint8)
    for k in range(8):
        for j in range(k * bits // 8, ((k + 1) * bits - 1) // 8 + 1):
            shift = k * bits - 8 * j
            out[:, j] |= ((lanes[:, k] << np.uint64(shift) if shift >= 0 else lanes[:, k] >> np.uint64(-shift)) & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[: -(-n * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` fields of ``pack``'s bytes."""
    groups = -(-n // 8)
    raw = np.zeros((groups, bits), np.uint64)
    raw.reshape(-1)[: len(data)] = np.frombuffer(data, np.uint8)
    out = np.zeros((groups, 8), np.uint64)
    for k in range(8):
        for j in range(k * bits // 8, ((k + 1) * bits - 1) // 8 + 1):
            shift = k * bits - 8 * j
            out[:, k] |= raw[:, j] >> np.uint64(shift) if shift >= 0 else raw[:, j] << np.uint64(-shift)
    return (out.reshape(-1)[:n] & np.uint64((1 << bits) - 1)).astype(np.int64)


class Writer:
    """Writes one file; ids are kept only up to a block."""

    def __init__(self, uri: str, name: str, attempt: str, bits: int) -> None:
        self.fs, self.folder = filesystem(uri)
        self.fs.create_dir(self.folder, recursive=True)
        self.target, self.temp, self.bits = f"{self.folder}/{name}", f"{self.folder}/_{name}.{attempt}", bits
        self.out = self.fs.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.rest, self.docs, self.known, self.ends, self.n = np.zeros(0, np.int64), [], [], [], 0

    def add(self, docs: np.ndarray, known: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """``known``: which documents have an id."""
        self.docs.append(docs.astype("<i8"))
        self.known.append(known)
        self.ends.append((self.n + np.cumsum(sizes)).astype("<i8"))
        self.n += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        whole = len(self.rest) // BLOCK * BLOCK
        if whole:
            self.out.write(pack(self.rest[:whole], self.bits))
            self.rest = self.rest[whole:]

    def close(self) -> None:
        self.out.write(pack(self.rest, self.bits))
        n = sum(map(len, self.docs))
        for x in (*self.docs, *self.ends, np.packbits(np.concatenate([np.zeros(0, bool), *self.known]))):
            self.out.write(x.tobytes())
        self.out.write(np.array([self.bits, BLOCK, n, self.n], "<u8").tobytes() + MAGIC)
        self.out.close()
        self.fs.move(self.temp, self.target)


class Reader:
    """Random access to one file."""

    def __init__(self, uri: str) -> None:
        fs, path = filesystem(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        foot = self.f.read_at(40, size - 40)
        if foot[32:] != MAGIC or self.f.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        self.bits, self.block, n, self.n = map(int, np.frombuffer(foot[:32], "<u8"))
        at = size - 40 - 16 * n - (n + 7) // 8
        self.docs = np.frombuffer(self.f.read_at(8 * n, at), "<i8")
        self.ends = np.frombuffer(self.f.read_at(8 * n, at + 8 * n), "<i8")
        self.known = np.unpackbits(np.frombuffer(self.f.read_at((n + 7) // 8, at + 16 * n), np.uint8), count=n).astype(bool)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64) if n else self.ends

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``, reading only their blocks."""
        first = start // self.block * self.block
        stop = min(stop, self.n)
        begin, end = first * self.bits // 8, -(-stop * self.bits // 8)
        return unpack(self.f.read_at(end - begin, 8 + begin), self.bits, stop - first)[start - first :]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.ends[k]))


def write_tokens(df: DataFrame, path: str, folder: str | None = None, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write the files; returns their manifest (file, uri,
    documents, tokens, ``base``: tokens in all files before). Runs at once."""
    spark = df.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "tokens")

    def run(batches):
        tokenizer = bpe.loaded(path)
        size = max(tokenizer.vocabulary.size, end_id + 1)
        task = TaskContext.get()
        writer = None
        for batch in steps(batches):
            if writer is None:
                name = f"part-{task.partitionId():08d}.lwtok"
                writer = Writer(folder, name, str(task.taskAttemptId()), bits_for(size))
            ids, n = tokenizer.ids(batch.column(1).to_pylist())
            at = np.cumsum(n)
            ids = np.insert(ids.astype(np.int64), at, end_id)
            docs = batch.column(0).cast(pa.int64())
            writer.add(docs.fill_null(0).to_numpy(zero_copy_only=False), docs.is_valid().to_numpy(zero_copy_only=False), ids, n + 1)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "uri": [f"{folder}/{name}"], "documents": pa.array([sum(map(len, writer.docs))], pa.int64()), "tokens": pa.array([writer.n], pa.int64())})

    # Ranges of (id, hash of the text, row): rows of one id, or without any, and equal rows are dealt to several files too.
    size = df.agg(F.sum(F.octet_length(text_column) + 16)).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    dealt = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("_h"), F.monotonically_increasing_id().alias("_row"))
    dealt = dealt.repartitionByRange(files, "doc_id", "_h", "_row").sortWithinPartitions("doc_id", "_h", "_row").select("doc_id", "text")
    manifest = dealt.mapInArrow(run, "part int, uri string, documents long, tokens long")
    where = new_folder(spark, "manifest")
    manifest.write.parquet(where)
    # One row for each file; the running sum needs them in order.
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return spark.read.schema("part int, uri string, documents long, tokens long").parquet(where).withColumn("base", F.coalesce(before, F.lit(0)))


def read_tokens(manifest: DataFrame, at_once: int = 1 << 20) -> DataFrame:
    """Read the files back, about ``at_once`` ids at a time: for each document its place and checksum."""
    ship_package(manifest.sparkSession)

    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                r, k = Reader(uri), 0
                while k < len(r.docs):
                    stop = max(k + 1, int(np.searchsorted(r.starts, r.starts[k] + at_once)))
                    a = int(r.starts[k])
                    if r.ends[stop - 1] - a <= 4 * at_once:
                        raw = memoryview(r.ids(a, int(r.ends[stop - 1])).astype("<u4").tobytes())
                        crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip((r.starts[k:stop] - a).tolist(), (r.ends[k:stop] - a).tolist())]
                    else:  # one very long document
                        stop, crc = k + 1, 0
                        for s in range(a, int(r.ends[k]), at_once):
                            crc = zlib.crc32(r.ids(s, min(s + at_once, int(r.ends[k]))).astype("<u4").tobytes(), crc)
                        crcs = [crc]
                    docs = r.docs[k:stop]
                    yield pa.RecordBatch.from_arrays([pa.array(docs, mask=~r.known[k:stop]), pa.array(base + r.starts[k:stop]), pa.array(r.ends[k:stop] - r.starts[k:stop]), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    k = stop

    n = manifest.count()
    return manifest.select("uri", "base").repartition(max(1, n)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def delete_files(spark: SparkSession, folder: str) -> None:
    fs, path = filesystem(folder)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)
