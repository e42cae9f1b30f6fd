"""Media columns: texts stored as baseline JPEGs, and features of JPEG columns.

``store`` turns every text into a payload (UTF-8, then blanks up to a positive multiple of 192 bytes) and
the payload into one or more JPEGs whose flat blocks are the bytes (see ``jpeg``); ``describe`` parses and
decodes a media column: dimensions and thumbnail hash of every image, and the payload that was read back.

Null text counts as empty, which is 192 blanks. Equal texts give equal media and features. Repeated rows
are stored each. Media that are null or no baseline JPEG give nulls. A payload of any length is stored in images of at most
1.57 MB. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jpeg
from .common import ship_package, steps

#: Bytes of text or media that are handled at once (a longer text is handled alone).
AT_ONCE = 1_000_000


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "replace")
    return raw.ljust(max(1, -(-len(raw) // jpeg.ROW)) * jpeg.ROW, b" ")


def store(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``df``: id, n_bytes, media."""
    ship_package(df.sparkSession)

    def run(batches):
        for batch in steps(batches, size=AT_ONCE):
            texts = batch.column(1).to_pylist()
            media = jpeg.encode([payload_of(t) for t in texts])
            size = [len((t or "").encode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _read(media: list[bytes | None], known: dict) -> list[tuple | None]:
    """(payload, feature) of each value; None for what isn't baseline JPEG."""
    joined = b"".join(m or b"" for m in media)
    at, images, of = 0, [], []
    for m in media:
        mine, end = [], at + len(m or b"")
        try:
            while at < end:
                image, at = jpeg.parse_fast(joined, at, known)
                mine.append(image)
        except (ValueError, IndexError, KeyError):
            mine = []
        at = end
        of.append(len(mine))
        images += mine
    try:
        planes = iter(jpeg.dc_images(joined, images))
    except (ValueError, IndexError, KeyError):
        if len(media) == 1:
            return [None]
        return [x for m in media for x in _read([m], known)]  # one of them is broken: each by itself
    shapes = iter(images)
    out = []
    for n in of:
        mine = [(next(shapes), next(planes)) for _ in range(n)]
        out.append((b"".join(p.tobytes() for _, p in mine), "+".join(f"{i.width}x{i.height}:{jpeg.average_hash(p)}" for i, p in mine)) if n else None)
    return out


def describe(df: DataFrame, media_column: str = "media") -> DataFrame:
    """The other columns of ``df`` (here doc_id, n_bytes) and what is read back from the media."""
    ship_package(df.sparkSession)

    def run(batches):
        known: dict = {}
        for batch in steps(batches, size=AT_ONCE):
            media = batch.column(2).to_pylist()
            found = _read(media, known)
            if len(known) > 10_000:
                known.clear()
            get = lambda f, kind: pa.array([x and f(x) for x in found], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2], get(lambda x: len(x[0]), pa.int64()), get(lambda x: hashlib.sha256(x[0]).hexdigest(), pa.string()), get(lambda x: zlib.crc32(x[0][-16:]), pa.int64()),
                    pa.array([m and len(m) for m in media], pa.int64()), pa.array([m and hashlib.sha256(m).hexdigest() for m in media], pa.string()), get(lambda x: x[1], pa.string()),
                ],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return df.select("doc_id", "n_bytes", media_column).mapInArrow(run, schema)
