"""Importance resampling against plain counting."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from loomwright.llm import importance
from loomwright.llm.queries import queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def brute(documents, target):
    known = [(i, *features(t)) for i, t in documents]
    s, t = Counter(b for *_, bs in known for b in bs), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for i, n, bs in known:
        weight = sum(map(gain, bs))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * 5 // 100])}
    return sorted(((i, n, w, s, rank.get(id(r))) for r in rows for i, _, n, w, s in [r]), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("portion", [importance.PORTION, 300])
def test_resample(spark, monkeypatch, portion):
    """Odd texts, ties, repeated rows, texts over a portion."""
    monkeypatch.setattr(importance, "PORTION", portion)
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()] + [None, "", "one"]
    docs += [(None, None), (9001, ""), (9002, " -- "), (9003, "A b"), (9004, "Ünd é日 " * 30), (9004, "Ünd é日 " * 30), (None, "b " * 40), (9005, "x" * 70 + " " + "y" * 500), (9006, "w" * 900), (9007, "a b c\x00d e f G")]
    df = spark.createDataFrame([(i, t, 1, "r", 2) for i, t in docs], "doc_id long, text string, rank int, row string, score int").repartition(5)
    assert got(importance.resample(df, spark.createDataFrame([(t,) for t in items], "text string"))) == brute(docs, items)


def test_query_and_empty_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [r[0] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("text").collect()]
    name = next(q for q in queries() if q.startswith("op12_"))
    want = brute(docs, items)
    assert got(queries()[name](spark, sf)) == want and sum(r[4] is not None for r in want) > 20
    d, b = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "benchmark"))
    assert importance.resample(d.limit(0), b).count() == 0
    assert got(importance.resample(d, b.limit(0))) == brute(docs, [])
