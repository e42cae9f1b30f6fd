"""Removal of repeated word runs against a table of all windows."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from loomwright.llm import substrings
from loomwright.llm.queries import queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in words:
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if i is not None and (key not in first or i < first[key]):
                first[key] = i
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def odd_docs():
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "c", "the", "é日", "x,"])
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 70, 200, 400)]
    docs = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [word() for _ in range(rng.randint(0, 60))] + (rng.choice(passages) if rng.random() < 0.6 else [])
            if rng.random() < 0.2 and w:
                w[rng.randrange(len(w))] = f"u{i}"
        docs.append((rng.randint(0, 90), rng.choice([" ", "\n", " \t "]).join(w)))
    docs += [(i, " ".join(passages[5])) for i in (500, 7, 300, 7)] + [(i, " ".join(["same"] * n)) for i, n in ((600, 49), (601, 50), (602, 130), (603, 700))]
    docs += [(None, " ".join(passages[4])), (None, None), (700, None), (701, ""), (702, " \n"), (703, "q" * 5000 + " " + " ".join(passages[4])), (704, " ".join(passages[3]))]
    # A passage that many hold, each with surroundings of its own.
    return docs + [(1000 + i, " ".join([*(f"l{i}x{k}" for k in range(i % 60)), *passages[4], *(f"r{i}x{k}" for k in range(60 - i % 60))])) for i in range(60)]


@pytest.mark.parametrize(("group", "bytes_", "portion"), [(substrings.GROUP, substrings.GROUP_BYTES, substrings.PORTION), (5, 3000, 900)])
def test_keep_first(spark, monkeypatch, group, bytes_, portion):
    """Odd texts in one group, and in many small groups with long texts in portions and hot ones by whole windows."""
    for name, value in (("GROUP", group), ("GROUP_BYTES", bytes_), ("PORTION", portion)):
        monkeypatch.setattr(substrings, name, value)
    docs = odd_docs()
    df = spark.createDataFrame([(i, t, 1, b"x", 2) for i, t in docs], "doc_id long, text string, row int, digest binary, h int").repartition(5)
    assert got(substrings.keep_first(df)) == brute(docs)
    assert substrings.keep_first(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    name = next(q for q in queries() if q.startswith("op13_"))
    want = brute(docs)
    assert got(queries()[name](spark, sf)) == want and sum(r[2] > 0 for r in want) > 50


def test_nodes_are_equal_windows():
    rng = random.Random(2)
    texts = [b" ".join(rng.choice([b"a", b"b"]) for _ in range(rng.randint(40, 90))) for _ in range(30)]
    texts += [texts[0], b" ".join([b"a"] * 300)]
    by = defaultdict(list)
    for k, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - 49):
            by[tuple(w[i : i + 50])].append((k, i))
    ids = [rng.randint(0, 9) for _ in texts]
    want = sorted((k, i) for who in by.values() for k, i in who if ids[k] > min(ids[x] for x, _ in who))
    found = substrings.repeats(texts, substrings.np.array(ids))
    assert sorted((k, i) for k, ranges in found for r in ranges for i in range(r["a"], r["b"] + 1)) == want
