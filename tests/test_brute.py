"""Queries that SQL cannot express, and operators with several ways, against plain Python."""

import difflib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomwright import plans
from loomwright.functions import records as X
from loomwright.functions.sequential import edit_breakdown
from loomwright.operators import containment
from loomwright.operators import retrieval as R
from loomwright.operators import windows as W
from loomwright.operators.external import ask

SF = "/root/testdata/sf0.001"


def got(spark, name):
    return [tuple(r) for r in plans.QUERIES[name](spark, SF).collect()]


def rows_of(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{table}.parquet").select(*columns).collect()]


@pytest.fixture(scope="module")
def clicks(spark):
    """Events by user in time order: (seconds, id, kind)."""
    by = defaultdict(list)
    for user, at, i, kind in rows_of(spark, "events", "user_id", F.unix_timestamp(F.col("ts").cast("timestamp")), "event_id", "event_type"):
        by[user].append((at, i, kind))
    return {u: sorted(x) for u, x in by.items()}


def test_pr2(spark):
    def scrub(s):
        for pattern, new in (("[A-Za-z0-9._]+@[A-Za-z0-9.]+", "<mail>"), ("(password|token|key)=[0-9a-f]{8,}", r"\1=<secret>"), (r"\+[0-9]{2}[ -][0-9 -]{6,}", "<phone>"), ("(?<![0-9])[0-9]{7,}(?![0-9])", "<number>")):
            s = re.sub(pattern, new, s)
        return s

    docs = rows_of(spark, "documents", "doc_id", "text")
    assert sorted(got(spark, "pr2_shape_scrub")) == sorted((i, scrub(t)) for i, t in docs)
    assert any("<" in scrub(t) and scrub(t) != t for _, t in docs)


def test_tx13_tx14(spark):
    parts = rows_of(spark, "part", "p_partkey", F.lower("p_name"), F.lower("p_type"))
    assert dict(got(spark, "tx13_ratio")) == {k: round(difflib.SequenceMatcher(None, a, b).ratio(), 6) for k, a, b in parts}
    assert {r[0]: r[1:] for r in got(spark, "tx14_edit_breakdown")} == {k: edit_breakdown(a, b) for k, a, b in parts}


def test_set5(spark):
    by = defaultdict(list)
    for i, t in sorted((i, t or "") for i, t in rows_of(spark, "documents", "doc_id", "text")):
        kept = by[t[:24]]
        if not any(t in k or k in t for _, k in kept):
            kept.append((i, t))
    assert sorted(i for i, _ in got(spark, "set5_contained_dedupe")) == sorted(i for kept in by.values() for i, _ in kept)


def test_sm6(spark, clicks):
    kinds = {u: {k for _, _, k in x} for u, x in clicks.items()}
    want = []
    for batch in {u % 10 for u in kinds}:
        left, seen = sorted(u for u in kinds if u % 10 == batch), set()
        for place in range(min(3, len(left))):
            best = min(left, key=lambda u: (-len(kinds[u] - seen), u))
            want.append((batch, best, place))
            seen |= kinds[best]
            left.remove(best)
    assert sorted(got(spark, "sm6_category_cover")) == sorted(want)


def test_jn11(spark, clicks):
    want = []
    for u, x in clicks.items():
        free = [(at, i) for at, i, k in x if k == "view"]
        for at, i, k in x:
            if k == "purchase":
                near = sorted((abs(a - at), a, j) for a, j in free)
                hit = near[0] if near and near[0][0] <= 43200 else None
                want.append((u, i, hit and hit[2]))
                if hit:
                    free.remove((hit[1], hit[2]))
    assert sorted(got(spark, "jn11_nearest_unused"), key=str) == sorted(want, key=str)


def test_win11(spark):
    want = []
    for i, t in rows_of(spark, "documents", "doc_id", "text"):
        cue = None
        for n, line in enumerate(t.split("\n"), 1):
            if line:
                a, b = n * 2.0, n * 2.0 + len(line) / 20
                if cue and a - cue[2] <= 1.2 + 1e-9 and len(cue[3]) + len(line) <= 60:
                    cue[2], cue[3] = max(cue[2], b), cue[3] + line
                else:
                    cue = [i, a, b, line]
                    want.append(cue)
    assert sorted(got(spark, "win11_line_merge")) == sorted(map(tuple, want))


def test_win14(spark, clicks):
    """Every fragment begins and ends within reach of its anchors, all anchors are covered once, none overlap."""
    mine = defaultdict(lambda: defaultdict(list))
    for u, i, k in got(spark, "win14_anchor_fragments"):
        mine[u][k].append(i)
    for u, x in clicks.items():
        x = sorted((i, at, k) for at, i, k in x)
        place = {i: n for n, (i, _, _) in enumerate(x)}
        anchors = [n for n, (_, _, k) in enumerate(x) if k == "purchase"]
        runs = [sorted(place[i] for i in f) for f in mine[u].values()]
        assert all(r == list(range(r[0], r[-1] + 1)) for r in runs)
        covered = [n for r in runs for n in r]
        assert len(covered) == len(set(covered)) and set(anchors) <= set(covered)
        for r in runs:
            assert all(x[b][1] - x[a][1] <= 86400 for a, b in zip(r, r[1:])) and any(n in anchors for n in r)
            quiet = [n for n in r if n > max(a for a in anchors if a in r)]
            assert len(quiet) <= 3


@pytest.mark.parametrize("block", [4_000_000, 40])
def test_held_quotes(spark, monkeypatch, block):
    monkeypatch.setattr(containment, "BLOCK_BYTES", block)
    texts = [(1, "abcabc"), (1, "abcabc"), (2, None), (3, ""), (None, "日本語 x"), (4, "a" * 5000)]
    quotes = [(10, "abc"), (11, "bca"), (11, "bca"), (12, None), (13, ""), (14, "本語 "), (15, "aaaa"), (None, "c")]
    t = spark.createDataFrame(texts, "id long, body string")
    q = spark.createDataFrame(quotes, "item long, quote string")
    want = sorted(((i, j) for i, b in texts for j, x in quotes if b is not None and x is not None and x in b), key=str)
    assert sorted(map(tuple, containment.held_quotes(t, ["id"], "body", q, "quote").select("id", "item").collect()), key=str) == want
    assert containment.held_quotes(t.limit(0), ["id"], "body", q, "quote").count() == 0
    assert containment.held_quotes(t, ["id"], "body", q.limit(0), "quote").count() == 0


def test_bm25_beyond_the_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ab ab 日本"), (2, "abc"), (3, None), (4, "")], "id long, body string")
    q = spark.createDataFrame([(7, "abab"), (8, "日"), (9, None)], "q long, words string")
    monkeypatch.setattr(R, "FEW_QUERIES", 0)
    few = sorted(map(tuple, R.bm25(docs, q, "id", "body", "q", "words").collect()))
    assert len(few) == 3 and R.bm25(docs.limit(0), q, "id", "body", "q", "words").count() == 0
    for most in (1_000_000, 0):
        monkeypatch.setattr(R, "DENSE_TERMS", 0)
        monkeypatch.setattr(R, "MAX_TERMS", most)
        many = sorted(map(tuple, R.bm25(docs, q, "id", "body", "q", "words").collect()))
        assert [x[:2] for x in many] == [x[:2] for x in few] and all(abs(x[2] - y[2]) < 1e-12 for x, y in zip(many, few))
    assert R.bm25(docs, q.limit(0), "id", "body", "q", "words").count() == 0


def test_places_by_key_and_range(spark):
    rows = [(k if k else None, v) for v in range(400) for k in ([1] * 1 + [v % 3])]
    df = spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(rows)], "k long, v long, n long")
    want, seen = [], defaultdict(int)
    for k, v, n in sorted([(k, v, n) for n, (k, v) in enumerate(rows)], key=lambda x: (x[1], x[2])):
        seen[k] += 1
        want.append((n, seen[k]))
    assert sorted((r["n"], r["place"]) for r in W.place_in_order(df, ["v", "n"], "place", ("k",)).collect()) == sorted(want)
    assert W.place_in_order(df.limit(0), ["v", "n"], "place").count() == 0


@pytest.mark.parametrize("pattern, want", [("a|b", ["a", "b"]), ("x[ab]y", ["xay", "xby"]), ("(?<!q)a[bb]", ["ab"]), ("a+", []), ("[a-c]", []), ("", []), (None, [])])
def test_literal_variants(pattern, want):
    assert X.literal_variants(pattern) == want


def test_calls_stop_where_they_should():
    answers = iter([(500, ""), (200, ""), (200, ""), (200, "yes")])
    assert ask(lambda m, p: next(answers), "p", ("a", "b"), most=5, empties=2, pause=0) == ("yes", "b", 4, 200)
    assert ask(lambda m, p: (403, ""), "p", ("a", "b"), most=5, empties=2, pause=0) == (None, "b", 2, 403)


def test_report_edges():
    assert X.redact_report(None, {}) is None and X.redact_report("群圣经\n\n1. “q” —— A ", {"A": "s1"}) == "群圣经\n\n1. “q” —— @s1 "


@pytest.mark.parametrize("block", [20_000, 3])
def test_nearest_cosine(spark, monkeypatch, block):
    import math

    from loomwright.operators import nearest

    monkeypatch.setattr(nearest, "BLOCK", block)
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.0]), (4, [1.0, 1.0]), (5, [0.0, 0.0]), (6, None), (7, [0.0, 9.0]), (8, [0.5, 9.0])]
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b)), 6) if any(a) and any(b) else 0.0
    want = []
    for k, v in rows:
        best = max(((cos(v, w), -j) for j, w in rows if v and w and j != k), default=(0, 0))
        if best[0] > 0:
            want.append((k, -best[1], best[0]))
    df = spark.createDataFrame(rows, "id long, x array<double>")
    assert sorted(map(tuple, nearest.nearest_cosine(df, "id", "x").collect())) == want
    assert nearest.nearest_cosine(df.limit(0), "id", "x").count() == 0
