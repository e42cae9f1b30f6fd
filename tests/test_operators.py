"""Boundary cases of operators, and every query of the registry against its SQL on the smallest tables."""

import difflib
import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from loomwright import plans
from loomwright.functions import sequential as S
from loomwright.functions import text as T
from loomwright.operators import folds
from loomwright.operators import retrieval as R
from loomwright.operators import windows as W
from loomwright.operators.graph import connected_components
from loomwright.operators.joins import in_range
from loomwright.sources import sinks
from loomwright.sources import transcripts as src

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_gap_session_needs_more_than_the_gap(spark):
    df = spark.createDataFrame([(1, t) for t in (0, 60, 120, 181)], "k int, t long")
    got = W.gap_sessions(df, "t", 60, ["k"], []).groupBy("session").count()
    assert rows(got) == [(0, 3), (1, 1)]


def test_interval_union(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 10, 12)], "k int, a int, b int")
    assert rows(W.interval_union(df, "a", "b", ["k"]).select("a", "b")) == [(0, 9), (10, 12)]
    df = spark.createDataFrame([(1, 0, 1000), (1, 1800, 1900), (2, 0, 1000), (2, 1799, 1900)], "k int, a int, b int")
    assert rows(W.interval_union(df, "a", "b", ["k"], touching=False, slack=800).select("k", "a", "b")) == [(1, 0, 1000), (1, 1800, 1900), (2, 0, 1900)]


def test_overlapping_windows(spark):
    df = spark.createDataFrame([(600,), (601,), (0,)], "e long").select("e", W.overlapping_windows(F.lit(0).cast("long"), F.col("e"), 600, 60).alias("w"))
    got = {r["e"]: [tuple(x) for x in r["w"]] for r in df.collect()}
    assert got == {600: [(0, 600)], 601: [(0, 600), (540, 601)], 0: [(0, 0)]}


def test_as_of_tolerance(spark):
    left = spark.createDataFrame([(1, 220), (1, 221), (1, 50), (2, 7)], "k int, t int")
    right = spark.createDataFrame([(1, 100, "a"), (1, 100, "b")], "k int, at int, v string")
    assert sorted(((r[0], r[1], r["v"]) for r in W.as_of(left, right, ["k"], "t", "at", ["v"], 120).collect()), key=str) == [(1, 220, "b"), (1, 221, None), (1, 50, None), (2, 7, None)]


def test_range_join_on_bin_edges(spark):
    p = spark.createDataFrame([(1, t) for t in (0, 9, 10, 11, 20)], "k int, t int")
    r = spark.createDataFrame([(1, 9, 20)], "k int, lo int, hi int")
    assert sorted(x["t"] for x in in_range(p, r, ["k"], "t", "lo", "hi", 10).collect()) == [9, 10, 11, 20]


def test_bigrams(spark):
    df = spark.createDataFrame([("",), ("x",), ("帧率",), ("a　b",), (None,)], "s string").select("s", T.bigrams("s").alias("t"), T.n_bigrams(F.col("s")).alias("n"))
    got = {r["s"]: r["t"] for r in df.collect()}
    assert got == {"": [], "x": [], "帧率": ["帧率", "帧", "率"], "a　b": ["ab"], None: []}
    assert all(r["n"] == len(r["t"]) for r in df.where("s is not null").collect())


def test_bm25_counts_a_query_term_once(spark):
    docs = spark.createDataFrame([(1, "abcd"), (2, "zz"), (3, "xyxy")], "id int, t string")
    q = spark.createDataFrame([(0, "ab"), (1, "abab")], "q int, s string")
    s = {(r["query"], r["doc"]): r["score"] for r in R.bm25(docs, q, "id", "t", "q", "s").collect()}
    assert s[0, 1] == s[1, 1] and (0, 2) not in s


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 100)], "a long, b long")
    got = dict(rows(connected_components(e)))
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[100] == 100
    assert connected_components(e.limit(0)).count() == 0


@pytest.mark.parametrize("s, v", [("十", 10), ("二十五", 25), ("三百", 300), ("一千零五", 1005), ("两万三千", 23000), ("abc", None), ("", None), ("105", 105), ("十二", 12), ("一百一十", 110)])
def test_numerals(s, v):
    assert S.numeral(s) == v


def test_protected_words_stay():
    assert S.rewrite_numerals("一起看第十二章，三个", ("一起",)) == "一起看第12章，3个"


def test_edit_breakdown_and_ratio(spark):
    assert S.edit_breakdown("abc", "axcd") == (1, 0, 1) and S.edit_breakdown("", "ab") == (0, 0, 2) and S.edit_breakdown("ab", "") == (0, 2, 0)
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(S.ratio("a", "b")).collect()] == [0.25, 0.5, 0.0]


def test_line_merge_limits(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, "a" * 30), (1, 2.2, 3.0, "b" * 30), (1, 3.1, 4.0, "c")], "k int, s double, e double, t string")
    assert [r["t"] for r in folds.merge_lines(df, "k", "s", "e", "t").orderBy("s").collect()] == ["a" * 30 + "b" * 30, "c"]


def test_nearest_match_consumes(spark):
    a = spark.createDataFrame([(1, 1.0, 1), (1, 1.5, 2), (1, 9.0, 3)], "k int, t double, l long")
    b = spark.createDataFrame([(1, 1.4, 10), (1, 3.0, 11)], "k int, t double, r long")
    assert sorted(map(tuple, folds.match_nearest(a, b, "k", "t", "l", "r", 2.0).collect()), key=str) == [(1, 1, 10), (1, 2, 11), (1, 3, None)]


def test_contained_dedupe_and_cover(spark):
    df = spark.createDataFrame([("x", 1, "abc"), ("x", 2, "ab"), ("x", 3, "zabcz"), ("x", 4, "q")], "k string, o int, t string")
    assert [r["o"] for r in folds.contained_dedupe(df, "k", "o", "t").orderBy("o").collect()] == [1, 4]
    c = spark.createDataFrame([(1, 1, ["a"]), (1, 2, ["a", "b"]), (1, 3, ["c"])], "k int, i int, c array<string>")
    assert [r["i"] for r in folds.cover_categories(c, "k", "i", "c", 2).orderBy("place").collect()] == [2, 3]


@pytest.fixture(scope="module")
def cards():
    """Copies, shared items without like texts and the other way round, an order-dependent ratio, nulls."""
    rng = random.Random(3)
    out = [("p", 1, "tide", ["a"]), ("p", 2, "diet", ["b"]), ("q", 3, "diet", ["a"]), ("q", 4, "tide", ["b"]), ("p", 5, None, ["a", "b"]), ("p", 6, None, ["a", "b"]), ("p", 7, None, ["a"]), ("p", 8, "", None), ("p", 9, "", None)]
    for i in range(10, 150):
        n = rng.randint(1, 3)
        out.append((rng.choice("pqrs"), i, "".join(rng.choice("abcdefgh ") for _ in range(n * 3)), [rng.choice("tuvwxyz") + rng.choice("12") for _ in range(n)]))
    return out + [(b, i + 200, s, x) for b, i, s, x in out[9::3]] + [("p", 500, out[20][2], [*out[20][3], "t1", "u1"])]


def card_pairs(cards, ok):
    """Brute force over all pairs of a block: (a, b, ratio, shared) where ok(shared, ratio)."""
    cards = sorted(cards, key=lambda c: c[1])
    for i, (p, a, s, x) in enumerate(cards):
        for q, b, t, y in cards[i + 1 :]:
            if p == q:
                r = difflib.SequenceMatcher(None, s, t).ratio() if s is not None and t is not None else 0.0
                if ok(n := len(set(x or []) & set(y or [])), r):
                    yield a, b, r, n


def card_components(pairs):
    of = {}
    for a, b, *_ in pairs:
        x, y = of.setdefault(a, {a}), of.setdefault(b, {b})
        if x is not y:
            x |= y
            of |= dict.fromkeys(y, x)
    return sorted((k, min(v)) for k, v in of.items())


@pytest.mark.parametrize("shared, least", [(2, 0.5), (3, 0.6)])
def test_similar_links_equal_all_pairs(spark, cards, shared, least):
    df = spark.createDataFrame(cards, "g string, id long, t string, i array<string>")
    for either in (False, True):
        got = rows(connected_components(folds.similar_links(df, "g", "id", "t", "i", shared, least, either=either)))
        assert got == card_components(card_pairs(cards, lambda n, r: (n >= shared or r > least) if either else (n >= shared and r > least)))


def test_nearest_before_equals_all_pairs(spark, cards):
    df = spark.createDataFrame(cards, "g string, id long, t string, i array<string>")
    want = {}
    for a, b, r, n in card_pairs(cards, lambda n, r: n >= 2 and r > 0):
        want[b] = max(want.get(b, ()), (r, n, -a))
    assert rows(folds.nearest_before(df, "g", "id", "t", "i", 2, 0.0)) == sorted((b, -a, r) for b, (r, n, a) in want.items())


def test_card_queries_see_all_parts(spark):
    cards = [(r["p_brand"], r["p_partkey"], f"{r['p_name']} {r['p_type']}", r["p_name"].lower().split(" ") + r["p_type"].split(" ")) for r in spark.read.parquet(f"{SF}/part.parquet").collect()]
    assert rows(plans.QUERIES["gr4_pack_clusters"](spark, SF)) == card_components(card_pairs(cards, lambda n, r: n >= 2 or r > 0.5))
    got = plans.QUERIES["gr2_duplicate_clusters"](spark, SF).select("component")
    assert rows(got) == sorted({(c,) for _, c in card_components(card_pairs(cards, lambda n, r: n >= 2 and r > 0.6))})
    assert plans.QUERIES["sx28_mark_near_duplicates"](spark, SF).count() == len({b for _, b, *_ in card_pairs(cards, lambda n, r: n >= 2 and r > 0)})



def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n')
    assert src.read_jsonl(spark, str(tmp_path / "a.jsonl"), "id long").where("id is not null").count() == 2
    (tmp_path / "n.json").write_text(json.dumps({"title": "t", "body": [{"x": 1}, {"x": 2}]}))
    assert rows(src.read_nested(spark, str(tmp_path / "n.json"), "title string, body array<struct<x:int>>", "body")) == [("t", 0, 1), ("t", 1, 2)]
    (tmp_path / "c.csv").write_text('﻿id,time,text\n1,2024-01-02 03:04:05,"two\nlines"\n2,bad,x\n', encoding="utf-8")
    got = src.read_chat_csv(spark, str(tmp_path / "c.csv"), ["msg_id", "sent_at", "text"]).orderBy("msg_id").collect()
    assert got[0]["text"] == "two\nlines" and got[0]["ts"] == 1704164645 and got[1]["bad_time"]
    (tmp_path / "v.txt").write_text('{"a": "x\ny"} [1]\n"s"')
    assert [r["value"] for r in src.read_json_values(spark, str(tmp_path / "v.txt")).orderBy("pos").collect()] == ['{"a": "x\\ny"}', "[1]", '"s"']
    (tmp_path / "s1.lines").write_text("# head\n[01:02] hi\n[1:00:03] there\n")
    assert rows(src.read_transcripts(spark, str(tmp_path / "s1.lines"))) == [("s1", 62, "hi"), ("s1", 3603, "there")]
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{oops\n')
    assert [(r["file"].split("/")[-1], r["bad_lines"]) for r in src.malformed(spark, str(tmp_path / "bad.jsonl")).collect()] == [("bad.jsonl", 1)]
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id long, t string, batch int")
    sinks.write_batches(df, str(tmp_path / "out"), "batch")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["batch=0", "batch=1"]
    assert spark.read.parquet(sinks.replace_table(df, str(tmp_path / "t"), "1")).count() == 2
    sinks.append_events(df, str(tmp_path / "log"))
    sinks.append_events(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    sinks.write_jsonl(df, str(tmp_path / "j"), ("t",))
    assert "t" not in spark.read.json(str(tmp_path / "j")).columns
    assert sinks.manifest(df, "id", "batch").count() == 2


def test_streaming_sessions_equal_batch(spark, tmp_path):
    from loomwright.streaming.sessions import replay, session_counts

    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartition(1).write.parquet(str(tmp_path / "in"))
    q = session_counts(replay(spark, str(tmp_path / "in"), e.schema), "ts", "user_id", "8 hours", "60 days").writeStream.format("memory").queryName("sessions").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    want = session_counts(e, "ts", "user_id", "8 hours", "60 days")
    assert rows(spark.sql("select * from sessions")) == rows(want)


def value(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    if isinstance(v, dict):
        return tuple(value(x) for x in v.values())
    if hasattr(v, "asDict") or isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, duck, name):
    df, want = plans.QUERIES[name](spark, SF), duck.sql(plans.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert sorted(str([value(r[c]) for c in cols]) for r in df.collect()) == sorted(str([value(r[i]) for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_other_queries_have_rows(spark, name):
    """What they return is compared in test_brute.py and above; here every one has rows."""
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_a_stored_table_leaves_no_shuffle_files(spark):
    from loomwright.session import forget, written

    held = lambda: {str(f) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if "shuffle_" in str(f)}
    before = held()
    stored = written(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert not held() - before and stored.count() == 7
    forget(stored)
