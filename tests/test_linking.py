"""Terms and rules from tables, and folds that are cut at gaps, against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomwright import plans
from loomwright.functions import answers as A
from loomwright.functions import sequential
from loomwright.operators import containment, dictionary, folds, rewriting
from loomwright.plans import dictionary_queries as Q
from loomwright.plans.registry import Tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def texts_of(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "lang").collect()]


# --- terms -------------------------------------------------------------------------------------------

TEXTS = [(1, "abcabcab"), (1, "abcabcab"), (2, None), (3, ""), (None, "日本語 abxab"), (4, "aaaa" * 300), (5, "xyz bc")]
TERMS = [("ab", "AB", 1), ("abc", "AB", 2), ("bc", "BC", 3), ("bca", "BC", 3), ("本語", "NIHON", 4), ("a", "A", 1), (None, "N", 1), ("", "E", 1), ("aaa", "A", 9)]


@pytest.mark.parametrize("block", [4_000_000, 30])
def test_occurrences_without_overlap(spark, monkeypatch, block):
    monkeypatch.setattr(containment, "BLOCK_BYTES", block)
    t = spark.createDataFrame(TEXTS, "id long, body string")
    g = spark.createDataFrame(TERMS, "term string, canonical string, ord int")
    pattern = re.compile("|".join(map(re.escape, sorted({x for x, _, _ in TERMS if x}, key=lambda x: -len(x)))))
    want = sorted(((i, m.start(), m[0]) for i, b in TEXTS for m in pattern.finditer(b or "")), key=str)
    assert rows(dictionary.longest_occurrences(t, ["id"], "body", g, "term")) == want
    assert dictionary.longest_occurrences(t, ["id"], "body", g.limit(0), "term").count() == 0
    assert dictionary.longest_occurrences(t.limit(0), ["id"], "body", g, "term").count() == 0
    gated = dictionary.gated_occurrences(t, ["id"], "body", g.withColumn("short", F.length("term") < 2), "term", "short", ["x"])
    short, long = re.compile("a"), re.compile("|".join(sorted({x for x, _, _ in TERMS if x and len(x) > 1}, key=lambda x: -len(x))))
    want = [(i, x) for i, b in TEXTS for x in long.findall(b or "") + (short.findall(b) if "x" in (b or "") else [])]
    assert rows(gated) == sorted(want, key=str)


def test_choices_among_terms(spark):
    t = spark.createDataFrame(TEXTS, "id long, body string").distinct()
    g = spark.createDataFrame([*TERMS, ("ab", "LATER", 7)], "term string, canonical string, ord int")
    known = {}
    for term, canonical, o in sorted((x for x in [*TERMS, ("ab", "LATER", 7)] if x[0] and len(x[0]) > 1), key=lambda x: x[2]):
        known[term] = (canonical, o)
    assert rows(dictionary.index_terms(g, "term", ["ord"])) == sorted(((x, *y) for x, y in known.items()), key=str)
    held = dictionary.held_terms(t, ["id"], "body", dictionary.index_terms(g, "term", ["ord"]), "term")
    want = {}
    for i, b in {x: None for x in TEXTS}:
        for term in sorted((x for x in known if x in (b or "")), key=lambda x: (-len(x), known[x][1])):
            want[i, known[term][0]] = term  # shorter and later ones overwrite
    assert rows(dictionary.one_mention(held, ["id"], "term", "canonical", "ord")) == sorted(((*k, v) for k, v in want.items()), key=str)
    first = rows(dictionary.first_longest(held, ["id"], "term", "canonical", 1))
    assert all(len(r[2]) == max(len(x) for x in known if x in dict(TEXTS)[r[0]]) for r in first) and len(first) == 4
    kinds = rows(dictionary.typed(spark.createDataFrame([("one", "ONE", 2), ("one", "UNO", 1), ("un", "UNO", 3), ("x", "X", 0)], "term string, canonical string, p int"), "term", "canonical", "p"))
    assert kinds == [("ONE", "ONE", 2), ("UNO", "UNO", 1), ("one", "UNO", 1), ("un", "UNO", 1)]
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "b"), (3, "b"), (3, "c"), (3, "c"), (4, "a")], "id int, n string")
    assert rows(dictionary.most_frequent(pairs, ["id"], "n", 1, F.col("n") != "b")) == [(1, "a", 2, 1), (3, "c", 2, 1), (4, "a", 2, 1)]


# --- rules -------------------------------------------------------------------------------------------


def word(rng):
    return "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))


def rule(rng):
    k, w = rng.random(), word(rng)
    if k < 0.5:
        return w, word(rng)
    if k < 0.6:
        return rf"(?<={word(rng)[0]}){w}(?!{word(rng)})", word(rng)
    if k < 0.7:
        return rf"\b{w}\b", word(rng) + " "
    if k < 0.8:
        return rf"({w}|{word(rng)})", r"\1" + word(rng)[0]
    return (rf"(?i){w.upper()}", w) if k < 0.9 else (rf"[{w}]{{3}}", "")


def test_rules_equal_plain_application_in_order():
    rng = random.Random(3)
    for _ in range(150):
        rules = [rule(rng) for _ in range(30)]
        made = rewriting.Rules(rules)
        for _ in range(8):
            text = want = " ".join(word(rng) for _ in range(12))
            for p, r in rules:
                want = re.sub(p, r, want)
            assert made.apply(text)[0] == want


def test_required_literals():
    for pattern, need in ((r"(?<=x)teh\b", {"teh"}), (r"a(bc|de)f?", {"bc", "de"}), (r"(?i)abc1", {"1"}), (r"x?y+z", {"z"}), (r"(?:ab){2,}", {"ab"}), (r"[ab]c*", None), ("", None), (r"(?!oz)a", {"a"})):
        assert rewriting.required(pattern) == (need and frozenset(need))


def test_most_rules_are_not_tried():
    """A thousand rules, and a text that three of them change: time goes with matches."""
    rules = [(rf"\bword{k}x\b", f"word{k + 1}x" if k in (7, 8) else "done") for k in range(1000)]
    text, tried = rewriting.Rules(rules).apply("a text of other words and word7x " * 5)
    assert text.count("done") == 5 and tried <= 3


def in_order(rules, text, file):
    blocks = sorted({(b, p) for b, p, *_ in rules if b is not None})
    own = next((b for b, p in blocks if file.startswith(p)), None)
    for b, _, _, pattern, new in sorted(rules, key=lambda r: (r[0] is not None, r[2])):
        if b is None or b == own:
            text = re.sub(pattern, new, text)
    return text


@pytest.fixture(scope="module")
def rules(spark):
    return [tuple(r) for r in Q.rules_of(Tables(spark, SF)).select("block", "prefix", "ord", "pattern", "replacement").collect()]


def test_rule_queries(spark, rules):
    docs = texts_of(spark)
    assert len({b for b, *_ in rules}) == 25 and sum("(?<=" in r[3] for r in rules) >= 60
    run = lambda name: [tuple(r) for r in plans.QUERIES[name](spark, SF).collect()]
    want = {i: in_order(rules, t, f"{s}/{g}/{i}") for i, t, s, g in docs}
    assert dict(run("tx1_ordered_rules")) == want and sum(want[i] != t for i, t, *_ in docs) > 50
    assert dict(run("ev7_rewritten_evidence")) == {i: [in_order(rules, x, f"{s}/{g}/{i}") for x in t.split("\n")] for i, t, s, g in docs}
    merged = []
    for i, t, *_ in docs:
        cue, file = None, f"src{i % 30}"
        for n, line in enumerate(t.split("\n"), 1):
            a, b = n * 2.0, n * 2.0 + len(line) / 20
            if line and (line := in_order(rules, line, file)):
                if cue and a - cue[2] <= 1.2 + 1e-9 and len(cue[3]) + len(line) <= 60:
                    cue[2], cue[3] = max(cue[2], b), cue[3] + line
                else:
                    cue = [i, a, b, line]
                    merged.append(cue)
    assert rows(plans.QUERIES["tx1_rewrite_merge_rewrite"](spark, SF)) == sorted(((i, a, b, in_order(rules, x, f"src{i % 30}")) for i, a, b, x in merged), key=str)


def test_rule_tables_are_bounded_and_nulls_defined(spark, monkeypatch):
    r = spark.createDataFrame([(None, None, 1, "a", None), (None, None, 0, None, "x"), (2, "f1", 1, "b", "B"), (1, "f", 1, "c", "C")], "block int, prefix string, ord int, pattern string, replacement string")
    df = spark.createDataFrame([("abc", "f1"), ("abc", None), (None, "f"), ("", "f")], "t string, f string")
    got = df.select(rewriting.rewriter(r)(F.col("t"), F.col("f")).alias("x")).collect()
    assert [x["x"] for x in got] == ["bC", "bc", None, ""]
    monkeypatch.setattr(rewriting, "MOST_RULES", 2)
    with pytest.raises(ValueError, match="rules"):
        rewriting.rule_table(r)


# --- folds -------------------------------------------------------------------------------------------


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_key_is_merged_in_many_tasks(spark, many_ranges):
    """One key holds most lines; lines may lie within longer ones before."""
    rng = random.Random(5)
    data, at = [], 0.0
    for i in range(3000):
        at += rng.choice([0.1, 0.5, 0.5, 1.0, 4.0])
        data.append((1 if i % 10 else rng.choice([2, None]), round(at, 1), round(at + rng.choice([0.2, 1.0, 6.0]), 1), rng.choice(["ab", "c" * 20, "", None, "d" * 61])))
    data += [(1, None, 3.0, "no time"), (1, 5.0, None, "no end")]
    df = spark.createDataFrame(data, "k int, a double, b double, t string")
    want = [(1, None, 3.0, "no time"), (1, 5.0, None, "no end")]
    for key in (1, 2, None):
        cue = None
        for k, a, b, t in sorted(((k, a, b, t or "") for k, a, b, t in data if k == key and a is not None and b is not None), key=lambda r: r[1:]):
            if cue and a - cue[2] <= 1.2 + 1e-9 and len(cue[3]) + len(t) <= 60:
                cue[2], cue[3] = max(cue[2], b), cue[3] + t
            else:
                cue = [k, a, b, t]
                want.append(cue)
    assert rows(folds.merge_lines(df, "k", "a", "b", "t")) == sorted(map(tuple, want), key=str)
    cut = folds.segments(df.where("a is not null and b is not null"), ("k",), ["a", "b", "t"], F.col("b"), lambda until: F.col("a") - until > 1.2)
    assert cut.where("k = 1").select("_segment").distinct().count() > 100
    assert folds.merge_lines(df.limit(0), "k", "a", "b", "t").count() == 0


def test_one_key_is_matched_in_many_tasks(spark, many_ranges):
    rng = random.Random(6)
    times = [rng.randint(0, 4000) for _ in range(1500)]
    left = [(7, t, i) for i, t in enumerate(times[:700])] + [(None, 5, 9000), (7, None, 9001)]
    right = [(7, t, 10_000 + i) for i, t in enumerate(times[700:])] + [(None, 6, 9100), (8, 1, 9101)]
    got = folds.match_nearest(spark.createDataFrame(left, "k int, t int, i long"), spark.createDataFrame(right, "k int, t int, j long"), "k", "t", "i", "j", 2)
    free, want = sorted((t, j) for k, t, j in right if k == 7), [(None, 9000, 9100), (7, 9001, None)]
    for t, i in sorted((t, i) for k, t, i in left if k == 7 and t is not None):
        near = min(free, key=lambda x: (abs(x[0] - t), x), default=None)
        hit = near and abs(near[0] - t) <= 2
        want.append((7, i, near[1] if hit else None))
        if hit:
            free.remove(near)
    assert rows(got) == sorted(want, key=str) and sum(m is None for *_, m in want) > 50


def test_one_key_has_fragments_in_many_tasks(spark, many_ranges):
    rng = random.Random(8)
    data, at = [], 0
    for i in range(2500):
        at += rng.choice([1, 5, 5, 50])
        data.append((1 if i % 9 else None, i, at, rng.random() < 0.2))
    got = folds.anchor_fragments(spark.createDataFrame(data, "k int, o long, t long, anchor boolean"), "k", "o", "t", "anchor", slack=3, gap=20, most=5)
    want = []
    for key in (1, None):
        x = [r for r in data if r[0] == key]
        parts, i = [], 0
        while i < len(x):
            if x[i][3]:
                a = i
                while a > 0 and i - a < 3 and x[a][2] - x[a - 1][2] <= 20 and (not parts or a - 1 > parts[-1][1]):
                    a -= 1
                b, quiet = i, 0
                while b + 1 < len(x) and quiet < 3 and x[b + 1][2] - x[b][2] <= 20:
                    b += 1
                    quiet = 0 if x[b][3] else quiet + 1
                parts.append((a, b))
                i = b
            i += 1
        for n, (a, b) in enumerate(parts):
            hits = [j for j in range(a, b + 1) if x[j][3]]
            lo = max(a, min(hits[len(hits) // 2] - 2, b - 4))
            want += [(key, x[j][1], n) for j in range(lo, min(b, lo + 4) + 1)]
    assert rows(got) == sorted(want, key=str) and len({n for *_, n in want}) > 100


def test_claimed_quotes_have_all_grades(spark):
    grades = Counter(r["grade"] for r in plans.QUERIES["ev3_claimed_trace"](spark, "/root/testdata/sf0.01").collect())
    assert set(grades) == {"verbatim", "joined", "normalised", "paraphrase", "missing"} and min(grades.values()) > 5


def test_overlap_near_a_time(spark):
    from loomwright.operators.joins import overlap_near

    lines = [("a", 10, ["x", "y"]), ("a", 11, ["z"]), ("a", 130, ["x", "y", "z"]), ("b", 10, ["x"]), ("a", None, ["x", "y", "z"]), ("a", 9, None), (None, 10, ["x"])]
    quotes = [(1, "a", 10, ["x", "y", "z", "x"]), (2, "a", 251, ["x"]), (3, "b", 130, ["x", None]), (4, "a", 10, []), (5, "a", 10, None), (6, "a", None, ["x"]), (7, None, 10, ["x"]), (8, "a", -110, ["x", "q"])]
    got = overlap_near(spark.createDataFrame(quotes, "i int, s string, t long, u array<string>"), spark.createDataFrame(lines, "s string, t long, u array<string>"), "i", "s", "t", "u", 120)
    assert rows(got) == [(1, 1.0), (3, 1.0), (8, 0.5)]


@pytest.mark.parametrize(("patterns", "scanned"), [(2_000_000, 8_000_000), (60, 150)])
def test_contained_texts_are_decided_in_rounds(spark, monkeypatch, patterns, scanned):
    """Keys with chains of texts that wait for one another, in one piece and in many."""
    monkeypatch.setattr(folds, "PATTERNS", patterns)
    monkeypatch.setattr(folds, "SCANNED", scanned)
    rng = random.Random(9)
    data = [(rng.choice(["x", "y", None]), rng.randint(0, 60), "".join(rng.choice("ab") for _ in range(rng.randint(1, 9)))) for _ in range(250)]
    data += [("n", 20 - k, "p" * (k + 1)) for k in range(20)] + [("e", 5, ""), ("e", 7, "q"), ("f", 1, "q"), ("f", 2, None), ("f", 3, "qq"), ("f", 4, "r"), ("one", 1, "z"), ("one", 0, "z"), ("two", 1, None)]
    want = []
    for key in {k for k, _, _ in data}:
        kept = []
        for o, t in sorted((o, t or "") for k, o, t in data if k == key):
            if not any(t in x or x in t for _, x in kept):
                kept.append((o, t))
        want += [(key, o, t) for o, t in kept]
    df = spark.createDataFrame(data, "k string, o int, t string")
    assert rows(folds.contained_dedupe(df, "k", "o", "t")) == sorted(want, key=str)
    assert folds.contained_dedupe(df.limit(0), "k", "o", "t").count() == 0


def test_dictionary_queries_have_many_terms(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    assert Q.terms_of(t).count() > 10_000
    by = defaultdict(Counter)
    for i, m, n in plans.QUERIES["en6_alternation"](spark, SF).collect():
        by[i][m] = n
    safe = [r["term"] for r in Q.terms_of(Tables(spark, SF)).collect()]
    long, short = (re.compile("|".join(sorted((x for x in safe if (len(x) > 6) == k), key=lambda x: -len(x)))) for k in (True, False))
    for i, text, *_ in texts_of(spark):
        low = text.lower()
        want = Counter(long.findall(low)) + (Counter(short.findall(low)) if "license" in low or "password" in low else Counter())
        assert by[i] == want


def test_stored_index_equals_scoring_all(spark, monkeypatch):
    """Small blocks, appended and deleted documents, one query and many; the floor leaves blocks unread."""
    from loomwright.operators import index
    from loomwright.operators import retrieval as R
    from loomwright.operators.windows import top_per_group

    monkeypatch.setattr(index, "BLOCK", 20)
    monkeypatch.setattr(index, "FIRST", 2)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(9000, None), (9001, ""), (9002, "the"), (9003, "帧率 the"), (None, "the theory of the thing")], "doc_id long, text string")
    made = index.Index.build(docs, "doc_id", "text").append(odd, "doc_id", "text")
    queries = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("q"), "text").limit(12).unionByName(spark.createDataFrame([(-1, ""), (-2, None), (-3, "帧率")], "q long, text string"))

    def want(table, k):
        s = R.bm25(table, queries, "doc_id", "text", "q", "text").withColumn("score", F.round("score", 4))
        return rows(top_per_group(s, ["query"], [F.desc("score"), "doc"], k).select("query", "doc", "score"))

    found = lambda x, k: rows(x.search(queries, "q", "text", k).select("query", "doc", "score"))
    assert found(made, 3) == want(docs.unionByName(odd), 3)
    made = made.delete(docs.where("doc_id % 3 = 0"), "doc_id").delete(odd.where("doc_id = 9002"), "doc_id")
    left = docs.where("doc_id % 3 <> 0").unionByName(odd.where("doc_id is null or doc_id <> 9002"))
    assert found(index.Index(spark, made.folder), 5) == want(left, 5)
    assert found(made.append(docs.where("doc_id = 3"), "doc_id", "text"), 1) == want(left.unionByName(docs.where("doc_id = 3")), 1)
    assert index.Index.build(docs.limit(0), "doc_id", "text").search(queries, "q", "text", 3).count() == 0
    assert index.Index.build(odd.where("doc_id < 9002"), "doc_id", "text").search(queries, "q", "text", 3).count() == 0


def test_only_what_a_rule_has_changed_is_read_again(monkeypatch):
    """Rules that all change a long text; and the result is that of one ``re.sub`` after the other."""
    import random
    import re

    from loomwright.operators.rewriting import Rules

    read = []
    able = Rules._able
    monkeypatch.setattr(Rules, "_able", lambda self, text, after: read.append(len(text)) or able(self, text, after))
    rules = [(rf"\bword{i:02}\b", f"other{i:02}") for i in range(50)]
    text = "filler " * 1000 + " ".join(f"word{i:02}" for i in range(50))
    assert Rules(rules).apply(text)[0] == text.replace("word", "other") and sum(read) < 2 * len(text)
    rng = random.Random(1)
    patterns = ["a", "(?<=b)a", "^ab", "b$", "(?=ab)a", "a*b", "(a|b)c", "(?i)ab", r"\bab", "x*", "", "(?m)^a", "b(?!a)", "(?<!a)b+", "(a)?b"]
    for _ in range(2000):
        some = [(rng.choice(patterns), rng.choice(["", "b", "ab", "c", r"\g<0>a"])) for _ in range(rng.randint(1, 6))]
        text = want = "".join(rng.choice("abcAB \n") for _ in range(rng.randint(0, 14)))
        for p, r in some:
            want = re.sub(p, r, want)
        assert Rules(some).apply(text)[0] == want


def test_many_terms_fill_no_worker(spark, monkeypatch):
    """Terms without separators are found by runs, whatever the blocks, as an alternation finds them; others, and long runs, by blocks."""
    import re

    monkeypatch.setattr(containment, "BLOCK_BYTES", 40)
    blocks = []
    monkeypatch.setattr(dictionary, "quote_blocks", lambda d: blocks.append(1) or containment.quote_blocks(d))
    texts = [(1, "abcabcab, xabc-äbc"), (2, None), (3, ""), (4, "bcabc abca"), (4, "bcabc abca"), (5, "ab\U0001f600bc c.a")]
    t = spark.createDataFrame(texts, "id long, body string")
    for terms, by_blocks in ((["ab", "abc", "bca", "ca", "äb", "c", "abcabc"], 0), (["ab", "c.a", "abc", "c a", "bc"], 1)):
        found = re.compile("|".join(map(re.escape, sorted(terms, key=len, reverse=True))))
        want = sorted((i, m.start(), m.group()) for i, s in texts for m in found.finditer(s or ""))
        g = spark.createDataFrame([(x,) for x in terms], "term string")
        assert sorted(map(tuple, dictionary.longest_occurrences(t, ["id"], "body", g, "term").collect())) == want
        assert len(blocks) == by_blocks
    monkeypatch.setattr(dictionary, "LONG_RUN", 5)
    g = spark.createDataFrame([("ab",), ("abc",), ("bca",)], "term string")
    want = sorted((i, m.start(), m.group()) for i, s in texts for m in re.finditer("abc|bca|ab", s or ""))
    assert sorted(map(tuple, dictionary.longest_occurrences(t, ["id"], "body", g, "term").collect())) == want and len(blocks) == 2


def test_stored_index_search_ships_only_the_best_of_each_block(spark, monkeypatch):
    """Many queries don't multiply postings: what leaves the blocks is bounded by blocks, queries and ``k``. A few queries have a floor.
    Queries without room in one portion are searched in several."""
    from loomwright.operators import index
    from loomwright.operators import retrieval as R
    from loomwright.operators.windows import top_per_group

    monkeypatch.setattr(index, "BLOCK", 50)
    monkeypatch.setattr(index, "FIRST", 1)
    seen = []
    monkeypatch.setattr(index, "top_per_group", lambda df, *a: seen.append(df.count()) or top_per_group(df, *a))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    queries = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("q"), "text").limit(12)
    made = index.Index.build(docs, "doc_id", "text").delete(docs.where("doc_id % 4 = 1"), "doc_id")
    left = docs.where("doc_id % 4 <> 1")
    for asked, cells in ((queries, 4_000_000), (queries, 2_000), (queries.limit(2).unionByName(spark.createDataFrame([(None, "the text")], queries.schema)), 4_000_000)):
        monkeypatch.setattr(index, "ASKED", cells)
        seen.clear()
        s = R.bm25(left, asked, "doc_id", "text", "q", "text").withColumn("score", F.round("score", 4))
        want = rows(top_per_group(s, ["query"], [F.desc("score"), "doc"], 3).select("query", "doc", "score"))
        assert rows(made.search(asked, "q", "text", 3).select("query", "doc", "score")) == want
        blocks = made._documents().count()
        assert max(seen) <= blocks * asked.count() * (3 + 1)


def test_held_terms_need_no_pass_for_each_block_of_terms(spark, monkeypatch):
    """Terms without separators are found by runs, each text's and each term's rows apart; others, and texts of long runs, by blocks."""
    blocks = []
    by_quotes = dictionary.held_quotes
    monkeypatch.setattr(dictionary, "held_quotes", lambda *a: blocks.append(1) or by_quotes(*a))
    texts = [(1, "abcabcab, xabc-äbc"), (2, None), (3, ""), (4, "bcabc abca"), (4, "bcabc abca"), (None, "ab\U0001f600bc c.a"), (6, "abcab " * 3 + "z" * 30)]
    t = spark.createDataFrame(texts, "id long, body string")
    plain = [("ab", 1), ("ab", 1), ("abc", 2), ("bca", 3), ("äb", 4), ("c", 5), ("\U0001f600b", 6), ("", 7), (None, 8)]
    for terms, long, by_blocks in ((plain, 10_000, 0), ([*plain, ("c.a", 9)], 10_000, 1), (plain, 20, 1)):
        monkeypatch.setattr(dictionary, "LONG_RUN", long)
        blocks.clear()
        g = spark.createDataFrame(terms, "term string, ord int")
        want = sorted(((i, x, o) for i, s in texts for x, o in terms if x and x in (s or "")), key=str)
        assert rows(dictionary.held_terms(t, ["id"], "body", g, "term").select("id", "term", "ord")) == want
        assert len(blocks) == by_blocks
        assert set(rows(dictionary.held_terms(t, ["id"], "body", g, "term", repeated=True).select("id", "term", "ord"))) == set(want)
    assert dictionary.held_terms(t, ["id"], "body", g.limit(0), "term").count() == 0


def test_batch_scores_that_cannot_be_among_the_best_stay_in_their_task(spark, monkeypatch):
    from loomwright.operators import retrieval as R
    from loomwright.operators.windows import top_per_group

    monkeypatch.setattr(R, "CELLS", 20_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.selectExpr("doc_id + 100000 AS doc_id", "text"))
    queries = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("q"), "text").limit(12)
    top = lambda s: rows(top_per_group(s.withColumn("score", F.round("score", 4)), ["query"], [F.desc("score"), "doc"], 3))
    every, few = (R.bm25(docs, queries, "doc_id", "text", "q", "text", best=k).cache() for k in (None, 3))
    assert top(every) == top(few) and few.count() < every.count() / 2


def test_a_suggestion_is_read_once(spark):
    """clauses were spelled out, and so searched, at each of their uses."""
    df = spark.createDataFrame([("claim 改为「甲 7」，scope 写作「乙」", "丙；丁", "戊"), (None, "x", None), ("claim 末尾补「7.5」", None, "7.5"), ("words without a clause", "x", None)], "s string, claim string, subject string")
    out = df.select(A.suggested(F.col("s"), {"claim": F.col("claim"), "subject": F.col("subject")}).alias("f"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 2
    assert [(r["claim"], r["scope"], r["mode"], r["new_numbers"]) for r in out.select("f.*").collect()] == [
        ("甲 7", "乙", "replace", ["7"]), (None, None, "none", []), ("7.5", None, "append", []), ("words without a clause", None, "whole", []),
    ]


def test_heavy_rows_are_spread(spark, monkeypatch):
    from loomwright import session

    df = spark.range(100, numPartitions=1)
    assert session.spread(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(session, "ROWS", 30)
    assert session.spread(df).rdd.getNumPartitions() == 4 and session.spread(df).count() == 100 and session.spread(df.limit(0)).count() == 0


@pytest.mark.parametrize("cells", [40, 400, 1_000_000])
def test_edits_of_many_pairs_at_once(monkeypatch, cells):
    """pairs were taken one by one; all of a batch go in step, with the same paths."""
    monkeypatch.setattr(sequential, "CELLS", cells)
    rng = random.Random(9)
    some = lambda: "".join(rng.choice("ab\U0001f600\ud800") for _ in range(rng.choice([0, 1, 3, 9, 12])))
    pairs = [(some(), some()) for _ in range(500)]
    found = sequential.edit_breakdowns(*map(list, zip(*pairs)))
    assert [tuple(r) for r in found.tolist()] == [sequential.edit_breakdown(a, b) for a, b in pairs]
    assert sequential.edit_breakdowns([], []).shape == (0, 3)


@pytest.mark.parametrize("patterns", [2_000_000, 40])
def test_contained_texts_meet_in_one_task(spark, monkeypatch, patterns):
    """pieces were numbered as long on one side and as int on the other, which are dealt to different tasks."""
    monkeypatch.setattr(folds, "PATTERNS", patterns)
    data = [(f"k{k}", o, t) for k in range(40) for o, t in ((1, f"abc{k}defghi"), (2, f"{k}defghi"), (3, f"zabc{k}defghiz"), (4, "other words"))]
    df = spark.createDataFrame([*data, ("k1", 4, "other words"), ("k2", 9, "other words")], "k string, o int, t string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(folds.contained_dedupe(df, "k", "o", "t").select("k", "o")) == sorted((f"k{k}", o) for k in range(40) for o in (1, 4))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("name", ["jn6_status_max", "lm4_answer_ids", "win6_interval_union", "win7_segment_merge", "jn8_theta_pairs"])
def test_tasks_follow_the_rows(spark, monkeypatch, name):
    """F16, F18, F20, F21, F24: tasks were merged by size of their compressed files, so their memory grew with the table."""
    from loomwright import session

    monkeypatch.setattr(session, "TASK_ROWS", 500)
    plan = plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\([^)]*, 1[0-9]\), REPARTITION_BY_NUM", plan), plan


def test_a_step_of_nearest_vectors_is_small():
    """a step's products were 80 MB, several at once, in each worker of an executor."""
    from loomwright.operators import nearest

    assert nearest.BLOCK * nearest.STEP * 8 <= 20_000_000


def test_segments_of_lines_hold_no_texts(spark, monkeypatch):
    """texts went along through each step that finds the segments."""
    seen = []
    real = folds.segments
    monkeypatch.setattr(folds, "segments", lambda df, *rest: seen.extend(df.dtypes) or real(df, *rest))
    df = spark.createDataFrame([(None, 0.0, 1.0, "a"), (None, 0.0, 1.0, "b"), ("k", 5.0, 3.0, "d"), ("k", 5.0, 3.0, "c"), ("k", 9.0, 9.5, None)], "k string, a double, b double, t string")
    assert sorted(r["t"] for r in folds.merge_lines(df, "k", "a", "b", "t").collect()) == ["", "ab", "c", "d"]
    assert [kind for c, kind in seen if c != "_k"] == ["double", "double"]


def _shuffled(spark):
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    return sc.statusStore().executorSummary("driver").totalShuffleWrite()


def _nested_texts(rng, n):
    """Texts of one key that hold one another at their beginning, end and inside, with a common first line."""
    words = ["".join(rng.choice("abcdefgé帧") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    head = "one line that all the texts of this key have in common, of some length\n"
    texts = [head + " ".join(rng.choice(words) for _ in range(rng.randint(1, 200))) for _ in range(n)]
    for _ in range(n):
        t = rng.choice(texts)
        a, b = sorted((rng.randint(0, len(t)), rng.randint(0, len(t))))
        texts.append(rng.choice([t[:b], t[a:], t[a:b], t + " more", rng.choice(texts) + t[a:], "a" * rng.randint(60, 90)]))
    return texts


@pytest.mark.parametrize("window", [1, 5, 48])
def test_long_contained_texts_are_found_by_anchors(spark, monkeypatch, window):
    monkeypatch.setattr(folds, "PATTERNS", 4_000)
    monkeypatch.setattr(folds, "SCANNED", 20_000)
    monkeypatch.setattr(folds, "WINDOW", window)
    rng = random.Random(window)
    data = [(k, rng.randint(0, 90), t) for k in ("x", None) for t in _nested_texts(rng, 60)] + [("y", k, t) for k, t in enumerate(["b" * 3000, "", "b" * 2000])] + [("z", 2 - k, t) for k, t in enumerate(["b" * 3000, "", "c" * 2000])]
    want = []
    for key in {k for k, _, _ in data}:
        kept = []
        for o, t in sorted((o, t) for k, o, t in data if k == key):
            if not any(t in x or x in t for _, x in kept):
                kept.append((o, t))
        want += [(key, o, t) for o, t in kept]
    assert rows(folds.contained_dedupe(spark.createDataFrame(data, "k string, o int, t string"), "k", "o", "t")) == sorted(want, key=str)


def test_anchors_are_those_of_any_text_around():
    rng = random.Random(4)
    for _ in range(50):
        t = "".join(rng.choice("ab帧") for _ in range(rng.randint(0, 200)))
        a, b = rng.randint(0, 30), rng.randint(0, 30)
        around = "".join(rng.choice("ab") for _ in range(a)) + t + "".join(rng.choice("ab") for _ in range(b))
        piece, at, h = (x.tolist() for x in folds._anchors(["c" * 40, t, around], 16, 8))
        inner, outer = ({(p - off, x) for i, p, x in zip(piece, at, h) if i == k} for k, off in ((1, 0), (2, a)))
        assert inner <= outer
        assert bool(inner) == (len(t) >= 23)
    assert [len(x) for x in folds._anchors(["", "short"], 16, 8)] == [0, 0, 0]


def test_texts_of_a_large_key_are_not_dealt_to_all_its_pieces(spark, monkeypatch):
    """each piece of a key's texts met every other piece, so the bytes shuffled grew as the square of the key."""
    monkeypatch.setattr(folds, "PATTERNS", 10_000)
    monkeypatch.setattr(folds, "SCANNED", 40_000)
    rng = random.Random(8)
    data = [("k", n, "".join(rng.choice("abcdefghijklmnop") for _ in range(1_000))) for n in range(600)]
    df = spark.createDataFrame(data, "k string, o int, t string")
    before = _shuffled(spark)
    assert folds.contained_dedupe(df, "k", "o", "t").count() == 600
    assert 400_000 < _shuffled(spark) - before < 6_000_000
