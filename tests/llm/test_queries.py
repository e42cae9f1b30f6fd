"""Every opN_ query, as the driver calls it, against brute force: on the smallest supplied tables with odd rows added
(null ids and texts, repeated rows, one id with several texts, texts without blanks, clashing extra columns)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_llm import brute_components, brute_items, ids_of

from loomwright.llm import common, ngram_join, toxicity
from loomwright.llm.queries import queries

SF = "/root/testdata/sf0.001"
ODD = [(None, None), (None, "a b c"), (900_001, None), (900_002, ""), (900_003, " \n\t"), (900_004, "Ünd ünd " * 40), (900_005, "x" * 40_000), (900_005, "other text of the same id"), (900_005, "other text of the same id"), (900_006, "日本語テキスト" * 200), (900_007, "<|endoftext|> 's don't\r\n")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    for name in ("labels", "conversations", "pages"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], docs.schema)
    clash = {c: spark.sql("select 7").first()[0] for c in ("host", "rank", "shard", "n_bytes", "label", "_k", "k", "part", "row")}
    both = docs.unionByName(odd)
    for c in clash:
        both = both.selectExpr("*", f"7 as {c}")
    both.repartition(3).write.parquet(f"{path}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    items.unionByName(spark.createDataFrame([(None, "ünd ünd ünd"), (77, None), (77, "")], items.schema)).write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(common.tokenizer_path())


def run(spark, folder, n):
    name = next(q for q in queries() if q.startswith(f"op{n}_"))
    return [r.asDict() for r in queries()[name](spark, folder).collect()]


def order(x):
    return str(x)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, folder, docs):
    want = []
    for i, t in docs:
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        want.append((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])))
    got = run(spark, folder, 1)
    assert sorted(((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got), key=order) == sorted(want, key=order)
    same = defaultdict(set)
    for r in got:
        same[r["payload_sha256"]].add((r["media_sha256"], r["media_bytes"], r["feature"]))
    assert all(len(v) == 1 for v in same.values())


def test_op2(spark, folder):
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-7, k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    by = defaultdict(list)
    for c, k, role, text in turns:
        by[c].append((k, role or "", text or ""))
    want = {}
    for c, rows in by.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        want[c] = (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in run(spark, folder, 2)} == want


def test_op3(spark, folder):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    want = []
    for page, url in (tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fit = [(len(h.split(".")), len(p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=None)
        want.append((page, host, path, best and best[3], best[2] if best else "allow"))
    assert sorted(tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in run(spark, folder, 3)) == sorted(want)


def test_op4(spark, folder, docs, tokenizer):
    got = run(spark, folder, 4)
    want = [(i, (ids := [*ids_of(tokenizer, t), 2]) and len(ids), crc(ids)) for i, t in docs]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=order) == sorted(want, key=order)
    by = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by] == [0, *np.cumsum([r["n_tokens"] for r in by])[:-1]]
    known = [r["doc_id"] for r in by if r["doc_id"] is not None]
    assert known == sorted(known) and all(r["doc_id"] is None for r in by[: len(by) - len(known)])


def test_op5(spark, folder, docs, tokenizer):
    got = run(spark, folder, 5)
    pieces, rows = Counter(), Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got)
    whole = [(i, [*ids_of(tokenizer, t), 1]) for i, t in docs]
    cuts = defaultdict(set)
    for i, start, length, _, n in rows:
        cuts[i, n].add((start, length))
    for i, ids in whole:
        for start, length in cuts[i, len(ids)]:
            pieces[i, start, length, crc(ids[start : start + length]), len(ids)] += 1
        assert sum(length for _, length in cuts[i, len(ids)]) == len(ids)
    assert pieces == rows
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048
    held = sum(len(ids) for _, ids in whole)
    assert len(by) * 2048 <= 1.05 * held + 2048


def test_op6(spark, folder, docs, tokenizer):
    want = [(i, len((t or "").encode()), (n := len(ids_of(tokenizer, t))), n > 512) for i, t in docs]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in run(spark, folder, 6)), key=order) == sorted(want, key=order)


def test_op7(spark, folder, docs):
    got = run(spark, folder, 7)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=order) == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=order)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) <= set(range(16)) and max(counts.values()) - min(counts[s] for s in range(16)) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_op8(spark, folder, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    named, all_of = brute_items(docs, [x for x in items if x[0] is not None]), brute_items(docs, items)
    got = Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in run(spark, folder, 8))
    # An item without an id hits words, but is not counted or listed.
    want = Counter((a[0], a[1], a[2], b[3], b[4], a[5]) for a, b in zip(all_of, named))
    assert got == want


def test_op9(spark, folder, docs):
    known = [(i, t) for i, t in docs if i is not None and i != 900_005]
    want = sorted(brute_components(known))
    got = [tuple(r[c] for c in ("doc_id", "n_shingles", "component_id")) for r in run(spark, folder, 9)]
    assert len(got) == len(docs)
    assert sorted(x for x in got if x[0] is not None and x[0] != 900_005) == want
    assert sorted(x for x in got if x[0] == 900_005) == [(900_005, 1, 900_005), (900_005, 2, 900_005), (900_005, 2, 900_005)]
    assert sorted((n, c) for i, n, c in got if i is None) == [(0, None), (1, None)]


def test_op10(spark, folder, docs):
    got = run(spark, folder, 10)
    assert sorted((r["doc_id"] for r in got), key=order) == sorted((i for i, _ in docs), key=order)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_toxicity_holds_in_every_language(spark):
    """Held-out rows of the larger supplied table, by language: the model never sees the language."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit_on(docs, labels)
    rows = docs.join(labels, "doc_id").where(toxicity.held_out(docs["doc_id"])).select("lang", "toxic", "text").collect()
    score = np.array([model.score(r["text"]) for r in rows])
    toxic, lang = np.array([r["toxic"] for r in rows]) == 1, np.array([r["lang"] for r in rows])
    recall, clean = (score[toxic] >= 0.5).mean(), (score[~toxic] < 0.5).mean()
    print("recall", recall, "clean", clean)
    # Some rows that are labelled toxic hold nothing toxic here.
    assert recall >= 0.8 and clean >= 0.97
    for x in ("en", "de", "fr", "es"):
        print(x, "recall", (score[toxic & (lang == x)] >= 0.5).mean(), "clean", (score[~toxic & (lang == x)] < 0.5).mean())
        assert (score[toxic & (lang == x)] >= 0.5).mean() >= 0.6


def test_toxicity_knows_words_in_any_dress(spark):
    """Marks, case and inflections change a word's score by a tenth at most, and so does a second insult beside it."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit_on(docs, labels)
    for word in ("moron", "idiot", "worthless", "trash", "clown"):
        bare = model.score(word)
        assert bare >= 0.9
        for dressed in (word.upper(), f"{word.title()}!", f"({word})", f'"{word}",', f"{word}###", f"«{word}»", f"¿{word}?", f"{word} moron", f"{word}, {word}."):
            assert abs(model.score(dressed) - bare) <= 0.1
        assert len(word) < 5 or abs(model.score(f"{word}s") - bare) <= 0.1
    assert model.score("!!! ... ###") == model.score("") == model.score(None) < 0.5


def test_toxicity_score_is_that_of_plain_code(spark):
    """The fast scorer against one that remembers nothing and compresses each window anew."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit_on(docs, labels)

    def weight(w):
        for part, least in ((w, 0), (w[:-1], toxicity.SURE)) if len(w) >= toxicity.LONGER else ((w, 0),):
            a, b = (int(toxicity.lengths(d, [part])[0]) for d in (model.ordinary, model.toxic))
            x = model.table.get((min(len(part), 63) * 64 + min(a, 63)) * 64 + min(b, 63), 0.0)
            if x > least:
                return x
        return 0.0

    for r in docs.where("doc_id % 997 = 0").collect():
        parts = toxicity.windows(r["text"][:3000])
        found = [x for w in parts if (x := weight(w))]
        top = [1.0, sum(sorted(found)[-3:]), np.log1p(len(found)), len(found) / (len(parts) + 20) * 20]
        assert abs(model.score(r["text"][:3000]) - 1 / (1 + np.exp(-np.clip(np.dot(model.weights, top), -30, 30)))) < 1e-9


def test_toxicity_fits_on_odd_tables(spark):
    d = spark.createDataFrame([(1, "a b"), (1, "c"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score(d, toxicity.fit_on(d, none)).collect()] == [0.0, 0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    assert toxicity.fit_on(d, one).score("x") == 1.0
    assert toxicity.score(d.limit(0), toxicity.fit_on(d.limit(0), one)).count() == 0


def test_empty_tables(spark, folder, tmp_path):
    """Each query returns its columns and no row (op2: only the added conversation)."""
    for name in ("documents", "labels", "conversations", "pages", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for n in range(1, 14):
        assert len(run(spark, str(tmp_path), n)) == (n == 2)
    import corpus_pipeline

    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_keep_one_tells_rows_apart_by_id_and_text(spark):
    long = "one two three four five six seven"
    rows = [(1, "A " + long), (5, "B other words that stand for themselves here"), (5, "A " + long), (None, "A " + long), (None, "lonely words that no other document has"), (None, "lonely words that no other document has"), (8, ""), (8, ""), (9, None)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _k int")
    kept = sorted(((r["doc_id"], r["text"]) for r in ngram_join.keep_one(df).collect()), key=order)
    assert kept == sorted([rows[0], rows[1], rows[4], rows[6], rows[8]], key=order)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n, m = rng.integers(4, 400, 2)
        both = rng.integers(0, 2**63, n + m).astype(np.uint64)
        k = int(rng.integers(0, min(n, m) + 1))
        a, b = np.unique(both[:n]), np.unique(both[n - k : n - k + m])
        assert ngram_join.apart(ngram_join.sketch(a), ngram_join.sketch(b)) <= len(np.setxor1d(a, b))


def test_chains_and_hot_keys_lose_no_link(spark, monkeypatch):
    """Sets that lead from one to another, a passage that most hold, and long lists, in many small chunks."""
    words = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(30)]
    docs = [(i, " ".join([*words[i : i + 60], *(passage if i % 3 else [])])) for i in range(0, 120, 2)]
    docs += [(1000 + i, " ".join([*passage, *words[300 + i % 7 : 312 + i % 7]])) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(brute_components(docs))
    assert len({c for _, _, c in want}) < len(docs)
    for at_once, sets, short in ((4_000_000, 40_000, 5), (300, 6, 2)):
        monkeypatch.setattr(ngram_join, "AT_ONCE", at_once)
        monkeypatch.setattr(ngram_join, "SETS_AT_ONCE", sets)
        monkeypatch.setattr(ngram_join, "SHORT", short)
        assert sorted(map(tuple, ngram_join.components(df).collect())) == want


def test_full_shards_swap(spark):
    """Where linked documents fill every quota, groups are whole all the same."""
    from loomwright.llm import sharding

    df = spark.createDataFrame([(3 * g + k, f"text {g}") for g in range(1000) for k in range(3)], "doc_id long, text string")
    rows = sharding.shard_documents(df, shards=16).collect()
    counts, shards = Counter(r["shard"] for r in rows), defaultdict(set)
    for r in rows:
        shards[r["doc_id"] // 3].add(r["shard"])
    assert max(counts.values()) - min(counts.values()) <= 1 and len(rows) == 3000
    assert sum(len(s) == 1 for s in shards.values()) >= 950


def test_moves_between_full_shards_are_cycles():
    from loomwright.llm.sharding import flows

    assert flows({(0, 1): 5, (1, 0): 3, (1, 2): 4, (2, 0): 9}, [0, 0, 0]) == {(0, 1): 5, (1, 0): 3, (1, 2): 2, (2, 0): 2}
    assert flows({(0, 1): 5}, [0, 2, 0]) == {(0, 1): 2} and flows({(0, 1): 5}, [0, 0, 0]) == {} and flows({}, [1, 1]) == {}
    # Room at the end of a chain lets all of it move.
    assert flows({(0, 1): 2, (1, 2): 2, (2, 3): 2}, [0, 0, 0, 2]) == {(0, 1): 2, (1, 2): 2, (2, 3): 2}


def test_equal_rows_are_ranked_in_many_buckets(spark):
    """A third of the rows is one row: no bucket of the ranking holds them."""
    from loomwright.llm import packing

    df = spark.createDataFrame([(None, "")] * 30_000 + [(i, "a b") for i in range(60_000)], "doc_id long, text string").repartition(4)
    got = packing.pack(df, common.tokenizer_path(), end_id=1)
    per = got.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert got.count() == 90_000 and max(r["sum(length)"] for r in per) <= 2048
    assert len(got.select("sequence_id", "offset").distinct().collect()) == 90_000


def test_lists_of_a_dozen_sets_are_paired(spark):
    """Their sets are judged by pairs, not linked to their neighbours."""
    import numpy as np

    row = (0, np.full(8, 77, np.uint64).tobytes(), np.arange(8, dtype=np.uint32).tobytes(), np.arange(1, 9).tobytes(), np.full(8, 20, np.int32).tobytes())
    stars = (-3, np.array([5], np.int64).tobytes(), b"", np.array([4], np.int64).tobytes(), b"")
    blocks = spark.createDataFrame([row, stars], "bucket int, keys binary, at binary, sets binary, sizes binary")
    got = sorted(map(tuple, ngram_join._links(blocks, 2).collect()))
    assert got == sorted([(a, b, 20, 20, False) for a in range(1, 9) for b in range(a + 1, 9)] + [(5, 4, 0, 0, True)])
