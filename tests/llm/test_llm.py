"""Operators for training data against brute force, on small hand-made and supplied rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomwright.llm import bpe, common, jpeg

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 997}x" for i in range(30_000))
TEXTS = [None, "", " ", "\n\n", "one", "a b c", "It's we'll 'tis don't", "x" * 5000, "日本語テキスト　です", "tie tie tie tie tie tie", "<|endoftext|> a  <|endoftext|>", LONG, "same text of five words here", "same text of five words here", "A  \t\n b", "\\### </turn> <turn user>"]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empties, ties, a long text, a repeated row, a clashing extra column."""
    rows = [(i, t, "en", i) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, label long")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(common.tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("by", ["library", "merge"])
def test_array_tokenizer_equals_the_library(tokenizer, by):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice(" '  \n\tsdmtrevlaAZ09.,-é日<|>　\r") for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["".join(rng.choice(["<|endoftext|>", " ", "'s", "x", "\n", "'ll"]) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    ids, n = bpe.BatchTokenizer(common.tokenizer_path(), by).ids(texts)
    want = [ids_of(tokenizer, t) for t in texts]
    assert n.tolist() == list(map(len, want))
    assert ids.tolist() == [i for w in want for i in w]


def test_long_texts_are_cut_without_effect(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "CHUNK", 1000)
    assert bpe.BatchTokenizer(common.tokenizer_path()).counts([LONG[:20000], "a"]).tolist() == [len(ids_of(tokenizer, LONG[:20000])), 1]


def test_long_texts_without_blanks(tokenizer):
    rng = random.Random(8)
    letters, han = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)), "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(60_000))
    texts = [letters, han, "a" * 100_000, "=" * 30_000 + letters[:100]]
    assert bpe.BatchTokenizer(common.tokenizer_path(), "merge").counts(texts).tolist() == [len(ids_of(tokenizer, t)) for t in texts]


def test_token_counts(docs, tokenizer):
    from loomwright.llm.token_count import count_tokens

    rows = count_tokens(docs, common.tokenizer_path(), limit=3).collect()
    want = sorted((i, len((t or "").encode()), len(ids_of(tokenizer, t)), len(ids_of(tokenizer, t)) > 3) for i, t in [*enumerate(TEXTS), (3, TEXTS[3])])
    assert sorted(map(tuple, rows)) == want
    assert count_tokens(docs.limit(0), common.tokenizer_path()).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31])
def test_bit_packing_round_trip(bits):
    from loomwright.llm.token_file import pack, unpack

    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 4097):
        ids = rng.integers(0, 1 << bits, n)
        data = pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert unpack(data, bits, n).tolist() == ids.tolist()


def test_token_files(spark, docs, tokenizer):
    from loomwright.llm.token_file import Reader, read_tokens, write_tokens

    manifest = write_tokens(docs, common.tokenizer_path(), end_id=2)
    got = sorted(map(tuple, read_tokens(manifest, at_once=1000).collect()), key=lambda r: (r[1], r[2]))
    at, want = 0, []
    for i, t in sorted([*enumerate(TEXTS), (3, TEXTS[3])], key=lambda x: x[0]):
        ids = [*ids_of(tokenizer, t), 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    r = Reader(manifest.where("part = 0").first()["uri"])
    assert r.bits == 16 and r.document(1).tolist() == r.ids(int(r.starts[1]), int(r.ends[1])).tolist()
    assert read_tokens(write_tokens(docs.limit(0), common.tokenizer_path())).count() == 0


def test_packing(docs, tokenizer):
    from loomwright.llm.packing import pack

    rows = [r.asDict() for r in pack(docs, common.tokenizer_path(), end_id=1).collect()]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(TEXTS):
        ids, mine = np.array([*ids_of(tokenizer, t), 1], "<u4"), sorted(pieces[i], key=lambda r: r["start"])
        mine = mine[::2] if i == 3 else mine  # the repeated row
        assert sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            assert r["doc_tokens"] == len(ids) and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack(docs.limit(0), common.tokenizer_path()).count() == 0


def test_patterns_hold_every_length():
    from loomwright.llm.packing import histogram_patterns

    rng = random.Random(1)
    h = Counter(rng.randint(1, 2048) for _ in range(20000))
    patterns = histogram_patterns(h)
    used = Counter()
    for p, n in patterns:
        assert sum(p) <= 2048
        for x in p:
            used[x] += n
    assert used == h
    assert sum(n for _, n in patterns) * 2048 < 1.01 * sum(k * v for k, v in h.items())


def test_jpeg_media(docs):
    from loomwright.llm.media import describe, payload_of, store

    media = store(docs)
    rows = {r["doc_id"]: r for r in describe(media).collect()}
    for i, t in enumerate(TEXTS):
        p = payload_of(t)
        assert len(p) % 192 == 0 and len(p) > 0
        assert rows[i]["payload_sha256"] == hashlib.sha256(p).hexdigest() and rows[i]["tail_crc32"] == zlib.crc32(p[-16:])
        assert rows[i]["n_bytes"] == len((t or "").encode()) and rows[i]["payload_bytes"] == len(p)
    assert rows[12]["feature"] == rows[13]["feature"] and rows[12]["media_sha256"] == rows[13]["media_sha256"]
    assert describe(store(docs.limit(0))).count() == 0


def scalar_decode(data):
    """A plain decoder of baseline JPEG: DC of the first component, by MCU order."""
    image, _ = jpeg.parse(data)
    raw = data[image.begin : image.end]
    tables = {k: {(n, c): s for s, c, n in jpeg.canonical(*v)} for k, v in image.tables.items()}
    out = []
    segments = re.split(rb"\xff[\xd0-\xd7]", raw)
    across, down = image.grid()
    left = across * down
    for seg in segments:
        bits = "".join(f"{b:08b}" for b in seg.replace(b"\xff\x00", b"\xff"))
        at, pred = 0, [0] * len(image.scan)

        def symbol(table):
            nonlocal at
            for n in range(1, 17):
                s = table.get((n, int(bits[at : at + n], 2)))
                if s is not None:
                    at += n
                    return s
            raise AssertionError

        for _ in range(min(left, image.restart or left)):
            for k in image.blocks():
                n = symbol(tables[image.scan[k][1]])
                v = int(bits[at : at + n], 2) if n else 0
                at += n
                pred[k] += v if not n or v >> (n - 1) else v - (1 << n) + 1
                if k == 0:
                    out.append(pred[0])
                place = 0
                while place < 63:
                    s = symbol(tables[16 | image.scan[k][2]])
                    if s == 0:
                        break
                    place += (s >> 4) + 1
                    at += s & 15
        left -= image.restart or left
    return out


def colour_jpeg(width, height, restart, seed):
    """A random 4:2:0 image with AC coefficients, written bit by bit."""
    rng = random.Random(seed)
    ac_bits, ac_values = (0, 2, 2, 1, *[0] * 12), (0x00, 0x01, 0x11, 0x32, 0xF0)
    dc = {s: (c, n) for s, c, n in jpeg.canonical(jpeg.DC_BITS, jpeg.DC_VALUES)}
    ac = {s: (c, n) for s, c, n in jpeg.canonical(ac_bits, ac_values)}
    seg = lambda m, b: bytes([255, m]) + (len(b) + 2).to_bytes(2, "big") + b
    head = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, bytes([0, 16, *[3] * 63])) + seg(0xC0, bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    head += seg(0xC4, bytes([0, *jpeg.DC_BITS, *jpeg.DC_VALUES])) + seg(0xC4, bytes([16, *ac_bits, *ac_values])) + (seg(0xDD, restart.to_bytes(2, "big")) if restart else b"") + seg(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0]))
    mcus = -(-width // 16) * -(-height // 16)
    out, bits, pred, marks = b"", "", [0, 0, 0], 0

    def flush():
        raw = bits + "1" * (-len(bits) % 8)
        return bytes(int(raw[i : i + 8], 2) for i in range(0, len(raw), 8)).replace(b"\xff", b"\xff\0")

    for m in range(mcus):
        for k in (0, 0, 0, 0, 1, 2):
            v = rng.randint(-60, 60)
            d, pred[k] = v - pred[k], v
            n = abs(d).bit_length()
            bits += f"{dc[n][0]:0{dc[n][1]}b}" + (f"{d if d > 0 else d + (1 << n) - 1:0{n}b}" if n else "")
            place = 0
            for s in rng.choices([0x01, 0x11, 0x32, 0xF0], k=rng.randint(0, 4)):
                if place + (s >> 4) + 1 <= 62:
                    place += (s >> 4) + 1
                    bits += f"{ac[s][0]:0{ac[s][1]}b}" + "".join(rng.choice("01") for _ in range(s & 15))
            bits += f"{ac[0][0]:0{ac[0][1]}b}"
        if restart and (m + 1) % restart == 0 and m + 1 < mcus:
            out, bits, pred = out + flush() + bytes([255, 0xD0 + marks % 8]), "", [0, 0, 0]
            marks += 1
    return head + out + flush() + b"\xff\xd9"


def test_general_jpeg_decoding():
    files = [colour_jpeg(50, 37, r, s) for s, r in enumerate((0, 1, 3))] + jpeg.encode([bytes(range(192)) * 3])
    data, at, images = b"".join(files), 0, []
    for _ in files:
        image, at = jpeg.parse(data, at)
        images.append(image)
    for f, image, plane in zip(files, images, jpeg.dc_images(data, images)):
        want = np.array(scalar_decode(f))
        h, v = image.luminance()
        across, down = image.grid()
        grid = want.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
        q = image.quantizers[0]
        grid = np.clip(np.rint(grid * q / 8) + 128, 0, 255)
        assert plane.tolist() == grid[: plane.shape[0], : plane.shape[1]].astype(int).tolist()
        assert plane.shape == (-(-image.height // 8), -(-image.width // 8))


def test_broken_media_give_nulls(spark):
    from loomwright.llm.media import describe

    good = jpeg.encode([b" " * 192])[0]
    df = spark.createDataFrame([(1, 0, bytearray(b"abc")), (2, 0, None), (3, 0, bytearray(good[:-30])), (4, 0, bytearray(good))], "doc_id long, n_bytes long, media binary")
    rows = {r["doc_id"]: r["feature"] for r in describe(df).collect()}
    assert rows[1] is None and rows[2] is None and rows[3] is None and rows[4] is not None


def test_chat_fold_and_format(spark):
    from loomwright.llm.chat import digest, fold, format_conversations, parse, render

    e = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "delta", "assistant", "He"), (1, 1, 2, "delta", "assistant", "llo"), (1, 1, 3, "regenerate", "assistant", ""), (1, 1, 4, "delta", "assistant", "Bye <b>\\"), (1, 0, 9, "edit", "user", "hey"), (1, 2, 5, "message", "user", "gone"), (1, 2, 6, "delete", "user", None)]
    log = spark.createDataFrame(e, "conv_id long, turn long, seq int, kind string, role string, text string")
    assert sorted(map(tuple, fold(log).select("turn", "role", "text").collect())) == [(0, "user", "hey"), (1, "assistant", "Bye <b>\\")]
    r = render(fold(log)).first()
    at, under = 0, ""
    for run in r["runs"]:
        at += run["before"]
        under += r["formatted"][at : at + run["inside"]] if run["loss"] else ""
        at += run["inside"] + run["after"]
    assert at == len(r["formatted"]) and under == "Bye \\lb\\g\\b"
    assert parse(render(fold(log))).first()["loss_texts"] == ["Bye <b>\\"]
    rows = [(5, 0, "user", None), (5, 1, "assistant", "</turn> \\l \\b"), (5, 1, "assistant", "</turn> \\l \\b"), (5, None, None, "x"), (None, 0, "assistant", "日本")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in digest(format_conversations(table)).collect()}
    told = "".join(f"{a or ''}\n{t or ''}\n" for _, _, a, t in [rows[3], *rows[:3]])
    assert got[5]["n_turns"] == 4 and got[5]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert got[5]["loss_sha256"] == hashlib.sha256((rows[1][3] * 2).encode()).hexdigest() and got[None]["loss_chars"] == 2
    assert format_conversations(table.limit(0)).count() == 0


def test_url_filter(spark):
    from loomwright.llm.url_filter import RULES, UrlTrie, judge_urls

    urls = ["http://a.example.net/en/x?y", "https://EXAMPLE.net/de/", "x", None, "", "http://org/fr/1#z", "http://a.org/fr", "ftp://b.example.com/de/f", "http://net", "http://net/", "http://badnet/", "http://h?://q", "http://u@x.net:80/", "http://x.net/en/"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, rule string")
    rows = {r["page_id"]: r for r in judge_urls(df, RULES).collect()}
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
        fits = [(len(h.split(".")), len(p), v == "block", v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, 0, "allow", None))
        assert (rows[i]["host"], rows[i]["path"], rows[i]["verdict"], rows[i]["rule"]) == (host, path, *best[3:]), u
    trie = UrlTrie([("allow", "a.b", "/x"), ("block", "a.b", "/x"), ("allow", "a.b", "/x/y")])
    assert trie.find("q.a.b", "/xyz") == ("block", "a.b/x") and trie.find("a.b", "/x/yz") == ("allow", "a.b/x/y") and trie.find("b", "/x") is None
    assert judge_urls(df.limit(0), []).count() == 0


def test_sharding(spark):
    from loomwright.llm.sharding import shard_documents

    texts = ["hot"] * 400 + [f"pair {i // 2}" for i in range(200)] + [f"single {i}" for i in range(397)] + [None, "", "日"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, shard int")
    rows = shard_documents(df, shards=16).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(range(1000))
    by = defaultdict(list)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode()) and r["law"] == "rows" and r["grown_shard"] is None
        by[r["shard"]].append(r["slot"])
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and set(by) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    groups = defaultdict(set)
    for r in rows:
        groups[texts[r["doc_id"]] or ""].add(r["shard"])
    assert sum(len(s) > 1 for t, s in groups.items() if t.startswith("pair")) <= 10 and len(groups["hot"]) <= 9
    assert shard_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("texts", [["hot"] * 1000, [f"pair {i // 2}" for i in range(600)], ["a"] * 12 + ["b", "b", "c", "c"] + list("defg")], ids=["equal", "pairs", "small"])
def test_sharding_of_copies_keeps_its_law(spark, texts):
    from loomwright.llm.sharding import shard_documents

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = shard_documents(df, shards=16).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(range(len(texts)))
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    counts = [len(by[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts), counts
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def brute_items(docs, items):
    word = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(UPPER))
    windows = defaultdict(set)
    for i, t in items:
        w = word(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    out = []
    for d, t in docs:
        w = word(t)
        hit, who = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    who |= found
                    hit[k : k + n] = [True] * n
        out.append((d, len(w), sum(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), any(hit)))
    return out


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_decontamination(spark, monkeypatch, block):
    from loomwright.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(2)
    w = lambda n: " ".join(rng.choice(["a", "b", "Ünd", "C3", "d"]) for _ in range(n))
    items = [(10, w(14)), (2, "short item"), (3, None), (4, "..."), (5, "a"), (6, w(10)), (6, w(12))]
    docs = [(0, None), (1, ""), (2, "Short, ITEM! x shortitem"), (3, "x " + items[0][1].replace(" ", " -- ") + " y"), (4, items[5][1] + " " + items[5][1]), (5, "b c d"), (6, "xx a yy"), (6, "xx a yy"), (7, w(400))]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_hit long")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_items(d, b)
    assert sorted(tuple(r)[:6] for r in decontaminate.digest(found).collect()) == sorted(brute_items(docs, items))
    clean = {i for i, _, _, _, _, hit in brute_items(docs, items) if not hit}
    assert {r["doc_id"] for r in decontaminate.clean(d, b).collect()} == clean
    at = found.where("doc_id = 2").first()["spans"]
    assert [docs[2][1][s["start"] : s["end"]] for s in at] == ["Short, ITEM"]
    assert decontaminate.digest(found.where("doc_id = 2")).select("n_spans", "first_start", "last_end").first() == (1, 0, 11)
    assert decontaminate.digest(decontaminate.find_items(d, b.limit(0))).agg({"n_hit": "sum"}).first()[0] == 0


def brute_components(docs):
    sets = {}
    for d, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(UPPER))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), root(d)) for d in names]


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 60))
    passage = [word() for _ in range(60)]
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([5, 8, 9, 12, 25, 60, 200]))] + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 40))):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = copy[: len(copy) - rng.randint(0, 3)]
            docs.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    return [(i, t) for i, t in enumerate([*docs, None, "", " \n", "w x", "W  x", "one two three four", LONG, LONG])]


@pytest.mark.parametrize("seed, at_once", [(1, 4_000_000), (2, 4_000_000), (3, 300)])
def test_ngram_join(spark, monkeypatch, seed, at_once):
    from loomwright.llm import ngram_join

    monkeypatch.setattr(ngram_join, "AT_ONCE", at_once)  # the third case deals components into chunks
    docs = near_copies(seed)
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n int")
    want = brute_components(docs)
    assert sorted(map(tuple, ngram_join.components(df).collect())) == want
    if seed == 1:
        kept = ngram_join.keep_one(df.unionByName(df.where("doc_id = 0")))
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in want}) and kept.columns == df.columns
        assert ngram_join.components(df.limit(0)).count() == 0


def test_subset_enumeration_misses_no_pair():
    from loomwright.llm.ngram_join import Order, postings

    rng = np.random.default_rng(0)
    order = Order(np.zeros(0, np.int64), np.zeros(0, np.int64), 4)
    for boundary in (3, 20, 64):
        for _ in range(300):
            n = int(rng.integers(4, 60))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.08], rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if len(b) >= 4 and 100 * shared >= 80 * (len(a) + len(b) - shared):
                assert len(np.intersect1d(postings(a, order, boundary), postings(b, order, boundary))) > 0


def test_toxicity(spark):
    from loomwright.llm.toxicity import Model, fit, keep_ordinary, score

    rng = random.Random(4)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    bad = ["wretchling", "scumbucket", "vilefoolery"]

    def text(toxic):
        w = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(3 * toxic):
            w[rng.randrange(len(w))] = rng.choice(bad)
        return " ".join(w)

    labels = [int(rng.random() < 0.3) for _ in range(900)]
    texts = [text(y) for y in labels]
    model = fit(list(zip(texts[:600], labels[:600])))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[600:])] + [(1000, None), (1001, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in score(df, model).collect()}
    right = sum(got[i]["predicted"] == y for i, y in enumerate(labels[600:]))
    assert right >= 0.93 * 300 and got[1000]["score"] == got[1001]["score"] and got[1000]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert {r["doc_id"] for r in keep_ordinary(df, model).collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert fit([]).score("x") == 0.0 and isinstance(fit([("a", 1)]), Model)


def test_every_llm_query_is_there_once_and_runs_small(spark):
    from loomwright.llm.queries import queries

    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries()) == list(range(1, 14))


def test_heads_of_similar_sets_stay_together():
    from loomwright.llm.ngram_join import Order, join_sets, packed_head

    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    frequent = np.unique(pool[:400])
    order = Order(((frequent % np.uint64(4)) << np.uint64(32) | (frequent >> np.uint64(32))).astype(np.int64), rng.integers(4, 99, len(frequent)), 4)
    similar = 0
    for _ in range(1500):
        n = int(rng.integers(4, 120))
        a = np.unique(np.concatenate([rng.choice(pool, n // 2), rng.integers(0, 2**63, n - n // 2).astype(np.uint64)]))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * 0.2], rng.integers(0, 2**63, int(rng.integers(0, 6))).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if min(len(a), len(b)) >= 4 and 100 * shared >= 80 * (len(a) + len(b) - shared):
            similar += 1
            assert join_sets([1, 2], [packed_head(a, order), packed_head(b, order)], [1, 2], [len(a), len(b)])
    assert similar > 500


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from loomwright.llm.toxicity import fit_on

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    model = fit_on(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    left = [(d, t) for d, t in docs if model.score(t) < 0.5]
    keep = {c for _, _, c in brute_components(left)}
    left = [(d, t) for d, t in left if d in keep]
    want = {d for d, _, _, _, _, hit in brute_items(left, items) if not hit}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == want and len(want) > 50
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "packing"]
    whole = defaultdict(int)
    for r in got:
        whole[r["doc_id"]] += r["length"]
    assert all(whole[r["doc_id"]] == r["doc_tokens"] for r in got)


def test_pipeline_stages_take_odd_rows(spark):
    """Nulls in any column, an extra column and a repeated row pass every stage."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.createDataFrame([(1, None, None, None, None, 1), (None, "a b c d e f g", "en", "s", 1, 2), (3, "", "en", None, 0, 3), (3, "", "en", None, 0, 3), (4, "x y z", None, "s", 5, 4)], "doc_id long, text string, lang string, source string, n_chars long, label long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "label"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()) == [(False, 1), (False, 3), (False, 4), (True, 0)]


def test_token_files_tell_null_ids_from_all_others(spark, tokenizer):
    from loomwright.llm.token_file import read_tokens, write_tokens

    rows = [(None, "a"), (-(2**63), "b c"), (2**63 - 1, None), (0, ""), (None, None), *[(5, "same row")] * 40]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    got = read_tokens(write_tokens(df, common.tokenizer_path(), end_id=2)).orderBy("start").collect()
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=str) == sorted(((i, len(ids_of(tokenizer, t)) + 1) for i, t in rows), key=str)
    known = [r["doc_id"] for r in got]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0))
