"""Exact Jaccard join of documents' 5-word shingle sets, and its connected components.

A size-aware heavy-light join. Sets are hashed (64 bits a shingle), equal sets count once. Shingles have
one global order: first those that few documents share, by hash, then the frequent ones by frequency.
Sets of similarity 0.8 share at least k of the first n - ceil(0.8 n) + k shingles (prefix filter), so

* small sets enumerate the subsets of two shingles of their prefix for k = 2, and meet in equal subsets;
* large sets, and small ones that a large one may equal, enter the inverted lists of their prefix for
  k = 1, which are scanned.

The boundary is where enumerating gets dearer than scanning, by the sizes' histogram and the measured length
of lists. A set of under 4 shingles equals only equal sets.

Steps: (1) sizes, signatures and sketches of all documents, and numbers of sets that hold a shingle;
(2) postings, packed by bucket of their key; (3) in each bucket, the sets of a list that sizes allow to be similar are
paired if the list has at most ``PAIRED``, so that each pair can be judged: a sketch has the parity of a set's shingles in
about as many places as it has shingles, and where two sketches differ in more places than similar sets may
differ in shingles, the pair goes. That is exact, and leaves hardly any pair that only shares a shingle or two. Sets of
a longer list are linked to their neighbours by size, which connects all that can be similar and needs no pairs, and
those of one size that a task of step 2 meets are so linked before they are posted;
(4) candidate components of both kinds of links; those with links of longer lists are refined: the heads of their sets
(prefixes for a larger k) meet, and pairs that share fewer than k shingles there, or differ too much already, part;
(5) the sets of each component meet once and overlaps are counted exactly, unless the two are connected
already. A component of over ``AT_ONCE`` shingles is dealt into chunks: first each chunk by itself, then some members
of large clusters of all chunks, then what is outside the component's largest cluster, in parts, against every chunk.
That leaves out only pairs that are connected already, so no pair of different components goes unseen. (6) Links'
components, joined back to documents. Tables of a step are deleted when the next one has been written.

Null or empty texts, and texts without words, have no shingles and no links. A text of 1 to 4 words is one
shingle. Repeated rows are one set. Ids may repeat: each row is returned. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwright.operators.graph import connected_components

from .bpe import mix
from .common import forget, release, ship_package, steps, written

WORDS = 5
NUM, DEN = 80, 100
#: Shingles in a chunk of step 1, in one task of step 5, and in a bucket's postings; sets in one task of step 5.
CHUNK, AT_ONCE, POSTINGS, SETS_AT_ONCE = 1_000_000, 2_000_000, 750_000, 20_000
#: Bytes of text whose shingles one task counts, and one group of them.
COUNTED, GROUPED = 64_000_000, 4_000_000
#: Sets of one size that a task leaves unlinked under a key; sets of a list that are paired, and pairs of a bucket: beyond either, lists
#: are linked by neighbours. Shingles of up to some dozen sets stay unranked where more than ``FREQUENT`` are more frequent, and links of
#: neighbours over such lists would connect most of the corpus.
SHORT, PAIRED, PAIRS = 5, 32, 1_000_000
HUB = np.uint32(1 << 31)
#: A shingle of so many sets may rank as frequent; frequent shingles that are broadcast at most (16 bytes
#: each, and a mask of 16 MB); bits of the filter of step 5 (16 MB, whatever the corpus).
SHARED, FREQUENT, FILTER_BITS = 4, 1_000_000, 27
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_WEIGHT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many each text has."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = _SPACE[buf]
    word = ~space
    starts = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.flatnonzero(space & np.concatenate([[False], word[:-1]]))
    size = ends - starts
    powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
    at = np.flatnonzero(word)
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    total = np.add.reduceat(_WEIGHT[_TABLE[buf[at]]] * powers[place], first)
    ends_of_text = np.cumsum([len(r) + 1 for r in raw])
    n = np.diff(np.concatenate([[0], np.searchsorted(starts, ends_of_text)]))
    return mix(total + size.astype(np.uint64)), n


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The set of each text: sorted distinct 64-bit hashes of its shingles."""
    h, n = _word_hashes(texts)
    out = []
    if len(h) >= WORDS:
        five = np.full(len(h) - WORDS + 1, np.uint64(WORDS))
        for j in range(WORDS):
            five = mix(five + h[j : len(h) - WORDS + 1 + j] * _ODD[j])
    at = 0
    for k in n.tolist():
        if k >= WORDS:
            s = np.sort(five[at : at + k - WORDS + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif k:
            one = np.full(1, np.uint64(k))
            for j in range(k):
                one = mix(one + h[at + j : at + j + 1] * _ODD[j])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += k
    return out


def signature(s: np.ndarray) -> int:
    """A hash of a set; also its id (0: empty)."""
    return int(mix(np.array([np.sum(mix(s), dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0]) if len(s) else 0


def need(n):
    """Shingles that a set of n must share with a similar one, at least."""
    return -(-NUM * n // DEN)


def head_need(n):
    """Shingles that the heads of two similar sets share at least, by the smaller one's size. A head is the
    prefix for this k: n - need(n) + head_need(n) shingles."""
    return n // 20 + 1


def sketch(s: np.ndarray) -> bytes:
    """Parities of a set's shingles in as many places as the next power of two has, 64 at least."""
    places = max(64, 1 << int(len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1).astype(np.uint8)).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """In how many shingles two sets differ at least. Parities of fewer places are those of more, folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _documents(df: DataFrame, groups: int) -> DataFrame:
    """Step 1. kind 0: a document (a: id, k: its key, n: size of its set, s: its set, tokens: its sketch, where a task meets a set
    for the first time); kind 1: a block of shingles for counting (a: their group), 32 bits of each. Counted are
    the shingles in the first half of each set by hash; the others hardly get into a prefix and rank as rare."""

    def block(parts):
        t = np.concatenate(parts)
        group = (t % np.uint64(groups)).astype(np.int64)
        by = np.argsort(group, kind="stable")
        high, edge = (t[by] >> np.uint64(32)).astype(np.uint32), np.concatenate([[0], np.cumsum(np.bincount(group, minlength=groups))])
        used = np.flatnonzero(np.diff(edge))
        zero = np.zeros(len(used), np.int64)
        return _batch(1, used, zero, zero, zero, [high[edge[g] : edge[g + 1]].tobytes() for g in used])

    def run(batches):
        parts, held, seen = [], 0, set()
        for batch in steps(batches, size=1_000_000):
            sets = shingle_sets(batch.column(1).to_pylist())
            sigs, marks = [signature(s) for s in sets], []
            for s, g in zip(sets, sigs):
                marks.append(None)
                if g not in seen and len(s) >= 4:
                    seen.add(g)
                    marks[-1] = sketch(s)
                    parts.append(s[: (len(s) + 1) // 2])
                    held += len(parts[-1])
            yield _batch(0, batch.column(0), batch.column(2), np.array([len(s) for s in sets]), np.array(sigs, np.int64), marks)
            if held >= CHUNK // 2:
                yield block(parts)
                parts, held, seen = [], 0, set()
        if parts:
            yield block(parts)

    return df.mapInArrow(run, "kind int, a long, k long, n int, s long, tokens binary")


def _batch(kind, a, k, n, s, tokens) -> pa.RecordBatch:
    whole = [x if isinstance(x, pa.Array) else pa.array(x) for x in (a, k)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), *whole, pa.array(np.asarray(n, np.int32)), pa.array(s), pa.array(tokens, pa.binary())], ["kind", "a", "k", "n", "s", "tokens"])


def _counts(seen: DataFrame, tasks: int) -> DataFrame:
    """Shingles (by group and 32 bits) that at least ``SHARED`` sets hold, with their number."""

    def run(pdf):
        import pandas as pd

        release()  # what the group before has freed
        t = np.sort(np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["tokens"]]))
        edge = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
        n = np.diff(edge)
        k = np.flatnonzero(n >= SHARED)
        return pd.DataFrame({"key": (np.int64(pdf["a"].iloc[0]) << 32) | t[edge[k]].astype(np.int64), "n": n[k]})

    return seen.where("kind = 1").select("a", "tokens").repartition(tasks, "a").groupBy("a").applyInPandas(run, "key long, n long")


class Order:
    """The global order of shingles: frequent ones last, by their number."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, groups: int) -> None:
        by = np.argsort(keys)
        self.keys, counts, self.groups = keys[by].astype(np.uint64), counts[by], np.uint64(groups)
        self.rank = np.empty(len(keys), np.int64)
        self.rank[np.lexsort((self.keys, counts))] = np.arange(len(keys))
        # A shingle whose 24 bits are not here is rare.
        self.maybe = np.zeros(1 << 24, bool)
        self.maybe[(self.keys & np.uint64(0xFFFFFF)).astype(np.int64)] = True

    def prefix(self, s: np.ndarray, n: int) -> np.ndarray:
        """The first n of a set (sorted by hash) in the global order."""
        return self.head(s, n)[0]

    def head(self, s: np.ndarray, n: int) -> tuple[np.ndarray, int, bool]:
        """The same, how many of it are rare, and whether these are all rare ones of the set."""
        look = np.flatnonzero(self.maybe[((s >> np.uint64(32)) & np.uint64(0xFFFFFF)).astype(np.int64)])
        if not len(look):
            return s[:n], min(n, len(s)), len(s) <= n
        key = (s[look] % self.groups) << np.uint64(32) | s[look] >> np.uint64(32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        look, at = look[hit], at[hit]
        rare = np.delete(s, look)
        if len(rare) >= n:
            return rare[:n], n, len(rare) == n
        return np.concatenate([rare, s[look][np.lexsort((s[look], self.rank[at]))][: n - len(rare)]]), len(rare), True


def postings(s: np.ndarray, order: Order, boundary: int) -> np.ndarray:
    """Keys under which a set is found."""
    n = len(s)
    if n < 4:
        return s[:0]
    one = n - need(n) + 1
    head = order.prefix(s, one + 1)
    keys = []
    if n <= boundary:
        i, j = np.triu_indices(len(head), 1)
        keys.append(mix(head[i] * _ODD[0] + mix(head[j] * _ODD[1])))
    if n > boundary or NUM * (boundary + 1) <= DEN * n:
        keys.append(head[:one])
    return np.concatenate(keys)


def choose_boundary(sizes: dict[int, int], partners: float) -> int:
    """The largest size for which subsets are enumerated: least rows made and partners verified."""
    best, least = 3, 0.0
    saved = 0.0
    for n in range(4, 65):
        one = n - need(n) + 1
        scan = one * (1 + partners * (2 + n / 16))
        saved += sizes.get(n, 0) * ((one + 1) * one / 2 - scan)
        extra = sum(sizes.get(m, 0) * (m - need(m) + 1) for m in range(-(-NUM * (n + 1) // DEN), n + 1))
        if saved + extra < least:
            best, least = n, saved + extra
    return best


def _postings(df: DataFrame, order, boundary: int, buckets: int) -> DataFrame:
    """Step 2: blocks of postings by bucket: keys, places in the block's table of sets, sets, sizes.

    Where more than ``SHORT`` sets of one size in a block have a key, they are linked to the first of them here (a bucket
    below 0: keys and sets hold the links' ends), and only that one is posted, marked as a hub (``HUB`` in its place): a hot
    key's list has a posting for each block and size, whatever the number of its sets."""

    def emit(keys, sets, sizes):
        key = np.concatenate(keys)
        who = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
        sets, sizes = np.array(sets, np.int64), np.array(sizes, np.int32)
        by = np.lexsort((sets[who], sizes[who], key))
        key, who = key[by], who[by]
        start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (sizes[who[1:]] != sizes[who[:-1]])]))
        members = np.diff(np.concatenate([start, [len(key)]]))
        first, hot = np.repeat(start, members), np.repeat(members > SHORT, members)
        stars = np.unique(np.column_stack([sets[who[hot]], sets[who[first[hot]]]]), axis=0)
        stars = stars[stars[:, 0] != stars[:, 1]]
        hub = hot & (first == np.arange(len(key)))
        stay = hub | ~hot
        key, who, hub = key[stay], who[stay], hub[stay]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        key, who, bucket, hub = key[by], who[by], bucket[by], hub[by]
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [(-1 - int(stars[0, 0]) % buckets, stars[:, 0].tobytes(), b"", stars[:, 1].tobytes(), b"")] if len(stars) else []
        for b in range(buckets):
            part = slice(edge[b], edge[b + 1])
            if edge[b] < edge[b + 1]:
                mine, at = np.unique(who[part], return_inverse=True)
                rows.append((b, key[part].tobytes(), (at.astype(np.uint32) | np.where(hub[part], HUB, np.uint32(0))).tobytes(), sets[mine].tobytes(), sizes[mine].tobytes()))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["bucket", "keys", "at", "sets", "sizes"])

    def run(batches):
        known = order.value
        keys, sets, sizes, held, seen = [], [], [], 0, set()
        for batch in steps(batches, size=1_000_000):
            for s in shingle_sets(batch.column(1).to_pylist()):
                g = signature(s)
                if g in seen or len(s) < 4:
                    continue
                seen.add(g)
                k = postings(s, known, boundary)
                if len(k):
                    keys.append(k)
                    sets.append(g)
                    sizes.append(len(s))
                    held += len(k)
            if held >= CHUNK // 2:
                yield emit(keys, sets, sizes)
                keys, sets, sizes, held, seen = [], [], [], 0, set()
        if keys:
            yield emit(keys, sets, sizes)

    return df.mapInArrow(run, "bucket int, keys binary, at binary, sets binary, sizes binary")


def _links(blocks: DataFrame, tasks: int) -> DataFrame:
    """Step 3: candidate links of each bucket: pairs of short lists (a, b and their sizes), and a forest of neighbours in
    longer ones (``long``)."""

    def run(pdf):
        import pandas as pd

        release()  # what the group before has freed
        if pdf["bucket"].iloc[0] < 0:
            a, b = (np.concatenate([np.frombuffer(x, np.int64) for x in pdf[c]]) for c in ("keys", "sets"))
            return pd.DataFrame({"a": a, "b": b, "n": 0, "m": 0, "long": True})
        key = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]])
        shift = np.cumsum([0, *(len(x) // 8 for x in pdf["sets"])])
        place = [np.frombuffer(x, np.uint32) for x in pdf["at"]]
        hub = np.concatenate([x >= HUB for x in place])
        who = np.concatenate([(x & ~HUB).astype(np.int64) + o for x, o in zip(place, shift)])
        sets = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["sets"]])
        size = np.concatenate([np.frombuffer(x, np.int32) for x in pdf["sizes"]]).astype(np.int64)
        # Only keys that occur again matter.
        by = np.argsort(key, kind="stable")
        key, who, hub = key[by], who[by], hub[by]
        again = key[1:] == key[:-1]
        keep = np.concatenate([again, [False]]) | np.concatenate([[False], again])
        key, who, hub = key[keep], who[keep], hub[keep]
        by = np.lexsort((sets[who], size[who], key))
        key, node, size, hub = key[by], sets[who[by]], size[who[by]], hub[by]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        hubs = np.repeat(np.add.reduceat(hub, start) > 0, np.diff(np.concatenate([start, [len(key)]]))) if len(key) else hub
        # A set that several tasks met is once in a list.
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])[: len(key)]
        key, node, size, hubs = key[new], node[new], size[new], hubs[new]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
        members = np.diff(np.concatenate([start, [len(key)]]))
        # Lists are paired from the shortest on, as long as the bucket's pairs are not too many.
        by_length = np.bincount(members, minlength=PAIRED + 1)[: PAIRED + 1] * np.arange(PAIRED + 1) * np.arange(-1, PAIRED) // 2
        paired = int(np.flatnonzero(np.cumsum(by_length) <= PAIRS)[-1])
        many = np.repeat(members > paired, members) | hubs
        after = np.repeat(start + members, members) - np.arange(len(key)) - 1
        pairs, i = [np.zeros((0, 4), np.int64)], np.flatnonzero(~many)
        for d in range(1, PAIRED):
            i = i[after[i] >= d]
            i = i[NUM * size[i + d] <= DEN * size[i]]  # sizes ascend: what is too large now stays so
            pairs.append(np.column_stack([node[i], node[i + d], size[i], size[i + d]]))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        i = np.flatnonzero((key[1:] == key[:-1]) & many[:-1] & (NUM * size[1:] <= DEN * size[:-1]))
        chain = np.unique(np.column_stack([node[i], node[i + 1]]), axis=0)
        parent: dict[int, int] = {}

        def root(x):
            while (p := parent.get(x, x)) != x:
                parent[x] = p = parent.get(p, p)
                x = p
            return x

        for x, y in chain.tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        nodes = np.array(list(parent), np.int64)
        tree = pd.DataFrame({"a": nodes, "b": np.array([root(x) for x in parent], np.int64), "n": 0, "m": 0, "long": True})
        return pd.concat([pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "n": pairs[:, 2], "m": pairs[:, 3], "long": False}), tree])

    schema = "a long, b long, n long, m long, long boolean"
    return blocks.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(run, schema).distinct()


def _judged(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose sketches allow similarity; rows: documents' sets with sketches."""

    def run(batches):
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            least = np.array([apart(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))], np.int64)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array((DEN + NUM) * least <= (DEN - NUM) * (n + m)))

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    marks = rows.where("tokens is not null").join(ends, "node").groupBy("node").agg(F.first("tokens").alias("x"))
    both = pairs.join(marks.withColumnRenamed("node", "a"), "a").join(marks.select(F.col("node").alias("b"), F.col("x").alias("y")), "b")
    return both.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def _needed(nodes: DataFrame):
    """A filter of fixed size over set ids, made by bitmap aggregates: (broadcastable) bits."""
    slot = F.pmod(F.col("node"), F.lit(1 << FILTER_BITS)) + 1
    maps = nodes.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("m")).collect()
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in maps:
        bits[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return bits


def packed_head(s: np.ndarray, order: Order) -> np.ndarray:
    """A set's head for ``join_sets``: number of rare shingles, whether they are all, then 32 bits of each
    (what else agrees in these can only add links)."""
    n = len(s)
    head, rare, whole = order.head(s, n - need(n) + head_need(n))
    return np.concatenate([np.array([rare, whole], np.uint32), (head >> np.uint64(32)).astype(np.uint32)])


def may_be_similar(a: np.ndarray, b: np.ndarray, shared: int, n: int, m: int) -> bool:
    """Whether heads leave room for similarity: up to the smaller last rare shingle both heads are complete, and
    there the sets must not differ by more than similar sets of n and m shingles may differ in all."""
    x, y = a[2 : 2 + a[0]], b[2 : 2 + b[0]]
    last = min(int(x[-1]) if not a[1] and len(x) else 2**32, int(y[-1]) if not b[1] and len(y) else 2**32)
    apart = int(np.searchsorted(x, last, side="right")) + int(np.searchsorted(y, last, side="right")) - 2 * shared
    return (DEN + NUM) * apart <= (DEN - NUM) * (n + m)


def _sets(df: DataFrame, bits, order=None) -> DataFrame:
    """The sets that the filter lets pass; with an order only their heads."""

    def run(batches):
        known, seen = bits.value, set()
        for batch in steps(batches, size=1_000_000):
            out = []
            for s in shingle_sets(batch.column(1).to_pylist()):
                g = signature(s)
                slot = g % (1 << FILTER_BITS)
                if len(s) >= 4 and known[slot >> 3] >> (slot & 7) & 1 and g not in seen:
                    seen.add(g)
                    out.append((g, (packed_head(s, order.value) if order else s).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.int64()), pa.array([s for _, s in out], pa.binary())], ["node", "tokens"])

    return df.mapInArrow(run, "node long, tokens binary")


def join_sets(ids: list[int], sets: list[np.ndarray], labels: list[int], sizes: list[int] | None = None) -> list[tuple[int, int]]:
    """Links between labels, enough to connect what similar sets connect: pairs whose labels are connected
    already are passed over. With ``sizes`` the sets are heads, and links are of pairs that may be similar."""
    skip = 0 if sizes is None else 2
    held = np.array([len(s) - skip for s in sets])
    size = held if sizes is None else np.array(sizes)
    by = np.lexsort((ids, size))
    size, held, sets = size[by], held[by], [sets[i] for i in by]
    names, label = np.unique(np.array(labels, np.int64)[by], return_inverse=True)
    flat = np.concatenate([s[skip:] for s in sets])
    _, token = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), held)
    order = np.argsort(token, kind="stable")
    lists, edge = owner[order], np.concatenate([[0], np.cumsum(np.bincount(token))])
    begin = np.concatenate([[0], np.cumsum(held)])
    upto = np.searchsorted(size, DEN * size // NUM, side="right")
    found = []
    for i in range(len(sets)):
        other = label[i + 1 : upto[i]] != label[i]
        if not other.any():
            continue
        t = token[begin[i] : begin[i + 1]]
        lo, n = edge[t], edge[t + 1] - edge[t]
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        met = lists[at]
        met = met[(met > i) & (met < upto[i])] - (i + 1)
        shared = np.bincount(met, minlength=upto[i] - (i + 1))
        enough = DEN * shared >= NUM * (size[i] + size[i + 1 : upto[i]] - shared) if sizes is None else shared >= head_need(size[i])
        for j in np.flatnonzero(other & enough):
            a, b = label[i], label[i + 1 + j]
            if a != b and (sizes is None or may_be_similar(sets[i], sets[i + 1 + j], int(shared[j]), int(size[i]), int(size[i + 1 + j]))):
                found.append((int(names[a]), int(names[b])))
                label[label == b] = a
    return found


def _verified(rows: DataFrame, keys: list[str], bins: int, heads: bool = False) -> DataFrame:
    """Links of the sets that meet under ``keys``; rows: keys, node, tokens, label, n. Small groups share a
    task's call: groups are dealt into bins by their keys."""

    def run(pdf):
        import pandas as pd

        release()  # what the group before has freed
        links = []
        for _, group in pdf.groupby(keys, sort=False):
            if len(group) > 1:
                group = group.drop_duplicates("node")
                links += join_sets(group["node"].tolist(), [np.frombuffer(t, np.uint32 if heads else np.uint64) for t in group["tokens"]], group["label"].tolist(), group["n"].tolist() if heads else None)
        return pd.DataFrame({"a": np.array([x for x, _ in links], np.int64), "b": np.array([x for _, x in links], np.int64)})

    dealt = rows.select(*keys, "node", "tokens", "label", "n", F.pmod(F.xxhash64(*keys), F.lit(bins)).cast("int").alias("bin"))
    return dealt.repartition(max(12, bins // 4), "bin").groupBy("bin").applyInPandas(run, "a long, b long")


def _relabel(rows: DataFrame, links: DataFrame) -> DataFrame:
    found = connected_components(links)
    return rows.join(found.select(F.col("node").alias("label"), F.col("component").alias("_c")), "label", "left").withColumn("label", F.coalesce("_c", "label")).drop("_c")


def components(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the smallest id reachable by links; null if
    nothing reachable has an id)."""
    joined = _classes(df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")))
    smallest = written(joined.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")), "smallest")
    return joined.join(smallest, "component", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def _key() -> F.Column:
    """What tells rows apart: id and text, either of which may be null."""
    return F.xxhash64("doc_id", "text")


def _classes(df: DataFrame) -> DataFrame:
    """A stored table of one row for each of ``df`` (doc_id, text): doc_id, k (its key), n (size of its set), component
    (null: no shingles)."""
    spark = df.sparkSession
    ship_package(spark)
    docs = df.select("doc_id", "text", _key().alias("k"))
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(64, held // GROUPED)
    seen = written(_documents(docs, groups), "sets")
    counts = written(_counts(seen, max(least, held // COUNTED)), "counts")
    rows = written(seen.where("kind = 0").select(F.col("a").alias("doc_id"), "k", "n", F.col("s").alias("node"), "tokens"), "rows")
    forget(seen)

    # Frequent shingles: as many of the most frequent ones as may be broadcast.
    step = F.floor(F.log2("n") * 4).cast("int")
    histogram = sorted(((r["k"], r["c"], r["q"]) for r in counts.groupBy(step.alias("k")).agg(F.count("*").alias("c"), F.sum(F.col("n") * F.col("n")).alias("q")).collect()), reverse=True)
    held, floor = 0, 10**6
    for k, c, _ in histogram:
        if held + c > FREQUENT:
            break
        held, floor = held + c, k
    top = counts.where(step >= floor).toPandas()
    order = spark.sparkContext.broadcast(Order(top["key"].to_numpy(np.int64), top["n"].to_numpy(np.int64), groups))

    # The boundary between small and large sets, and the number of buckets.
    sizes = {r["n"]: r["c"] for r in rows.groupBy(F.least("n", F.lit(65)).alias("n")).agg(F.count("*").alias("c")).collect()}
    total = rows.agg(F.sum("n")).first()[0] or 0
    partners = sum(q for k, _, q in histogram if k < floor) / max(1, total) + 0.05  # and pairs that share less
    boundary = choose_boundary(sizes, partners)
    buckets = max(12, -(-total * 22 // 100 // POSTINGS))

    # Postings are read once, so they lie on disk once: as the shuffle's files.
    links = written(_links(_postings(docs, order, boundary, buckets), max(least, buckets // 2)), "links")
    forget(counts)
    judged = _judged(links.where("not long").select("a", "b", "n", "m"), rows)
    found = connected_components(judged.unionByName(links.where("long").select("a", "b")))
    sizes_of = rows.where("tokens is not null").select("node", "n").distinct()
    candidates = written(found.join(sizes_of, "node"), "candidates")
    chained = written(candidates.join(links.where("long").select(F.col("a").alias("node")).distinct(), "node").select("component", F.lit(True).alias("long")).distinct(), "chained")
    # So few components are heavy that they may be broadcast: one for each 4 * AT_ONCE shingles of all, at most.
    heavy = candidates.groupBy("component").agg(F.sum("n").alias("n")).where(F.col("n") > 4 * AT_ONCE).select("component", F.lit(True).alias("heavy"))
    marked = candidates.join(chained, "component", "left").join(F.broadcast(heavy), "component", "left")
    marked = written(marked.withColumn("refined", F.expr("long is not null and heavy is null")), "marked")
    forget(candidates, chained, links)

    # Heads, a quarter of the sets, tell most pairs apart that share a few shingles only. Components whose
    # heads are too many for a task stay as they are.
    light = marked.where("refined").select("node", "component", "n")
    bins = max(48, -(-(light.agg(F.sum("n")).first()[0] or 0) // AT_ONCE))
    whole = marked.where("not refined").select(F.col("node").alias("a"), F.col("component").alias("b"))
    if light.isEmpty():
        finer = whole
    else:
        bits = spark.sparkContext.broadcast(_needed(light))
        heads = _sets(docs, bits, order).join(light, "node").withColumn("label", F.col("node"))
        finer = _verified(heads, ["component"], bins, heads=True).unionByName(whole)
    candidates = written(connected_components(finer).join(sizes_of, "node"), "candidates")
    forget(marked)

    # Likewise few components are dealt into chunks.
    sums = candidates.groupBy("component").agg(F.ceil(F.greatest(F.sum("n") / AT_ONCE, F.count("*") / SETS_AT_ONCE)).cast("int").alias("chunks"))
    placed = candidates.join(F.broadcast(sums.where("chunks > 1")), "component", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    placed = written(placed.select("node", "component", "n", "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")), "placed")
    total = placed.agg(F.sum("n")).first()[0] or 0
    forget(candidates)
    bits = spark.sparkContext.broadcast(_needed(placed))
    sets = _sets(docs, bits).join(placed, "node").withColumn("label", F.col("node"))
    bins = max(48, -(-4 * total // AT_ONCE))
    links = written(_verified(sets, ["component", "chunk"], bins), "links")
    if not placed.where("chunks > 1").isEmpty():
        links = _large(written(sets.where("chunks > 1").dropDuplicates(["node"]), "large"), links, bins)
    found = connected_components(links)
    forget(links, placed)

    joined = rows.select("doc_id", "k", "n", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", F.when(F.col("node") != 0, F.col("node"))))
    joined = written(joined.select("doc_id", "k", "n", "component"), "joined")
    forget(rows)
    return joined


def _large(sets: DataFrame, links: DataFrame, bins: int) -> DataFrame:
    """Step 5 for components in several chunks: links across chunks added to those within."""
    labelled = _relabel(sets, links)
    # Some members of every label that holds a quarter of its chunk or more meet.
    in_chunk = Window.partitionBy("component", "chunk")
    size = labelled.groupBy("component", "chunk", "label").agg(F.count("*").alias("c")).withColumn("all", F.sum("c").over(in_chunk)).where("4 * c >= all").select("component", "chunk", "label")
    nth = F.row_number().over(Window.partitionBy("component", "chunk", "label").orderBy(F.xxhash64("node")))
    some = labelled.join(size, ["component", "chunk", "label"]).withColumn("_n", nth).where("_n <= 8").drop("_n")
    links = written(links.unionByName(_verified(some, ["component"], bins)), "links")
    labelled = written(_relabel(sets, links), "large")
    # What is outside the largest label of the component meets every chunk, and itself, in parts of a task's size.
    counts = labelled.groupBy("component", "label").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    main = counts.groupBy("component").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    outside = counts.join(main, "component").where("label <> main").groupBy("component", "main")
    parts = outside.agg(F.ceil(F.greatest(F.sum("n") / AT_ONCE, F.sum("c") / SETS_AT_ONCE)).cast("int").alias("parts"))
    # One row for a component of several chunks: few, as above.
    marked = labelled.join(F.broadcast(written(parts, "parts")), "component")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    out = marked.where("label <> main").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    left = marked.where("label = main").unionByName(out.withColumn("chunk", F.col("chunks") + F.col("part")).select(*marked.columns)).withColumn("part", every(F.col("parts")))
    right = out.withColumn("chunk", every(F.col("chunks") + F.col("parts")))
    links = written(links.unionByName(_verified(left.unionByName(right), ["component", "chunk", "part"], bins)), "links")
    forget(sets, labelled)
    return links


def _by_filter(df: DataFrame, key: str, bits, inside: bool) -> DataFrame:
    """Rows whose key the filter holds, or does not."""
    place = df.columns.index(key)

    def run(batches):
        known = bits.value
        for batch in batches:
            slot = batch.column(place).to_numpy() % (1 << FILTER_BITS)
            hit = (known[slot >> 3] >> (slot & 7) & 1).astype(bool)
            yield batch.filter(pa.array(hit if inside else ~hit))

    return df.mapInArrow(run, df.schema)


def keep_one(df: DataFrame) -> DataFrame:
    """Of each component the document with the smallest doc_id, all its columns; of several texts of that id in the
    component the one with the smallest hash. A document without an id stays only where its component has none with
    one. Rows of equal id and text are one document, also if they have no shingles; ids alone tell nothing apart, so
    different texts of one id are judged each by its own component. An empty table gives an empty result.

    Only rows that may have to go are shuffled: a filter of fixed size lets all others pass as they are."""
    spark = df.sparkSession
    found = _classes(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k")).alias("first")
    stays = written(found.where("component is not null").groupBy("component").agg(first).select("component", F.col("first.k").alias("stays")), "stays")
    others = written(found.join(stays, "component").where("k <> stays").select("k").distinct(), "others")
    repeated = found.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    bits = spark.sparkContext.broadcast(_needed(others.unionByName(repeated).select(F.col("k").alias("node"))))
    forget(found, stays)
    key = "_k"
    while key in df.columns:
        key += "_"
    keyed = df.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    doubtful = _by_filter(keyed, key, bits, True).join(others.withColumnRenamed("k", key), key, "left_anti").dropDuplicates([key])
    return _by_filter(keyed, key, bits, False).unionByName(doubtful.select(*keyed.columns)).drop(key)
