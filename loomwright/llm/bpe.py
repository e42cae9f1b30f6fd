"""Byte-level BPE over batches of whole texts, held as numpy arrays.

A batch of texts becomes one array of code points in which a barrier closes every text. Pre-tokens
are found by comparing neighbouring character classes, hashed by a prefix sum, and only distinct
pre-tokens are looked up or merged. Two ways fill the table of distinct pre-tokens:

* ``LibraryIds`` asks the tokenizers library's own model for the ids of each new pre-token;
* ``RankMerger`` merges all new pre-tokens at once in numpy: in every round each sequence applies
  its lowest-ranked pair, at all its places, simultaneously with all other sequences.

Both give what ``Tokenizer.encode(text, add_special_tokens=False)`` gives. Special strings inside
texts become their ids, as is the library's default.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd

OTHER, LETTER, NUMBER, SPACE, BARRIER = range(5)
#: Codes above Unicode: the end of a text, then one for each special string.
END = 0x110000
_CODES = 0x110000 + 64
#: The White_Space property of Unicode (fixed values).
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_ODD = 0x9E3779B97F4A7C15
#: Code points in one array, and distinct pre-tokens that a worker remembers.
CHUNK, REMEMBERED = 1_000_000, 600_000


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = SPACE
    return np.concatenate([out, np.full(_CODES - 0x110000, BARRIER, np.uint8)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, for uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _weights() -> np.ndarray:
    return mix(np.arange(1, _CODES + 1, dtype=np.uint64) * np.uint64(_ODD))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self) -> None:
        self.n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, CHUNK + CHUNK // 2)
            self.p, self.q = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.n, b, np.uint64)])) for b in (_ODD, pow(_ODD, -1, 1 << 64)))
        return self.p, self.q


_POWERS = Powers()


def pre_tokens(codes: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of an array that ends with a barrier (each barrier is one)."""
    kind = _classes()[codes]
    n = len(codes)
    first = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    barrier = kind == BARRIER
    start = first | barrier
    # The last white space before a visible character stands alone, or leads that character's run if it is a blank.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~barrier[1:])
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    # English contractions: an apostrophe alone between a non-blank and a letter.
    q = np.flatnonzero((codes[:-1] == 39) & first[:-1] & (kind[1:] == LETTER))
    if len(q):
        q = q[(q == 0) | (codes[q - 1] != 32)]
        a, b = codes[q + 1], codes[np.minimum(q + 2, n - 1)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for which, k in ((q[one], 2), (q[two], 3)):
            start[which + 1] = False
            start[which + k] = True
    return np.flatnonzero(start)


def hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pre-token's characters and length."""
    n = len(codes)
    p, q = _POWERS.upto(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_weights()[codes] * p[:n], out=total[1:])
    ends = np.append(starts[1:], n)
    return mix((total[ends] - total[starts]) * q[starts] + (ends - starts).astype(np.uint64))


class Vocabulary:
    """What a byte-level tokenizer file holds; ``of`` raises for files of another kind."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"] or spec["model"].get("ignore_merges"):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.path = path
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*self.vocab.values(), *self.special.values()]) + 1
        # Printable bytes stand for themselves, the others for code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        self.alphabet = {b: chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)}


class LibraryIds:
    """Ids of pre-tokens by the tokenizers library."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(vocabulary.path).model
        self.table = {b: c for b, c in vocabulary.alphabet.items()}

    def __call__(self, words: list[str]) -> list[list[int]]:
        tokenize, table = self.model.tokenize, self.table
        return [[x.id for x in tokenize(w.encode("utf-8", "replace").decode("latin-1").translate(table))] for w in words]


class RankMerger:
    """Lowest-rank merging of many byte sequences at once, on ragged arrays."""

    BITS = 18

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = vocabulary.vocab
        self.byte_id = np.array([v[vocabulary.alphabet[b]] for b in range(256)], np.int64)
        left = np.array([v[a] for a, _ in vocabulary.merges], np.uint64)
        right = np.array([v[b] for _, b in vocabulary.merges], np.uint64)
        self.result = np.array([v[a + b] for a, b in vocabulary.merges], np.int64)
        self.none = len(self.result)
        # Where no merge joins two bytes, a pre-token falls into segments that merge by themselves: however long a text
        # without blanks is, it takes as many rounds as its longest segment.
        of = {c: b for b, c in vocabulary.alphabet.items()}
        self.joins = np.zeros(1 << 16, bool)
        self.joins[[of[a[-1]] << 8 | of[b[0]] for a, b in vocabulary.merges]] = True
        keys = (left << np.uint64(32)) | right
        # Open addressing with linear probing, filled in rounds: of those that want a free slot, one gets it.
        n = 1 << self.BITS
        while n < 4 * len(keys):
            n *= 2
        self.mask, self.shift = n - 1, np.uint64(64 - n.bit_length() + 1)
        self.keys, self.ranks = np.full(n, np.uint64(2**64 - 1)), np.full(n, self.none, np.int64)
        todo, slot = np.arange(len(keys))[::-1], self._slot(keys[::-1])
        while len(todo):
            free = self.ranks[slot] == self.none
            self.keys[slot[free]], self.ranks[slot[free]] = keys[todo[free]], todo[free]
            placed = self.ranks[slot] == todo
            todo, slot = todo[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_ODD)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        slot = self._slot(keys)
        out = self.ranks[slot]
        look = np.flatnonzero((self.keys[slot] != keys) & (out != self.none))
        while len(look):
            slot[look] = (slot[look] + 1) & self.mask
            out[look] = self.ranks[slot[look]]
            look = look[(self.keys[slot[look]] != keys[look]) & (out[look] != self.none)]
        return out

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all words in order, and how many each word has."""
        raw = [w.encode("utf-8", "replace") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.byte_id[data]
        word = np.repeat(np.arange(len(raw)), size)
        apart = (word[1:] != word[:-1]) | ~self.joins[data[:-1].astype(np.int64) << 8 | data[1:]]
        begins = np.flatnonzero(np.concatenate([[True], apart]))[: len(data)]
        owner = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(data))))
        word = word[begins]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        same = np.zeros(len(sym), bool)
        np.equal(owner[1:], owner[:-1], out=same[:-1])
        rank = np.full(len(sym), self.none)
        at = np.flatnonzero(same)
        rank[at] = self.rank(sym[at], sym[at + 1])
        while len(sym):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            length = np.diff(np.append(heads, len(sym)))
            best = np.minimum.reduceat(rank, heads)
            over = np.repeat(best == self.none, length)
            if over.any():
                done.append((owner[over], sym[over]))
                sym, owner, rank = sym[~over], owner[~over], rank[~over]
                length, best = length[best != self.none], best[best != self.none]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, length))
            # Of places that overlap (a pair of equal symbols in a row), every second one from the left merges.
            run = np.concatenate([[True], np.diff(hit) != 1])
            hit = hit[(hit - hit[np.flatnonzero(run)][np.cumsum(run) - 1]) % 2 == 0]
            sym[hit] = self.result[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            hit -= np.arange(len(hit))
            sym, owner, rank = sym[keep], owner[keep], rank[keep]
            near = np.unique(np.concatenate([hit, hit[hit > 0] - 1]))
            rank[near] = self.none
            near = near[near + 1 < len(sym)]
            near = near[owner[near] == owner[near + 1]]
            rank[near] = self.rank(sym[near], sym[near + 1])
        if not done:
            return np.zeros(0, np.int64), size
        owner, sym = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        return sym[order], np.bincount(word[owner], minlength=len(raw))


def chunks(texts: list[str | None]):
    """(text number, piece) lists of about CHUNK code points; very long texts are cut where a run of
    white space begins, which changes no token."""
    out, size = [], 0
    for i, text in enumerate(texts):
        text = text or ""
        at = 0
        while len(text) - at > 2 * CHUNK:
            cut = at + CHUNK
            while cut < len(text) and not (text[cut].isspace() and not text[cut - 1].isspace()):
                cut += 1
            if cut >= len(text):
                break
            # white space before a special string ends a text for the library: keep both sides together
            if out:
                yield out
            yield [(i, text[at:cut])]
            out, size, at = [], 0, cut
        out.append((i, text[at:] if at else text))
        size += len(text) - at
        if size >= CHUNK:
            yield out
            out, size = [], 0
    if out:
        yield out


class BatchTokenizer:
    """Tokens of batches of texts; remembers what distinct pre-tokens became, up to a bound."""

    def __init__(self, path: str, by: str = "library") -> None:
        self.vocabulary = Vocabulary(path)
        self.by = LibraryIds(self.vocabulary) if by == "library" else RankMerger(self.vocabulary)
        self.specials = list(self.vocabulary.special.items())
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat, self.n_flat = np.zeros(1 << 16, np.int32), 0
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _codes(self, pieces: list[str]) -> np.ndarray:
        text = "\n".join(pieces) + "\n"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        codes[ends] = END
        present = [(s, k) for k, (s, _) in enumerate(self.specials) if s in text]
        if present:
            import re

            drop = np.zeros(len(codes), bool)
            number = dict(present)
            for m in re.finditer("|".join(re.escape(s) for s, _ in sorted(present, key=lambda x: -len(x[0]))), text):
                codes[m.start()] = END + 1 + number[m[0]]
                drop[m.start() + 1 : m.end()] = True
            codes = codes[~drop]
        return codes

    def _learn(self, new: list[int], words: list[str]) -> None:
        if isinstance(self.by, LibraryIds):
            lists = self.by(words)
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter((i for x in lists for i in x), np.int32, int(size.sum()))
        else:
            ids, size = self.by.merge(words)
        k, n = len(self.slot), self.n_flat
        while n + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while k + len(new) > len(self.begin):
            self.begin, self.count = np.concatenate([self.begin, np.zeros_like(self.begin)]), np.concatenate([self.count, np.zeros_like(self.count)])
        self.flat[n : n + len(ids)] = ids
        self.begin[k : k + len(new)] = n + np.cumsum(size) - size
        self.count[k : k + len(new)] = size
        self.n_flat += len(ids)
        self.slot.update(zip(new, range(k, k + len(new))))

    def _look_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all pre-tokens (-1 - k for the barrier END + k), and where the barriers END are."""
        codes = self._codes(pieces)
        starts = pre_tokens(codes)
        which, distinct = pd.factorize(hashes(codes, starts))
        known = self.slot.get
        slots = np.array([known(h, -1) for h in distinct.tolist()], np.int64)
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        head = codes[starts[first]]
        miss = np.flatnonzero((slots < 0) & (head < END))
        if len(miss):
            if len(self.slot) + len(miss) > REMEMBERED and self.slot:
                self._forget()
                return self._look_up(pieces)
            # The words as text: from the code points, as a special string shifts places.
            text = codes.astype(np.uint32)
            text[text >= END] = 32
            text = text.tobytes().decode("utf-32-le", "surrogatepass")
            ends = np.append(starts[1:], len(codes))
            at = first[miss]
            self._learn(distinct[miss].tolist(), [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            slots[miss] = np.arange(len(self.slot) - len(miss), len(self.slot))
        slots = np.where(head >= END, END - 1 - head, slots)[which]
        return slots, np.flatnonzero(slots == -1)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for part in chunks(texts):
            slots, ends = self._look_up([p for _, p in part])
            n = np.where(slots >= 0, self.count[np.maximum(slots, 0)], slots < -1).astype(np.int64)
            np.add.at(out, [i for i, _ in part], np.diff(np.concatenate([[0], np.cumsum(n)[ends]])))
        return out

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        out, size = [], np.zeros(len(texts), np.int64)
        special = np.array([0, *(i for _, i in self.specials)], np.int32)
        for part in chunks(texts):
            slots, ends = self._look_up([p for _, p in part])
            word = slots >= 0
            n = np.where(word, self.count[np.maximum(slots, 0)], slots < -1).astype(np.int64)
            upto = np.cumsum(n)
            np.add.at(size, [i for i, _ in part], np.diff(np.concatenate([[0], upto[ends]])))
            begin = np.where(word, self.begin[np.maximum(slots, 0)], 0) - (upto - n)
            at = np.repeat(begin, n) + np.arange(int(upto[-1]))
            got = self.flat[at]
            if (slots < -1).any():
                k = np.flatnonzero(slots < -1)
                got[(upto - n)[k]] = special[-1 - slots[k]]
            out.append(got)
        return np.concatenate(out) if out else np.zeros(0, np.int32), size


_LOADED: dict[tuple[str, str], BatchTokenizer] = {}


def loaded(path: str, by: str = "library") -> BatchTokenizer:
    """One tokenizer for each worker process and kind."""
    if (path, by) not in _LOADED:
        _LOADED[path, by] = BatchTokenizer(path, by)
    return _LOADED[path, by]
