"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A text is lower-cased and cut at blanks into windows: words without the marks around them, and overlapping pieces of longer runs. A
window is
set in a frame of fixed bytes (zstandard stores inputs under some 7 bytes as they are, whatever the dictionary) and
compressed twice: with a dictionary trained on ordinary text, and with one trained on toxic text. The two lengths
and the window's own make a cell; a table, calibrated on labelled documents that no dictionary was trained on,
holds how many times more often windows of toxic documents fall into a cell than others. Windows of ``HIT`` or
more are hits; a longer word that is none is tried once more without its last byte, for its inflections,
and then needs ``SURE``. A document's score is a logistic function, calibrated on the same documents, of its hits.

Fitting runs on the driver over a bounded sample of labelled rows: ``SAMPLE`` of each label at most, taken by a hash
of doc_id, and of these as many whole texts of each label as ``SAMPLE_BYTES`` hold. A text that does not fit any more is passed
over, so that long labelled texts are seen less than short ones once the bound is near (none is below it; on ``check_l``, with 3.4 KB a
text, the bound holds some 2,400 of each label). Each distinct window of a document counts once, and passages seen before in the sample not at all.

Labels mark documents, not windows, so what the toxic dictionary is trained on is found in rounds. The toxic sample is
dealt into halves. With a dictionary of one half, the other half's windows fall into cells; those of cells that are
rarer in ordinary documents make up the next dictionary, and the cells must get rarer at each of ``LEVELS``. What passes
the last is taken. A round leaves out what was taken before, so that content which few documents hold (of a rarer
language, for example) has its turn; thresholds are of cells, so common content cannot raise them.

Null text counts as empty; an empty text, or one of marks only, has no windows and gets the score of no hits. Very long texts are
scored whole. Repeated rows are scored
each; the sample has one text of an id (the smallest). Without labelled rows of both kinds the score is the toxic share
of the labels (0 without any). Labels that contradict each other for one id count as toxic. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, release, ship_package, steps, written

FRAME, WINDOW, LEVEL = bytes(range(1, 9)), 32, 19
#: Labelled rows of each kind that are read at most, and bytes of their texts.
SAMPLE, SAMPLE_BYTES = 2_500, 8_000_000
#: Bytes of the ordinary dictionary, and of the toxic one; of the latter in each round.
ORDINARY, TOXIC, ROUNDS = 64_000, 6_000, (6_000, 3_000, 12_000, 6_000)
SEGMENT, DMER = 30, 6  # of the trainer: a segment holds a framed word
#: How many times likelier a cell must be in toxic documents, step by step, for training; and for a hit.
LEVELS, HIT = (1.5, 2.5, 5.0), 3.0
#: Calibration lets toxic rows weigh as if they were this share, at least: misses count then as false alarms do.
SHARE = 0.3
#: Weight (log of a cell's ratio) that a word without its last byte must have to be a hit.
SURE = 2.5
#: Marks that are no part of a word at its edges, and bytes of a word that may be inflected.
EDGES, LONGER = "".join(chr(b) for b in range(128) if not chr(b).isalnum()) + "¡¿«»„“”‚‘’…–—·", 6
_CELLS = 64 * 64 * 64
#: Distinct windows whose weights a worker remembers, twice.
REMEMBERED = 200_000


def windows(text: str | None) -> list[bytes]:
    """Words without marks at their edges, and pieces of ``WINDOW`` bytes that overlap by half of longer ones; unframed."""
    if not text:
        return []
    out = []
    for word in text.lower().split():
        word = word.strip(EDGES).encode("utf-8", "replace")
        if not word:
            continue
        if len(word) <= WINDOW:
            out.append(word)
        else:
            out += [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]
    return out


def stems(w: bytes) -> tuple[tuple[bytes, float], ...]:
    """What of a window may be a hit, with the least weight: all of it, or, if it is longer, what stands before its last byte."""
    return ((w, 0.0), (w[:-1], SURE)) if len(w) >= LONGER else ((w, 0.0),)


def compressor(content: bytes):
    """A compressor whose frames hold nothing but the content, with ``content`` as digested dictionary."""
    import zstandard

    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=WINDOW, dict_size=len(content))
    same = {k: getattr(p, k) for k in ("window_log", "hash_log", "chain_log", "search_log", "min_match", "target_length", "strategy")}
    p = zstandard.ZstdCompressionParameters(**same, write_content_size=False, write_checksum=False, write_dict_id=False)
    words = zstandard.ZstdCompressionDict(content)
    words.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=p).compress


def lengths(content: bytes, parts: list[bytes]) -> np.ndarray:
    """Compressed lengths of framed windows with a dictionary."""
    compress = compressor(content)
    return np.fromiter((len(compress(FRAME + w + b"\n")) for w in parts), np.int64, len(parts))


def _own(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, parts), np.int64, len(parts))


def _cell(own, ordinary, toxic):
    """A window's cell: its own length and both compressed lengths."""
    return (np.minimum(own, 63) * 64 + np.minimum(ordinary, 63)) * 64 + np.minimum(toxic, 63)


def _ratio(toxic: np.ndarray, ordinary: np.ndarray, spread: float) -> np.ndarray:
    """How many times likelier each cell is among the first ones, less ``spread`` standard errors of their count; half a window more
    stands for what ordinary text has not shown yet."""
    a, b = np.bincount(toxic, minlength=_CELLS), np.bincount(ordinary, minlength=_CELLS)
    return np.maximum(a - spread * np.sqrt(a), 0) / (b + 0.5) * (len(ordinary) + 1) / (len(toxic) + 1)


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    table: dict[int, float]  # weight of cells that hold hits
    weights: list[float]
    known: dict = field(default_factory=dict)  # weights of windows seen lately, and of those seen before
    older: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.sides = None

    def fresh(self) -> Model:
        """This model without memory of windows: a task's memory of them ends with the task, and not with its worker."""
        return Model(self.ordinary, self.toxic, self.table, self.weights)

    def hits(self, text: str | None) -> tuple[list[float], int]:
        """Weights of a text's hits, and its number of windows."""
        parts = windows(text)
        if self.sides is None:
            self.sides = compressor(self.ordinary), compressor(self.toxic)
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, table, (plainly, side) = self.known, self.older, self.table, self.sides
        out = []
        for w in parts:
            x = known.get(w)
            if x is None:
                x = older.get(w)
                if x is None:
                    for part, least in stems(w):
                        framed = FRAME + part + b"\n"
                        x = table.get((len(part) * 64 + min(len(plainly(framed)), 63)) * 64 + min(len(side(framed)), 63), 0.0)
                        if x > least:
                            break
                        x = 0.0
                known[w] = x
            if x:
                out.append(x)
        return out, len(parts)

    def score(self, text: str | None) -> float:
        if not self.toxic:
            return self.weights[0]
        return float(_sigmoid(np.dot(self.weights, features(*self.hits(text)))))

    def __getstate__(self) -> dict:
        return {"ordinary": self.ordinary, "toxic": self.toxic, "table": self.table, "weights": self.weights, "known": {}, "older": {}, "sides": None}


def features(weights: list[float], n: int) -> list[float]:
    """Intercept, the three heaviest hits, the number of all, and their density."""
    top = sum(sorted(weights, reverse=True)[:3])
    return [1.0, top, float(np.log1p(len(weights))), len(weights) / (n + 20) * 20]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 0.1) -> np.ndarray:
    """Weights by Newton's method, with a small ridge; rows count so that label 1 has ``share`` of them."""
    w = np.zeros(x.shape[1])
    each = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    for _ in range(60):
        p = _sigmoid(x @ w)
        step = np.linalg.solve(x.T @ (x * (each * p * (1 - p) + 1e-9)[:, None]) + ridge * np.eye(len(w)), x.T @ (each * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _train(parts: list[bytes], size: int) -> bytes:
    import zstandard

    framed = [FRAME + w + b"\n" for w in parts]
    try:
        return zstandard.train_dictionary(size, framed, k=SEGMENT, d=DMER).as_bytes()
    except zstandard.ZstdError:  # too few samples for the trainer: their content is the dictionary
        return b"".join(dict.fromkeys(framed))[-size:]


def _fresh(docs: list[np.ndarray]) -> list[np.ndarray]:
    """The distinct windows of each document that are in no run of five windows of a document before."""
    edge = np.cumsum([0, *map(len, docs)])
    owner, flat = np.repeat(np.arange(len(docs)), np.diff(edge)), np.concatenate([*docs, np.zeros(4, np.int32)])
    run = np.zeros(len(owner), np.uint64)
    for j in range(5):
        run = (run ^ flat[j : j + len(owner)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        run ^= run >> np.uint64(29)
    inside = np.arange(len(owner)) + 5 <= edge[owner + 1]
    _, first, which = np.unique(run, return_index=True, return_inverse=True)
    before = np.zeros(len(owner) + 1, np.int32)
    at = np.flatnonzero(inside & (owner[first][which] < owner))
    np.add.at(before, at, 1)
    np.add.at(before, at + 5, -1)
    new = np.cumsum(before[:-1]) == 0
    return [d[np.sort(np.unique(d, return_index=True)[1])] for d in (doc[new[x:y]] for doc, x, y in zip(docs, edge, edge[1:]))]


def _thirds(docs: list) -> tuple[list, list]:
    """What dictionaries are trained on, and what is kept for calibration."""
    return docs[len(docs) // 3 :], docs[: len(docs) // 3]


def _toxic_windows(toxic: list[np.ndarray], check: list[np.ndarray], words: list[bytes], ordinary: bytes) -> list[bytes]:
    """Windows of toxic documents for the toxic dictionary; see the head of this module."""
    used, place = np.unique(np.concatenate([*toxic, *check]), return_inverse=True)
    words = [words[i] for i in used]
    n = sum(map(len, toxic))
    edge = np.cumsum([0, *map(len, toxic)])
    odd = np.repeat(np.arange(len(toxic)) % 2, np.diff(edge))
    halves, plain = [place[:n][odd == k] for k in (0, 1)], place[n:]
    own, plainly = _own(words), lengths(ordinary, words)
    taken = [np.zeros(len(words), bool), np.zeros(len(words), bool)]
    for size in ROUNDS:
        left = [h[~t[h]] for h, t in zip(halves, taken)]
        found = left
        for least in LEVELS:
            sides = [_cell(own, plainly, lengths(_train([words[i] for i in f], size), words)) for f in found]
            found = [x[(_ratio(c[x], c[plain], 1.5) >= least)[c[x]]] for x, c in zip(left, sides[::-1])]
            if not all(map(len, found)):
                break
        else:
            for t, f in zip(taken, found):
                t[f] = True
    # A cell also has a few windows that ordinary documents hold about as often: these teach nothing.
    mine = np.concatenate(halves)
    a, b = (np.bincount(x, minlength=len(words)) for x in (mine, plain))
    keep = (taken[0] | taken[1]) & (a * len(plain) >= 2 * (b + 1) * len(mine))
    return [words[i] for i in mine[keep[mine]]]


def fit(rows: Iterable[tuple[str, int]], share: float | None = None) -> Model:
    """A model of labelled texts (text, 0 or 1), given in a fixed order. ``share``: label 1's part of all
    labelled rows, if ``rows`` is a sample with another part."""
    places: dict[bytes, int] = {}
    whole, labels = [], []
    for text, y in rows:  # texts become windows' numbers at once
        whole.append(np.array([places.setdefault(w, len(places)) for w in windows(text)], np.int32))
        labels.append(y)
    words = list(places)
    del places
    overall = Model(b"", b"", {}, [sum(labels) / len(labels) if labels else 0.0])
    toxic, plain = ([i for i, (d, y) in enumerate(zip(whole, labels)) if y == k and len(d)] for k in (1, 0))
    if len(toxic) < 8 or len(plain) < 8:
        return overall
    fresh = _fresh(whole)
    (t_fit, t_cal), (p_fit, p_cal) = _thirds(toxic), _thirds(plain)
    ordinary = _train([words[i] for d in p_fit[::2] for i in fresh[d]], ORDINARY)
    parts = _toxic_windows([fresh[d] for d in t_fit], [fresh[d] for d in p_fit[1::2]], words, ordinary)
    if not parts:
        return overall
    content = _train(parts, TOXIC)
    cell = np.full(len(words), -1, np.int64)
    used = np.unique(np.concatenate([whole[d] for d in t_cal + p_cal]))
    of = [words[i] for i in used]
    cell[used] = _cell(_own(of), lengths(ordinary, of), lengths(content, of))
    ratio = _ratio(*(np.concatenate([cell[fresh[d]] for d in ds]) for ds in (t_cal, p_cal)), 0.5)
    weight = np.where(ratio >= HIT, np.log(np.maximum(ratio, 1)), 0.0)
    weight_of = np.zeros(len(words))
    weight_of[used] = weight[cell[used]]
    short = [i for i in used if not weight_of[i] and len(words[i]) >= LONGER]
    cut = [words[i][:-1] for i in short]
    if cut:
        again = weight[_cell(_own(cut), lengths(ordinary, cut), lengths(content, cut))]
        weight_of[short] = np.where(again > SURE, again, 0.0)
    model = Model(ordinary, content, {int(c): float(weight[c]) for c in np.flatnonzero(weight)}, [])
    x = np.array([features([v for v in weight_of[whole[d]].tolist() if v], len(whole[d])) for d in t_cal + p_cal])
    y = np.array([1] * len(t_cal) + [0] * len(p_cal))
    model.weights = _logistic(x, y, max(SHARE, share or float(np.mean(y)))).tolist()
    return model


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5)) == 0


def fit_on(df: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = SAMPLE_BYTES) -> Model:
    """Fit on labelled rows outside the held-out fifth."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picks = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = {r["doc_id"]: r["toxic"] for p in picks for r in p.collect()}  # at most 2 * sample numbers
    if not chosen:
        return fit([])
    spark = df.sparkSession
    ids = spark.createDataFrame(list(chosen.items()), "doc_id long, toxic int")
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).join(F.broadcast(ids), "doc_id")
    texts = written(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "sample")
    sizes = sorted(((hash_order(r["doc_id"]), r["doc_id"], r["n"] or 0) for r in texts.select("doc_id", F.octet_length("text").alias("n")).collect()))
    room, fits = {0: size, 1: size}, []
    for _, i, held in sizes:
        if held <= room[chosen[i]]:
            room[chosen[i]] -= held
            fits.append((i,))
    rows = texts.join(F.broadcast(spark.createDataFrame(fits, "doc_id long")), "doc_id").collect()
    rows.sort(key=lambda r: hash_order(r["doc_id"]), reverse=True)
    model = fit(((r["text"], r["toxic"]) for r in iter(lambda: rows.pop() if rows else None, None)), n.get(1, 0) / max(1, sum(n.values())))
    forget(texts)
    release()
    return model


def hash_order(n: int) -> int:
    """A fixed order of ids that has nothing to do with their size."""
    return (n * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % 2**64 >> 20


def score(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``df``: id, held_out, score, predicted."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value.fresh()
        for batch in steps(batches):
            got = [model.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(got, pa.float64()), pa.array([int(s >= 0.5) for s in got], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(held_out(F.col(id_column)), F.lit(False)).alias("held_out"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_ordinary(df: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The documents (all their columns) that are not predicted to be toxic; no shuffle. Null and empty texts have the score of no hits
    (and stay, unless most labels are toxic); repeated rows are judged each, an empty table stays empty."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index(text_column)

    def run(batches):
        model = shared.value.fresh()
        for batch in steps(batches):
            yield batch.filter(pa.array([model.score(t) < 0.5 for t in batch.column(place).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
