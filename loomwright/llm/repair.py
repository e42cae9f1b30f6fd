"""Conversation structure repair at least cost, over a bidirectional tight-arc DAG.

A conversation is a path of layers, one between each two rows, with four states: nothing yet, after a system turn,
after a user's, after an assistant's. Arcs are edits: keep, rerole and delete lead to the next layer, insert stays in
its own. Minimum costs from the start and to the end are summed up from both sides; an arc lies on a cheapest
repair exactly where cost before, arc and cost after make the total (it is tight). From the start, the set of
states that the letters so far can have reached is carried along, and of its tight arcs those of the least letter
are taken. Costs of many conversations are arrays, one step for each layer.

A conversation may hold most rows, so rows are dealt by ranges of (conversation, turn, role, text, row), and what a
range holds of a conversation is a leaf. Each range has at most two conversations that it shares with others: their
leaves become 4 x 4 matrices of costs, which give costs at the leaves' bounds, and maps of states, which give the
state where a leaf is entered. Within a leaf, pieces of ``PIECE`` rows are joined in the same way. Only repaired
rows of one conversation follow each other in one task, as a stream, for the digest hashes them in order.

Rows with null role or text count as holding one blank; a null conversation id is a conversation of its own; null
turns come first. Rows of one turn are ordered by role and text. Repeated rows are rows (and duplicates).
An empty table gives an empty result. Other columns are ignored. Texts may be of any length that Spark holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written

FAR = 1 << 40
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows of a leaf that are handled as one sequence.
PIECE = 1024
#: Places of a table of such sequences.
CELLS = 400_000
#: From nothing, after system, after user, after assistant: the turn that must follow.
NEXT = np.array([2, 2, 3, 2])
#: Costs to the end at the last layer: nothing may stay nothing, a user's turn needs an answer.
AT_END = [0, 2 * INSERT, INSERT, 0]
_START = [0, FAR, FAR, FAR]
_ROLE = {2: "user", 3: "assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty log would hold them, by a hash of conversation and turn: dropped, emptied, without sentence ends, twice,
    or with the role user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(blank("conv_id"), F.lit(":"), blank("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(blank("role"))
    rows = conversations.where(kind != 0).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.withColumn("_copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "_copy")


def _closed(f: np.ndarray) -> np.ndarray:
    """Costs from the start with inserts at one layer."""
    f = f.copy()
    f[:, 2] = np.minimum(f[:, 2], np.minimum(f[:, 0], np.minimum(f[:, 1], f[:, 3])) + INSERT)
    f[:, 3] = np.minimum(f[:, 3], f[:, 2] + INSERT)
    return f


def _closed_back(b: np.ndarray) -> np.ndarray:
    """Costs to the end with inserts at one layer."""
    out = b.copy()
    out[:, 2], out[:, 3] = np.minimum(b[:, 2], b[:, 3] + INSERT), np.minimum(b[:, 3], b[:, 2] + INSERT)
    out[:, :2] = np.minimum(b[:, :2], out[:, 2:3] + INSERT)
    return out


class Rows:
    """Row codes of many sequences, the longest first: a byte for each row is 3 * role + fault (role: system, user, assistant,
    other; fault: none, truncated, must go)."""

    def __init__(self, codes: list[bytes]) -> None:
        size = np.array([len(c) for c in codes])
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.longest = int(self.size[0]) if len(codes) else 0
        flat = np.zeros((len(codes), self.longest), np.int64)
        for k, i in enumerate(self.order):
            flat[k, : len(codes[i])] = np.frombuffer(codes[i], np.uint8)
        self.role, fault = flat // 3, flat % 3
        self.paid = np.where(fault == 2, FAR, np.where(fault == 1, TRUNCATED, 0))
        self.live = [int((self.size > i).sum()) for i in range(self.longest)]

    def costs(self, i: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the ``n`` sequences that have a row ``i``: what it costs there as a user's, an assistant's and a system turn."""
        role, paid = self.role[:n, i], self.paid[:n, i]
        return paid + np.where(role == 1, KEEP, REROLE), paid + np.where(role == 2, KEEP, REROLE), np.where(role == 0, paid, FAR)

    def forward(self, f: np.ndarray) -> list[np.ndarray]:
        """Costs from the start before each row (inserts made), and after the last (not made)."""
        layers, out = [], f.copy()
        for i, n in enumerate(self.live):
            f = _closed(out[:n])
            layers.append(f)
            user, assistant, system = self.costs(i, n)
            g = f + DELETE
            g[:, 1] = np.minimum(g[:, 1], f[:, 0] + system)
            g[:, 2] = np.minimum(g[:, 2], np.minimum(f[:, 0], np.minimum(f[:, 1], f[:, 3])) + user)
            g[:, 3] = np.minimum(g[:, 3], f[:, 2] + assistant)
            out[:n] = np.minimum(g, FAR)
        return [*layers, out]

    def backward(self, b: np.ndarray) -> list[np.ndarray]:
        """Costs to the end before each row (inserts made); ``b`` is that after each sequence's last row."""
        layers, out = [], b.copy()
        for i in range(self.longest - 1, -1, -1):
            n = self.live[i]
            b = out[:n]
            user, assistant, system = self.costs(i, n)
            g = b + DELETE
            for q in (0, 1, 3):
                g[:, q] = np.minimum(g[:, q], b[:, 2] + user)
            g[:, 0] = np.minimum(g[:, 0], b[:, 1] + system)
            g[:, 2] = np.minimum(g[:, 2], b[:, 3] + assistant)
            out[:n] = _closed_back(np.minimum(g, FAR))
            layers.append(out[:n].copy())
        return layers[::-1]

    def matrices(self) -> np.ndarray:
        """For each sequence the costs from each state before to each state after it."""
        out = np.empty((len(self.size), 4, 4), np.int64)
        for q in range(4):
            start = np.full((len(self.size), 4), FAR)
            start[:, q] = 0
            out[self.order, q] = self.forward(start)[-1]
        return out

    def letters(self, start: np.ndarray, end: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[list[bytes | None]], np.ndarray]:
        """For each sequence its least cost, and for each state where it may be entered the least letters of a cheapest
        repair (None: no cheapest repair comes by there) and the state after it. ``last``: whose last layer ends the conversation."""
        start, end, last = start[self.order], end[self.order], last[self.order]
        f = self.forward(start)
        b = [*self.backward(end), end]
        total = (_closed(start) + (b[0] if self.longest else end)).min(axis=1)
        said: list[list[bytes | None]] = [[None] * 4 for _ in self.size]
        exits = np.full((len(self.size), 4), -1)
        for q in range(4):
            on = start[:, q] + b[0][:, q] == total
            front = np.zeros((len(total), 4), bool)
            front[on, q] = True
            columns: list[np.ndarray] = []
            for i, n in enumerate(self.live):
                after = np.where((self.size[:n] > i + 1)[:, None], _padded(b[i + 1], n), end[:n]) if i + 1 < self.longest else end[:n]
                self._step(i, n, front, f[i], b[i], after, total[:n], columns)
            self._inserts(front, np.where(last[:, None], _closed(f[-1]), FAR), end, total, columns, np.zeros(len(total), bool))
            text = np.array(columns, np.uint8).T if columns else np.zeros((len(total), 0), np.uint8)
            for k in np.flatnonzero(on):
                said[k][q] = text[k][text[k] > 0].tobytes()
                exits[k, q] = front[k].argmax()
        back = np.argsort(self.order)
        return total[back], [said[k] for k in back], exits[back]

    @staticmethod
    def _inserts(front, f, b, total, columns, deletes) -> None:
        """Insert wherever that is tight and no delete is, in one layer."""
        while True:
            tight = front & (f + INSERT + b[:, NEXT] == total[:, None])
            go = tight.any(axis=1) & ~deletes
            if not go.any():
                return
            moved = np.zeros_like(tight)
            for q in range(4):
                moved[:, NEXT[q]] |= tight[:, q]
            front[go] = moved[go]
            columns.append(np.where(go, ord("I"), 0))

    def _step(self, i: int, n: int, front, f, b, after, total, columns) -> None:
        """Take the least letters in front of row ``i``, and those for the row itself."""
        at = front[:n]  # a view
        wide = lambda c: np.pad(c, (0, len(front) - n))
        deletes = lambda: at & (f + DELETE + after == total[:, None])
        while True:
            gone = deletes()
            tight = at & (f + INSERT + b[:, NEXT] == total[:, None])
            go = tight.any(axis=1) & ~gone.any(axis=1)
            if not go.any():
                break
            moved = np.zeros_like(tight)
            for q in range(4):
                moved[:, NEXT[q]] |= tight[:, q]
            at[go] = moved[go]
            columns.append(wide(np.where(go, ord("I"), 0)))
        role, paid = self.role[:n, i], self.paid[:n, i]
        kept, renamed = np.zeros_like(at), np.zeros_like(at)
        for q, to in ((0, 2), (1, 2), (3, 2), (2, 3), (0, 1)):
            cost = f[:, q] + paid + after[:, to]
            kept[:, to] |= at[:, q] & (role == to - 1) & (cost + KEEP == total)
            if to > 1:
                renamed[:, to] |= at[:, q] & (cost + REROLE == total)
        d, k, r = gone.any(axis=1), kept.any(axis=1), renamed.any(axis=1)
        at[:] = np.where(d[:, None], gone, np.where(k[:, None], kept, renamed))
        columns.append(wide(np.where(d, ord("D"), np.where(k, ord("K"), np.where(r, ord("R"), 0)))))


def _padded(a: np.ndarray, n: int) -> np.ndarray:
    return a if len(a) >= n else np.pad(a, ((0, n - len(a)), (0, 0)))


def bounds(matrices: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs before each of some sequences that follow each other, and after each."""
    before, after = [np.asarray(start)], [np.asarray(end)]
    for m in matrices[:-1]:
        before.append(np.minimum((before[-1][:, None] + m).min(axis=0), FAR))
    for m in matrices[:0:-1]:
        after.append(np.minimum((m + after[-1][None, :]).min(axis=1), FAR))
    return np.array(before), np.array(after[::-1])


def _slices(codes: list[bytes]) -> Iterator[slice]:
    """Some sequences after each other whose table has at most ``CELLS`` places (or one)."""
    at = 0
    while at < len(codes):
        longest, to = len(codes[at]), at + 1
        while to < len(codes) and max(longest, len(codes[to])) * (to + 1 - at) <= CELLS:
            longest, to = max(longest, len(codes[to])), to + 1
        yield slice(at, to)
        at = to


def solve(codes: list[bytes], start: np.ndarray, end: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[list[bytes | None]], np.ndarray]:
    """``Rows.letters`` for sequences of any length, in pieces."""
    pieces = [[c[i : i + PIECE] for i in range(0, len(c), PIECE)] for c in codes]
    owner = np.repeat(np.arange(len(codes)), [len(p) for p in pieces])
    flat = [x for p in pieces for x in p]
    before, after, ends = start[owner].copy(), end[owner].copy(), last[owner].copy()
    first = np.searchsorted(owner, np.arange(len(codes)))
    long = [i for i, p in enumerate(pieces) if len(p) > 1]
    if long:
        cut = [x for i in long for x in pieces[i]]
        matrices = np.concatenate([Rows(cut[x]).matrices() for x in _slices(cut)])
        at = 0
        for i in long:
            own = slice(first[i], first[i] + len(pieces[i]))
            before[own], after[own] = bounds(matrices[at : at + len(pieces[i])], start[i], end[i])
            ends[own.start : own.stop - 1] = False
            at += len(pieces[i])
    parts = [Rows(flat[x]).letters(before[x], after[x], ends[x]) for x in _slices(flat)]
    total, exits, said = np.concatenate([x[0] for x in parts]), np.concatenate([x[2] for x in parts]), [y for x in parts for y in x[1]]
    whole, out = [], np.full((len(codes), 4), -1)
    for i, p in enumerate(pieces):
        texts: list[bytes | None] = []
        for q in range(4):
            state, parts = q, []
            for k in range(first[i], first[i] + len(p)):
                if state >= 0 and said[k][state] is not None:
                    parts.append(said[k][state])
                    state = int(exits[k, state])
                else:
                    state = -1
            texts.append(b"".join(parts) if state >= 0 else None)
            out[i, q] = state
        whole.append(texts)
    return total[first], whole, out


def _illegal(code: bytes) -> int:
    role = np.frombuffer(code, np.uint8) // 3
    a, b = role[:-1], role[1:]
    return int((~(((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))).sum())


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in order, with the range that holds them and a number within it; stored."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(np.full(n, part, np.int32)), pa.array(np.arange(k, k + n))], ["conv_id", "turn", "role", "text", "part", "k"])
            k += n

    order = ["conv_id", "turn", "role", "text", "row"]
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # equal rows can be dealt apart by it
    dealt = numbered.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(number, "conv_id long, turn long, role string, text string, part int, k long"), "rows")


def _leaves(dealt: DataFrame) -> DataFrame:
    """(conv_id, part, codes, blank, duplicate, truncated), stored: a byte of ``codes`` for each row."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    shown = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    marked = dealt.select("conv_id", "part", "k", role.alias("role"), (F.length(shown) == 0).alias("blank"), (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("cut"), same.alias("same"))
    first = marked.groupBy("conv_id", "same").agg(F.min(F.struct("part", "k")).alias("f")).select("f.part", "f.k", F.lit(True).alias("first"))
    marked = marked.drop("same").join(first, ["part", "k"], "left").withColumn("seen", F.col("first").isNull() & ~F.col("blank"))
    marked = marked.withColumn("cut", F.col("cut") & ~F.col("seen") & ~F.col("blank"))
    code = F.col("role") * 3 + F.when(F.col("blank") | F.col("seen"), 2).when(F.col("cut"), 1).otherwise(0)
    codes = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", F.char(code + 65).alias("c")))), lambda x: x["c"]), "")
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    out = marked.groupBy("conv_id", "part").agg(codes.alias("codes"), count("blank"), count("seen").alias("duplicate"), count("cut").alias("truncated"))
    return written(out, "leaves")


def _coded(codes: pa.Array) -> list[bytes]:
    return [bytes(x - 65 for x in c.encode()) for c in codes.to_pylist()]


def _borders(leaves: DataFrame) -> DataFrame:
    """For leaves of conversations that lie in several ranges (at most two of each range): (conv_id, part, before, after, last,
    border), the last being 1 where the pair of rows at its beginning isn't legal."""
    several = leaves.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("_c"))
    shared = leaves.join(F.broadcast(several), F.col("conv_id").eqNullSafe(F.col("_c"))).select("conv_id", "part", "codes")

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for code in _coded(batch.column(2)):
                total = None
                cut = [code[i : i + PIECE] for i in range(0, len(code), PIECE)]
                for m in (m for x in _slices(cut) for m in Rows(cut[x]).matrices()):
                    total = m if total is None else np.minimum((total[:, :, None] + m[None]).min(axis=1), FAR)
                found.append([*total.ravel().tolist(), code[0] // 3, code[-1] // 3])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int64()))], ["conv_id", "part", "m"])

    def around(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        m = np.array([list(x) for x in pdf["m"]])
        before, after = bounds(m[:, :16].reshape(-1, 4, 4), np.array(_START), np.array(AT_END))
        border = [0, *(int((a, b) not in _LEGAL) for a, b in zip(m[:-1, 17].tolist(), m[1:, 16].tolist()))]
        return pd.DataFrame({"conv_id": pdf["conv_id"].astype("Int64"), "part": pdf["part"], "before": list(before), "after": list(after), "last": [False] * (len(m) - 1) + [True], "border": border})

    made = shared.mapInArrow(matrix, "conv_id long, part int, m array<long>")
    return made.groupBy("conv_id").applyInPandas(around, "conv_id long, part int, before array<long>, after array<long>, last boolean, border long")


def edits(dealt: DataFrame) -> DataFrame:
    """(conv_id, part, letters, state, cost, illegal, blank, duplicate, truncated), stored: the edits of each leaf and the state
    where it is entered."""
    leaves = _leaves(dealt)
    around = written(_borders(leaves), "borders")
    c = around.withColumnsRenamed({"conv_id": "_c", "part": "_p"})
    joined = leaves.join(F.broadcast(c), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")), "left")
    counts = ["blank", "duplicate", "truncated"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = _coded(batch.column(2))
            if not code:
                continue
            before, after, last, border = (batch.column(k).to_pylist() for k in (6, 7, 8, 9))
            total, said, exits = solve(code, np.array([x or _START for x in before]), np.array([x or AT_END for x in after]), np.array([x is None or x for x in last]))
            illegal = [_illegal(x) + (y or 0) for x, y in zip(code, border)]
            made = [pa.array([[None if t is None else t.decode() for t in x] for x in said], pa.list_(pa.string())), pa.array(exits.tolist(), pa.list_(pa.int32())), pa.array(total), pa.array(illegal, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made, *batch.columns[3:6]], ["conv_id", "part", "said", "exits", "cost", "illegal", *counts])

    solved = joined.select("conv_id", "part", "codes", *counts, "before", "after", "last", "border")
    solved = written(solved.mapInArrow(run, "conv_id long, part int, said array<string>, exits array<int>, cost long, illegal long, blank long, duplicate long, truncated long"), "solved")

    def entered(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        states = [0]
        for x in pdf["exits"]:
            states.append(int(x[states[-1]]))
        return pd.DataFrame({"_c": pdf["conv_id"].astype("Int64"), "_p": pdf["part"], "_state": states[:-1]})

    ways = solved.join(F.broadcast(c.select("_c", "_p")), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))).select("conv_id", "part", "exits")
    entry = written(ways.groupBy("conv_id").applyInPandas(entered, "_c long, _p int, _state int"), "entered")
    chosen = solved.join(F.broadcast(entry), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")), "left").withColumn("state", F.coalesce("_state", F.lit(0)))
    return written(chosen.select("conv_id", "part", F.element_at("said", F.col("state") + 1).alias("letters"), "state", "cost", "illegal", *counts), "edits")


def apply_edits(dealt: DataFrame, made: DataFrame) -> DataFrame:
    """Repaired turns (conv_id, edit, role, text); those of a conversation follow each other, in order, in one partition."""
    head = made.select("conv_id", "part", F.lit(-1).cast("long").alias("k"), F.lit("").alias("role"), F.col("letters").alias("text"), "state")
    both = head.unionByName(dealt.select("conv_id", "part", "k", "role", "text", F.lit(0).alias("state")))
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, at, state = "", 0, 0
        for batch in batches:
            out: list[tuple] = []

            def inserts(conv) -> None:
                nonlocal at, state
                while at < len(letters) and letters[at] == "I":
                    state = int(NEXT[state])
                    out.append((conv, "I", _ROLE[state], ""))
                    at += 1

            for conv, _, k, role, text, entry in zip(*(c.to_pylist() for c in batch.columns)):
                if k < 0:
                    letters, at, state = text, 0, entry
                    inserts(conv)
                    continue
                edit = letters[at]
                at += 1
                if edit == "K":
                    state = {"s": 1, "u": 2, "a": 3}[role[0]]
                elif edit == "R":
                    state = int(NEXT[state])
                    role = _ROLE[state]
                if edit != "D":
                    out.append((conv, edit, role, text))
                inserts(conv)
            columns = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string()))], ["conv_id", "edit", "role", "text"])

    return both.mapInArrow(run, "conv_id long, edit string, role string, text string")


def hashed(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines of turns that follow each other; read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, digest = none, None
        for batch in batches:
            done: list[tuple] = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if conv != now:
                    if now is not none:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
            yield _hashes(done)
        if now is not none:
            yield _hashes([(now, digest.hexdigest())])

    return turns.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, repaired_sha256 string")


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([h for _, h in rows], pa.string())], ["conv_id", "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """Repaired turns (conv_id, edit, role, text) of a table (conv_id, turn, role, text)."""
    ship_package(rows.sparkSession)
    dealt = _dealt(rows)
    return apply_edits(dealt, edits(dealt))


def report(conversations: DataFrame) -> DataFrame:
    """Damage all conversations, repair them, and return one row for each original one."""
    ship_package(conversations.sparkSession)
    dealt = _dealt(damage(conversations))
    made = edits(dealt)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    known = dealt.where("turn is not null").groupBy("conv_id", "turn").agg(F.count("*").alias("_n")).groupBy("conv_id")
    gaps = known.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    # A row for each range that a conversation lies in: its letters are put together in one string.
    sums = made.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.max("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "letters"))), lambda x: x["letters"]), "").alias("audit"),
    )
    every = ids
    for x in (gaps, sums, hashed(apply_edits(dealt, made))):
        every = every.unionByName(x, allowMissingColumns=True)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    merged = every.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in longs], F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
    return merged.select("conv_id", *longs, "audit", "repaired_sha256")
