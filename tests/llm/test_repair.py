"""Conversation repair against a plain search over edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from loomwright.llm import repair
from loomwright.llm.queries import queries

BLANK = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit) for rows (initial, fault 0 none, 1 truncated, 2 must go)."""

    after: dict[tuple[int, int], tuple[int, str]] = {}
    for i in range(len(rows), -1, -1):
        here: dict[tuple[int, int], tuple[int, str]] = {}
        for inserted in range(4, -1, -1):
            for q in range(4):
                ways = [(0, "")] if i == len(rows) and q in (0, 3) else []
                follow = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                if inserted < 4:
                    c, s = here[follow, inserted + 1]
                    ways.append((c + 2, "I" + s))
                if i < len(rows):
                    initial, fault = rows[i]
                    c, s = after[q, 0]
                    ways.append((c + 3, "D" + s))
                    for to, e in ((1, "s"), (2, "u"), (3, "a")):
                        if fault < 2 and (q == 0 if to == 1 else to == follow):
                            c, s = after[to, 0]
                            if initial == e:
                                ways.append((c + fault, "K" + s))
                            if to > 1:
                                ways.append((c + fault + 2, "R" + s))
                here[q, inserted] = min(ways) if ways else (10**9, "")
        after = here
    return after[0, 0]


def damaged(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        by[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return by


def brute(conversations):
    out = {}
    for conv, rows in damaged(conversations).items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            shown = text.strip(BLANK)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        code = [(r[1][:1], {"blank": 2, "duplicate": 2, "truncated": 1, "": 0}[f]) for r, f in zip(rows, faults)]
        cost, audit = cheapest(tuple(code))
        state, at, repaired = 0, 0, []
        for letter in audit:
            follow = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            _, role, text = rows[at] if letter != "I" else (None, None, "")
            if letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            elif letter in "RI":
                state, role = follow, {2: "user", 3: "assistant"}[follow]
            if letter != "D":
                repaired.append(f"{role}:{text}")
            at += letter != "I"
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def got(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def odd_rows():
    rng = random.Random(11)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"], ["Yes.", "no", "", " \n", None, "Why?", "x.\t", "日本。", "é!", " ", "same. ", "long " * 3000]
    rows = [(c, t, rng.choice(roles[:3] if c % 2 else roles), rng.choice(texts)) for c in range(120) for t in range(rng.randint(0, 12))]
    rows += [(None, t, "user", "a.") for t in (None, None, 3)] + [(200, None, r, "b.") for r in ("user", "assistant", "user")] + [(201, t, "user", "c.") for t in (5, 5, 9, -4)]
    return rows + [(300, t % 700, ("user", "assistant", "user", "system")[t % 4 if t % 13 else 2], f"turn {t % 900}{'.' if t % 5 else ''}") for t in range(4000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 7) for r in odd_rows()], "conv_id long, turn long, role string, text string, part string, k int")


@pytest.mark.parametrize("piece", [repair.PIECE, 5])
def test_repair_equals_a_search(spark, odd, monkeypatch, piece):
    """Odd rows, and one conversation with most rows, which lies in several ranges."""
    monkeypatch.setattr(repair, "PIECE", piece)
    want = brute(odd_rows())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = repair._dealt(repair.damage(odd))
        assert dealt.where("conv_id = 300").select("part").distinct().count() > 1
        assert got(repair.report(odd)) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert want[300][5] > 100


def test_solver_on_random_sequences(monkeypatch):
    rng = random.Random(1)
    for piece, cells in ((repair.PIECE, repair.CELLS), (3, 40), (1, 10)):
        monkeypatch.setattr(repair, "PIECE", piece)
        monkeypatch.setattr(repair, "CELLS", cells)
        many = [tuple((rng.choice("suaua?"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randint(1, 14))) for _ in range(600)]
        n = len(many)
        cost, said, _ = repair.solve([bytes("sua?".index(r) * 3 + f for r, f in m) for m in many], np.array([repair._START] * n), np.array([repair.AT_END] * n), np.ones(n, bool))
        assert [(int(c), s[0].decode()) for c, s in zip(cost, said)] == [cheapest(m) for m in many]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    name = next(q for q in queries() if q.startswith("op11_"))
    assert got(queries()[name](spark, sf)) == brute(rows)


def test_repaired_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well"), (2, 0, "assistant", "A.")], "conv_id long, turn long, role string, text string")
    rows = [tuple(r) for r in repair.repair(df).collect()]
    assert sorted(rows) == [(1, "K", "user", "Hi."), (1, "R", "assistant", "Well"), (2, "I", "user", ""), (2, "K", "assistant", "A.")]
    assert repair.report(df.limit(0)).count() == 0 and repair.repair(df.limit(0)).count() == 0
