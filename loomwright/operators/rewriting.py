"""Ordered rewrite rules from a table, with blocks for files by prefix.

A table of rules has ``ord`` (order), ``pattern`` and ``replacement`` in the syntax of Python's ``re``, and ``block`` and ``prefix``:
null in both for rules of all texts; else a rule of a block, whose prefix a text's file must begin with. All global rules
come first, in order; then those of the first block (smallest number) that fits the file. Each rule sees what the rules
before have made.

Most rules cannot fire on a text. Each has literals of which it needs one (found in its parsed pattern); one automaton over
all literals tells which rules can fire, only those run, and when one has changed the text, what is new (each replacement with
as much around it as the longest literal reaches) is read again for the rules after it. A rule that begins with a literal, behind nothing but
lookaround, is tried where that occurs only. So the time grows with texts and changes, not with rules; the result is that of all
rules in order. Rules without such a literal always run.

The table is a stated set of at most ``MOST_RULES`` rules and ``MOST_BYTES`` bytes (more are an error), which is what makes it small enough
to be sent to every task. Rules of a null pattern are left out, a null replacement is empty, ties in order go by pattern.
Null texts stay null; a null file fits no block. Texts of any length and repeated rows are rewritten each.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from re import _constants as C
from re import _parser as P

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES, MOST_BYTES = 100_000, 20_000_000
#: Literals of one rule, of which one must occur; rules with more alternatives always run.
MOST_LITERALS = 32


def required(pattern: str) -> frozenset[str] | None:
    """Literals of which each match's text holds at least one; None where none can be told."""
    parsed = P.parse(pattern)
    return _required(parsed, bool(parsed.state.flags & re.IGNORECASE))


def _required(parts, folded: bool) -> frozenset[str] | None:
    found: list[frozenset[str]] = []
    run = ""

    def end() -> None:
        nonlocal run
        if run:
            found.append(frozenset([run]))
        run = ""

    for op, arg in parts:
        if op is C.LITERAL and not (folded and chr(arg).lower() != chr(arg).upper()):
            run += chr(arg)
            continue
        end()
        inner = None
        if op is C.SUBPATTERN:
            _, on, off, inside = arg
            inner = _required(inside, (folded or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE)
        elif op is C.ASSERT:
            inner = _required(arg[1], folded)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            inner = _required(arg[2], folded)
        elif op is C.ATOMIC_GROUP:
            inner = _required(arg, folded)
        elif op is C.BRANCH:
            ways = [_required(way, folded) for way in arg[1]]
            if all(w is not None for w in ways) and sum(map(len, ways)) <= MOST_LITERALS:
                inner = frozenset().union(*ways)
        if inner:
            found.append(inner)
    end()
    # The choice whose shortest literal is longest lets fewest texts through.
    return max(found, key=lambda c: (min(map(len, c)), -len(c), sorted(c)), default=None)


def beginning(pattern: str) -> str:
    """The literal with which each match begins, empty if none can be told."""
    parsed = P.parse(pattern)
    found = ""
    for op, arg in parsed if not parsed.state.flags & re.IGNORECASE else ():
        if op is C.LITERAL:
            found += chr(arg)
        elif found or op not in (C.AT, C.ASSERT, C.ASSERT_NOT):
            break
    return found


class Rules:
    """Rules of one set in order, with the automaton over their literals."""

    def __init__(self, rules: list[tuple[str, str]]) -> None:
        import ahocorasick

        self.sources, self.compiled, self.begins = rules, [None] * len(rules), [beginning(p) for p, _ in rules]
        needs = [required(p) for p, _ in rules]
        self.always = [k for k, need in enumerate(needs) if need is None]
        of: dict[str, list[int]] = {}
        for k, need in enumerate(needs):
            for literal in need or ():
                of.setdefault(literal, []).append(k)
        self.reach = max(map(len, of), default=1) - 1
        self.automaton = ahocorasick.Automaton()
        for literal, who in of.items():
            self.automaton.add_word(literal, tuple(who))
        if of:
            self.automaton.make_automaton()

    def _able(self, text: str, after: int) -> set[int]:
        if not len(self.automaton):
            return set()
        return {k for who in {w for _, w in self.automaton.iter(text)} for k in who if k > after}

    def _matches(self, k: int, text: str) -> Iterator[re.Match]:
        """The matches that ``re.sub`` replaces."""
        rule, begin = self.compiled[k], self.begins[k]
        if not begin:
            yield from rule.finditer(text)
            return
        at = text.find(begin)
        while at >= 0:
            m = rule.match(text, at)
            if m:
                yield m
            at = text.find(begin, m.end() if m else at + 1)

    def _replaced(self, k: int, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The text after a rule, and where replacements lie in it."""
        new = self.sources[k][1]
        parts, where, upto, size = [], [], 0, 0
        for m in self._matches(k, text):
            put = m.expand(new) if "\\" in new else new
            parts += text[upto : m.start()], put
            size += m.start() - upto + len(put)
            where.append((size - len(put), size))
            upto = m.end()
        return ("".join([*parts, text[upto:]]) if where else text), where

    def apply(self, text: str) -> tuple[str, int]:
        """The rewritten text, and how many rules were tried."""
        queue = list(set(self.always) | self._able(text, -1))
        heapq.heapify(queue)
        queued, tried = set(queue), 0
        while queue:
            k = heapq.heappop(queue)
            if self.compiled[k] is None:
                self.compiled[k] = re.compile(self.sources[k][0])
            tried += 1
            new, where = self._replaced(k, text)
            if new != text:
                text = new
                for part in {text[max(0, a - self.reach) : b + self.reach] for a, b in where}:
                    for later in self._able(part, k) - queued:
                        queued.add(later)
                        heapq.heappush(queue, later)
        return text, tried


class RuleTable:
    """All rules of a table: global ones and blocks. Built once in a worker, from plain rows."""

    _built: dict[int, tuple[Rules, list[tuple[str, Rules]]]] = {}

    def __init__(self, rows: list[tuple[int | None, str | None, str, str]]) -> None:
        self.rows = rows

    def sets(self) -> tuple[Rules, list[tuple[str, Rules]]]:
        blocks: dict[tuple[int, str], list[tuple[str, str]]] = {}
        for block, prefix, pattern, new in self.rows:
            if block is not None:
                blocks.setdefault((block, prefix or ""), []).append((pattern, new))
        return Rules([(p, r) for b, _, p, r in self.rows if b is None]), [(prefix, Rules(rules)) for (_, prefix), rules in sorted(blocks.items())]

    def rewrite(self, texts: pd.Series, files: pd.Series, key: int) -> Iterator[str | None]:
        if key not in self._built:
            self._built.clear()
            self._built[key] = self.sets()
        everywhere, blocks = self._built[key]
        for text, file in zip(texts, files):
            if text is None:
                yield None
                continue
            text, _ = everywhere.apply(text)
            own = next((rules for prefix, rules in blocks if file is not None and file.startswith(prefix)), None)
            yield own.apply(text)[0] if own else text


def rule_table(rules: DataFrame) -> RuleTable:
    """The rules of a table (block, prefix, ord, pattern, replacement), in order."""
    held = rules.where("pattern is not null").select("block", "prefix", "ord", "pattern", F.coalesce("replacement", F.lit("")).alias("replacement"))
    size = held.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("pattern") + F.octet_length("replacement")), F.lit(0)).alias("size")).first()
    if size["n"] > MOST_RULES or size["size"] > MOST_BYTES:
        raise ValueError(f"{size['n']} rules of {size['size']} bytes: more than one set of rules may have")
    rows = sorted(held.collect(), key=lambda r: (r["block"] is not None, r["block"] or 0, r["ord"] is not None, r["ord"] or 0, r["pattern"]))
    return RuleTable([(r["block"], r["prefix"], r["pattern"], r["replacement"]) for r in rows])


def rewriter(rules: DataFrame):
    """A function of the columns (text, file) that applies a table of rules."""
    spark = rules.sparkSession
    shared = spark.sparkContext.broadcast(rule_table(rules))
    key = shared._jbroadcast.id()

    @F.pandas_udf("string")
    def run(texts: pd.Series, files: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.rewrite(texts, files, key)), dtype="object")

    return run


def clean_and_merge(cues: DataFrame, key: str, start: str, end: str, text: str, file: Column, rules: DataFrame, pause: float = 1.2, most: int = 60) -> DataFrame:
    """Cues rewritten by the rules, joined over short pauses, and rewritten again: (key, start, end, text). ``file`` is a function of
    the key, so that joined cues have one."""
    from .folds import merge_lines

    rewrite = rewriter(rules)
    clean = cues.select(key, start, end, rewrite(F.col(text), file).alias(text))
    merged = merge_lines(clean.where(F.length(text) > 0), key, start, end, text, pause, most)
    return merged.select(key, start, end, rewrite(F.col(text), file).alias(text))
