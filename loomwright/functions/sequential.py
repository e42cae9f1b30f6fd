"""Text functions that are folds over characters or lines; vectorised over Arrow batches."""

from __future__ import annotations

import difflib
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

#: Digits and units of Chinese numerals (fixed values).
DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}


def numeral(s: str | None) -> int | None:
    """A Chinese numeral below a hundred million as a number; null for anything else."""
    if not s:
        return None
    if s.isdigit() and s.isascii():
        return int(s)
    total = part = digit = 0
    seen_digit = False
    for c in s:
        if c in DIGITS:
            digit, seen_digit = DIGITS[c], True
        elif c in UNITS:
            part += (digit if seen_digit or part else 1) * UNITS[c] if digit or not seen_digit else 0
            digit, seen_digit = 0, False
        elif c == "万":
            total, part, digit, seen_digit = (total + part + digit) * 10000, 0, 0, False
        else:
            return None
    return total + part + digit


def rewrite_numerals(text: str | None, protected: tuple[str, ...] = ()) -> str | None:
    """Numerals in running text become digits; protected words are masked meanwhile."""
    if text is None:
        return None
    masks = {w: chr(0xE000 + i) for i, w in enumerate(sorted(protected, key=len, reverse=True))}
    for w, m in masks.items():
        text = text.replace(w, m)
    text = re.sub("[零〇一二两三四五六七八九十百千万]+", lambda m: str(v) if (v := numeral(m[0])) is not None else m[0], text)
    for w, m in masks.items():
        text = text.replace(m, w)
    return text


def numeral_rewriter(protected: tuple[str, ...]):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: rewrite_numerals(x, protected))

    return run


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity as Python's difflib has it: not symmetric; 0 for null."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b)])


def ratio_over(least: float):
    """``ratio`` where it is over ``least``, else 0; difflib's own upper bounds (lengths, then character
    counts) spare most of the work and change nothing, as no ratio is over its bound."""

    @F.pandas_udf("double")
    def over(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            m = difflib.SequenceMatcher(None, x, y) if x is not None and y is not None else None
            r = m.ratio() if m and m.real_quick_ratio() > least and m.quick_ratio() > least else 0.0
            out.append(r if r > least else 0.0)
        return pd.Series(out, dtype="float64")

    return over


def edit_breakdown(truth: str, heard: str) -> tuple[int, int, int]:
    """Substitutions, deletions, insertions; of equal paths match or substitution, then deletion, then insertion."""
    n, m = len(truth), len(heard)
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in (truth, heard))
    steps = np.arange(m + 1)
    rows = [steps]
    for i in range(n):  # a row at a time: insertions are a running minimum
        best = np.minimum(rows[i][:-1] + (a[i] != b), rows[i][1:] + 1)
        rows.append(np.minimum.accumulate(np.concatenate([[i + 1], best]) - steps) + steps)
    d = [r.tolist() for r in rows]
    s = x = y = 0
    i, j = n, m
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (truth[i - 1] != heard[j - 1]):
            s, i, j = s + (truth[i - 1] != heard[j - 1]), i - 1, j - 1
        elif i and d[i][j] == d[i - 1][j] + 1:
            x, i = x + 1, i - 1
        else:
            y, j = y + 1, j - 1
    return s, x, y


#: Cells of the tables of distances that are filled at once.
CELLS = 1_000_000


def _padded(texts: list[str], size: np.ndarray, filler: int) -> np.ndarray:
    out = np.full((len(texts), max(1, int(size.max()))), filler, np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _breakdowns(truths: list[str], heards: list[str], n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``edit_breakdown`` of pairs of about equal lengths ``n`` and ``m``: their tables are filled, and their paths walked, in step."""
    a, b = _padded(truths, n, -1), _padded(heards, m, -2)
    count, wide = b.shape[0], b.shape[1] + 1
    steps = np.arange(wide, dtype=np.int32)
    d = np.empty((a.shape[1] + 1, count, wide), np.int32)
    d[0] = steps
    for i in range(a.shape[1]):  # insertions are a running minimum
        d[i + 1, :, 0] = i + 1
        np.minimum(d[i, :, :-1] + (a[:, i, None] != b), d[i, :, 1:] + 1, out=d[i + 1, :, 1:])
        d[i + 1] -= steps
        np.minimum.accumulate(d[i + 1], axis=1, out=d[i + 1])
        d[i + 1] += steps
    out = np.zeros((count, 3), np.int64)
    row, i, j = np.arange(count), n.copy(), m.copy()
    while len(row):
        up, left = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
        now, other = d[i, row, j], a[row, up] != b[row, left]
        diagonal = (i > 0) & (j > 0) & (now == d[up, row, left] + other)
        deleted = ~diagonal & (i > 0) & (now == d[up, row, j] + 1)
        inserted = ~diagonal & ~deleted
        out[row, 0] += diagonal & other
        out[row, 1] += deleted
        out[row, 2] += inserted
        i, j = i - (diagonal | deleted), j - (diagonal | inserted)
        on = (i > 0) | (j > 0)
        row, i, j = row[on], i[on], j[on]
    return out


def edit_breakdowns(truths: list[str], heards: list[str]) -> np.ndarray:
    """``edit_breakdown`` of each pair, as rows. Pairs go in the order of their lengths, as many at once as ``CELLS`` holds; a larger one by
    itself."""
    out = np.zeros((len(truths), 3), np.int64)
    n, m = (np.fromiter(map(len, x), np.int64, len(x)) for x in (truths, heards))
    order = np.lexsort((m, n))
    order = order[(n + m)[order] > 0]
    at = 0
    while at < len(order):
        end, most = at, 0
        while end < len(order):  # lengths grow with ``n``, and the longest ``m`` counts
            most = max(most, int(m[order[end]]))
            if end > at and (end + 1 - at) * (int(n[order[end]]) + 1) * (most + 1) > CELLS:
                break
            end += 1
        part = order[at:end]
        if (int(n[part[-1]]) + 1) * (int(m[part].max()) + 1) > CELLS:
            out[part[0]] = edit_breakdown(truths[part[0]], heards[part[0]])
        else:
            out[part] = _breakdowns([truths[k] for k in part], [heards[k] for k in part], n[part], m[part])
        at = end
    return out


@F.pandas_udf(StructType([StructField(c, IntegerType()) for c in ("substituted", "deleted", "inserted")]))
def edits(truth: pd.Series, heard: pd.Series) -> pd.DataFrame:
    found = edit_breakdowns([x or "" for x in truth], [x or "" for x in heard])
    return pd.DataFrame(found.astype("int32"), columns=["substituted", "deleted", "inserted"])
