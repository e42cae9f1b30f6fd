"""Scalar text functions as Column expressions; nothing here runs Python on executors."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: White space spelled out, as Java's \s misses U+3000 (fixed values).
WHITE = " \\t\\n\\x0b\\f\\r\\x{85}\\x{a0}\\x{3000}"


def strip_white(c: Column) -> Column:
    """All white space removed, the ideographic blank too."""
    return F.regexp_replace(c, f"[{WHITE}]+", "")


def squeeze(c: Column, most: int, mark: str = "…") -> Column:
    """Runs of white space become one blank; over ``most`` characters the text is cut and marked."""
    s = F.trim(F.regexp_replace(c, f"[{WHITE}]+", " "))
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, most), F.lit(mark))).otherwise(s)


def normal(c: Column) -> Column:
    """Lower case without white space and ASCII punctuation: the form in which quotes are compared."""
    return F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", "")


def hms(seconds: Column) -> Column:
    """HH:MM:SS, hours left out where 0."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(h > 0, F.format_string("%02d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))


def seconds_of(c: Column) -> Column:
    """Seconds of MM:SS or HH:MM:SS; null for anything else."""
    parts = F.split(c, ":")
    n = lambda i: F.element_at(parts, i).cast("long")
    return F.when(c.rlike("^[0-9]{1,3}:[0-9]{2}:[0-9]{2}$"), n(1) * 3600 + n(2) * 60 + n(3)).when(c.rlike("^[0-9]{1,3}:[0-9]{2}$"), n(1) * 60 + n(2))


@F.pandas_udf(ArrayType(StringType()))
def bigrams(texts: pd.Series) -> pd.Series:
    """Search tokens: white space goes, every adjacent pair of characters is a token, and every ideograph
    from U+4E00 to U+9FFF by itself. (Higher-order functions over the characters took 20 times as long.)"""

    def tokens(s: str | None) -> list[str]:
        s = "".join((s or "").split())
        return [a + b for a, b in zip(s, s[1:])] + [x for x in s if "\u4e00" <= x <= "\u9fff"]

    return texts.map(tokens)


def n_bigrams(c: Column) -> Column:
    """``size(bigrams(c))`` without the tokens."""
    s = strip_white(c)
    return F.greatest(F.length(s) - 1, F.lit(0)) + F.length(s) - F.length(F.regexp_replace(s, "[\\x{4e00}-\\x{9fff}]+", ""))


def any_of(c: Column, terms: list[str]) -> Column:
    """Whether any of the terms occurs (literally)."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(t)) for t in terms])


def first_match(c: Column, table: list[tuple[str, list[str]]], default: str) -> Column:
    """The first bucket of a priority list one of whose keywords occurs."""
    out = None
    for name, terms in table:
        out = F.when(any_of(c, terms), name) if out is None else out.when(any_of(c, terms), name)
    return out.otherwise(default)


def first_reason(*gates: tuple[str, Column]) -> Column:
    """The first gate that fails, by the order of the gates; null if none does."""
    return F.coalesce(*[F.when(fails, F.lit(name)) for name, fails in gates], F.lit(None).cast("string"))


def all_reasons(*gates: tuple[str, Column]) -> Column:
    """All gates that fail, in order."""
    return F.array_compact(F.array(*[F.when(fails, F.lit(name)) for name, fails in gates]))


def falsy(c: Column, default) -> Column:
    """``default`` for null and zero alike."""
    return F.coalesce(F.nullif(c, F.lit(0)), F.lit(default))


def short_hash(*parts: Column, n: int = 12) -> Column:
    """The first characters of the SHA-1 of the parts joined by a bar; null counts as empty."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, n)


def html_text(c: Column) -> Column:
    """Markup tags removed."""
    return F.regexp_replace(c, "<[^>]*>", "")


def word_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def stream_answer(c: Column) -> Column:
    """A model service's event stream (lines of ``data:``) as a struct: the joined ``text`` of its deltas up to
    ``[DONE]``, and the last ``usage`` as JSON. Lines that are no JSON, and those of other events, are passed over."""
    data = F.filter(F.transform(F.split(c, "\n"), F.trim), lambda x: F.startswith(x, F.lit("data:")))
    payload = F.transform(data, lambda x: F.trim(F.substr(x, F.lit(6))))
    done = F.array_position(payload, "[DONE]").cast("int")
    held = F.when(done > 0, F.slice(payload, F.lit(1), F.greatest(done - 1, F.lit(0)))).otherwise(payload)
    piece = lambda p: F.coalesce(F.get_json_object(p, "$.choices[0].delta.content"), F.get_json_object(p, "$.choices[0].message.content"), F.lit(""))
    usage = F.filter(F.transform(held, lambda p: F.get_json_object(p, "$.usage")), lambda u: u.isNotNull())
    return F.struct(F.array_join(F.transform(held, piece), "").alias("text"), F.try_element_at(usage, F.lit(-1)).alias("usage"))


def fill_marks(c: Column, values: dict[str, Column]) -> tuple[Column, Column]:
    """A document with ``<!--v:key-->...<!--/v-->`` filled by key, and the keys in it that are not known."""
    named = F.array_distinct(F.regexp_extract_all(c, F.lit("<!--v:([a-z_]+)-->"), F.lit(1)))
    unknown = F.array_except(named, F.array(*map(F.lit, values)))
    for key, value in values.items():
        plain = F.replace(F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
        c = F.regexp_replace(c, F.lit(f"(?s)(?<a><!--v:{key}-->).*?(?<b><!--/v-->)"), F.concat(F.lit("${a}"), plain, F.lit("${b}")))
    return c, unknown
